"""Small fixtures: the 25 sample employees and synthetic indicator files.

The indicator rows hold one row for each edge listed in FIXTURES.md §3.
"""

import csv
import math
import os

# Id, salary and department of the reference's 25-row sample
# snapshot.  Names do not enter any result and are given as ids here.
EMPLOYEES_CSV = """id,name,salary,department
1,employee_1,2000,sales
2,employee_2,5000,finance
3,employee_3,8000,hr
4,employee_4,5000,marketing
5,employee_5,9000,it
6,employee_6,2100,sales
7,employee_7,4800,finance
8,employee_8,8300,hr
9,employee_9,6200,marketing
10,employee_10,9500,it
11,employee_11,2300,sales
12,employee_12,7200,finance
13,employee_13,7900,hr
14,employee_14,5100,marketing
15,employee_15,8700,it
16,employee_16,2400,sales
17,employee_17,5400,finance
18,employee_18,8100,hr
19,employee_19,5900,marketing
20,employee_20,9100,it
21,employee_21,6000,it
22,employee_22,8000,it
23,employee_23,10000,it
24,employee_24,3000,hr
25,employee_25,1200,sales
"""

# Expected statistics of EMPLOYEES_CSV (FIXTURES.md §2).
EMPLOYEES_STATS = {
    "sales": (10000, 5, 2000.0),
    "finance": (22400, 4, 5600.0),
    "hr": (35300, 5, 7060.0),
    "marketing": (22200, 4, 5550.0),
    "it": (60300, 7, 60300 / 7),
}

COUNTRIES = ["Aland", "Borduria", "Carpania", "Dolmen", "Elbonia", "Freedonia", "Genovia", "Hyrule",
             "Ishtar", "Jumanji", "Kaldor", "Latveria"]

# ladder: Entity, Code, Year, score
LADDER = (
    [(c, c[:3].upper(), 2021, s) for c, s in zip(COUNTRIES, [7.5, 6.1, 5.0, 4.2, 6.8, 3.9, 7.1, 5.5, 4.8, 6.3, 5.0, 2.9])]
    + [("Australia", "AUS", 2021, 7.0), ("Ladderonly", "LDO", 2021, 6.6),
       ("Tiedone", "TD1", 2021, 5.9), ("Tiedtwo", "TD2", 2021, 5.9),
       ("Nanland", "NAN", 2021, float("nan")), ("Nullland", "NUL", 2021, None),
       ("Oldland", "OLD", 2020, 8.0), ("Aland", "ALA", 2020, 1.0),
       ("World", None, 2021, 5.5), ("High-income countries", None, 2021, 6.9),
       ("Low-income countries", None, 2021, 4.1), ("Lower-middle-income countries", None, 2021, 4.9),
       ("Upper-middle-income countries", None, 2021, 5.8),
       ("Africa", None, 2021, 4.5), ("Asia", None, 2021, 5.4), ("Europe", None, 2021, 6.4),
       ("North America", None, 2021, 6.5), ("South America", None, 2021, 5.9)]
)

# corruption: Entity, Code, Year, index  (South America missing; 0.3 on the band edge)
CORRUPTION = (
    [(c, c[:3].upper(), 2021, v) for c, v in zip(COUNTRIES, [0.05, 0.3, 0.62, 0.71, 0.12, 0.88, 0.09, 0.45, 0.5, 0.2, 0.66, 0.93])]
    + [("Australia", "AUS", 2021, 0.04), ("Tiedone", "TD1", 2021, 0.4), ("Tiedtwo", "TD2", 2021, 0.41),
       ("Corruptonly", "CRO", 2021, 0.7), ("World", None, 2021, 0.5),
       ("Africa", None, 2021, 0.6), ("Asia", None, 2021, 0.55), ("Europe", None, 2021, 0.2),
       ("North America", None, 2021, 0.3), ("Australia", "AUS", 2020, 0.9)]
)

# poverty_life: Entity, Code, Year, life, share, annotations, population, region
POVERTY_LIFE = (
    [(c, c[:3].upper(), 2021, life, share, None, pop, "R")
     for c, life, share, pop in zip(
        COUNTRIES,
        [81.2, 76.4, 70.1, 64.3, 79.9, 58.2, 82.5, 73.3, 68.7, 75.0, 66.6, 61.0],
        [0.1, 0.5, 5.0, 12.5, 0.2, 35.0, 0.0, 2.2, 0.9, 1.5, 8.0, 40.1],
        [5_000_000, 12_000_000, 30_000_000, 8_000_000, 2_000_000, 45_000_000,
         900_000, 60_000_000, 3_000_000, 7_000_000, 15_000_000, 22_000_000])]
    + [("Central African Republic", "CAF", 2021, 18.0, 65.0, None, 5_400_000, "Africa"),
       ("Nopop", "NOP", 2021, 70.0, 3.0, None, None, "R"),
       ("World", None, 2021, 71.0, 8.5, None, 7_900_000_000, None),
       ("Africa", None, 2021, 62.0, 30.0, None, 1_400_000_000, None)]
)

LADDER_HEADER = ["Entity", "Code", "Year", "Cantril ladder score"]
CORRUPTION_HEADER = ["Entity", "Code", "Year", "Political corruption index (best estimate, aggregate: average)"]
POVERTY_HEADER = ["Entity", "Code", "Year", "Life expectancy - Sex: all - Age: 0 - Variant: estimates",
                  "$2.15 a day - Share of population in poverty", "990305-annotations",
                  "Population (historical)", "World regions according to OWID"]


def _cell(v):
    if v is None:
        return ""
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    return str(v)


def write_csv(path, header, rows):
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(header)
        for r in rows:
            w.writerow([_cell(v) for v in r])
    return path


def write_indicator_files(directory):
    os.makedirs(directory, exist_ok=True)
    return (
        write_csv(os.path.join(directory, "ladder.csv"), LADDER_HEADER, LADDER),
        write_csv(os.path.join(directory, "poverty_life.csv"), POVERTY_HEADER, POVERTY_LIFE),
        write_csv(os.path.join(directory, "corruption.csv"), CORRUPTION_HEADER, CORRUPTION),
    )
