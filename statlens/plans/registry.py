"""Registered queries: every operator of the inventory run on the test tables.

Each entry of ``QUERIES`` takes ``(spark, sf_dir)`` and returns a lazy
DataFrame over the whole test tables; ``ORACLE_SQL`` holds the same query as
SQL for DuckDB (tables registered as views).  Column names match between the
two.  The parameters below play the parts of the reference's constants: the
year, the continent list (the five regions plus one nation that is also a
"country", as Australia is), a corrected value, band edges and k.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlens.functions.columns import override_value, rename_checked, select_renamed
from statlens.operators import charts, clean, combine, dept, profile, publish, rank, stats, subset
from statlens.plans.frames import entity_frame, index_frame
from statlens.sources.testdata import TABLES, table

# Parameters of the test-table queries.
YEAR = 2000
GROUPS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST", "NATION_3"]
ALSO_COUNTRY = ["NATION_3"]
MORE_LABELS = ["World", *GROUPS, "NOWHERE"]
EXCLUDED = ["World", "AFRICA", "ASIA"]
CORRECTION = {"NATION_5": 52.31}
DISCOUNT_BANDS = [("low", None, 0.03), ("middle", 0.03, 0.07), ("high", 0.07, None)]
QUANTITY_BANDS = [("low", None, 25.5), ("high", 25.5, None)]
RUN = {"run_name": "dept_stats_publish", "source": "employees", "destination": "report_table"}
# The indicator frames hold one row per entity and year (after the year filter,
# one row per nation or region), so Spark's single-merge ``percentile`` is
# bounded by the number of entities.  Base tables (customer) use the default
# distributed method, which is bounded at any size.
ENTITY_METHOD = "exact"

Query = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------- frames

def ent_clean(spark: SparkSession, sf: str, exclude=("World",)) -> DataFrame:
    return clean.clean_indicator(
        entity_frame(spark, sf, YEAR), ["Entity", "Year", "v", "b", "pop"],
        {"Entity": "Country"}, year=YEAR, exclude=exclude,
    )


def idx_clean(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_indicator(
        index_frame(spark, sf, YEAR), ["Entity", "Year", "q"], {"Entity": "Country"}, year=YEAR,
    )


def ent_countries(spark: SparkSession, sf: str) -> DataFrame:
    return clean.country_rows(ent_clean(spark, sf), "Country", GROUPS, ALSO_COUNTRY)


def idx_countries(spark: SparkSession, sf: str) -> DataFrame:
    return clean.country_rows(idx_clean(spark, sf), "Country", GROUPS, ALSO_COUNTRY)


def joined(spark: SparkSession, sf: str) -> DataFrame:
    return combine.indicator_join(ent_countries(spark, sf), idx_countries(spark, sf))


def customer_employees(spark: SparkSession, sf: str) -> DataFrame:
    return dept.employees(table(spark, sf, "customer"), "c_custkey", "c_name", "c_acctbal", "c_mktsegment")


def customer_dept_stats(spark: SparkSession, sf: str) -> DataFrame:
    return dept.dept_stats(customer_employees(spark, sf))


# ---------------------------------------------------------------- queries

def q_scan_indicator(spark, sf):
    return entity_frame(spark, sf)


def q_clean_indicator(spark, sf):
    return ent_clean(spark, sf)


def q_year_filter(spark, sf):
    """F1 on the frame of all years: the other years' rows go."""
    return clean.clean_indicator(entity_frame(spark, sf), ["Entity", "Year", "v"], {"Entity": "Country"}, year=YEAR)


def q_quoted_columns(spark, sf):
    raw = "v. $2.15 a day"
    df = rename_checked(ent_clean(spark, sf), {"v": raw})
    return select_renamed(df, ["Country", raw], {raw: "share"})


def q_drop_nulls(spark, sf):
    docs = table(spark, sf, "documents")
    labels = table(spark, sf, "labels").select("doc_id", "quality", "toxic")
    return clean.drop_nulls(docs.join(labels, "doc_id", "left"))


def q_exclude_groups(spark, sf):
    return clean.exclude_groups(ent_clean(spark, sf, exclude=None), "Country", EXCLUDED)


def q_group_rows(spark, sf):
    return clean.group_rows(ent_clean(spark, sf), "Country", GROUPS)


def q_country_rows(spark, sf):
    return ent_countries(spark, sf)


def q_override_value(spark, sf):
    return override_value(ent_countries(spark, sf), "Country", "v", CORRECTION)


def q_bands(spark, sf):
    li = table(spark, sf, "lineitem").select("l_discount")
    return subset.band_counts(li, "l_discount", DISCOUNT_BANDS)


def q_scalar_stats(spark, sf):
    st = stats.scalar_stats(table(spark, sf, "customer"), ["c_acctbal"], probs=(0.25, 0.5, 0.75), mean_scale=2)
    return st.select(
        "n",
        F.col("c_acctbal_p25").alias("p25"),
        F.col("c_acctbal_median").alias("median"),
        F.col("c_acctbal_p75").alias("p75"),
        F.col("c_acctbal_mean").alias("mean"),
    )


def q_above_medians(spark, sf):
    return subset.above_medians(ent_countries(spark, sf), ["v", "b"], method=ENTITY_METHOD).select("Country", "v", "b")


def q_above_means(spark, sf):
    return subset.above_means(ent_countries(spark, sf), ["v", "b"]).select("Country", "v", "b")


def _customers(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")


def q_lower_quartile(spark, sf):
    return subset.lower_quartile(_customers(spark, sf), "c_acctbal")


def q_upper_quartile(spark, sf):
    return subset.upper_quartile(_customers(spark, sf), "c_acctbal")


def q_quartile_and_mean(spark, sf):
    return subset.quartile_and_mean(joined(spark, sf), "q", "v", method=ENTITY_METHOD).select("Country", "q", "v")


def q_subset_report(spark, sf):
    medians = subset.above_medians(ent_countries(spark, sf), ["v", "b"], method=ENTITY_METHOD)
    return subset.subset_report(medians, "Country")


def q_subset_names(spark, sf):
    return subset.subset_names(subset.lower_quartile(table(spark, sf, "customer"), "c_acctbal"), "c_name")


def q_subset_count(spark, sf):
    return subset.subset_count(subset.lower_quartile(table(spark, sf, "customer"), "c_acctbal"))


def q_indicator_join(spark, sf):
    return joined(spark, sf)


def q_subset_join(spark, sf):
    """J1 on two subsets: countries of one that are not in the other are lost, on both sides."""
    left = subset.above_means(ent_countries(spark, sf), ["v"])
    return combine.indicator_join(left, subset.upper_quartile(idx_countries(spark, sf), "q", method=ENTITY_METHOD))


def q_reference_lines(spark, sf):
    full = ent_countries(spark, sf)
    points = subset.lower_quartile(full, "v", method=ENTITY_METHOD).select("Country", "v", "pop")
    return charts.reference_lines(points, full, "pop", probs=(0.75, 0.25), method=ENTITY_METHOD)


def q_group_comparison(spark, sf):
    ent_groups = clean.group_rows(ent_clean(spark, sf), "Country", GROUPS)
    idx_groups = clean.group_rows(idx_clean(spark, sf), "Country", GROUPS)
    return combine.group_comparison(
        {"v": (ent_groups, "Country", "v", 1.0), "q_x10": (idx_groups, "Country", "q", 10.0)}, GROUPS
    )


def q_group_comparison_missing(spark, sf):
    """J2 with labels that the frames lack: World (taken out by F4) and a name that is nowhere."""
    ent_groups = clean.group_rows(ent_clean(spark, sf), "Country", MORE_LABELS)
    idx_groups = subset.lower_quartile(clean.group_rows(idx_clean(spark, sf), "Country", MORE_LABELS), "q", method=ENTITY_METHOD)
    return combine.group_comparison(
        {"v": (ent_groups, "Country", "v", 1.0), "q_x10": (idx_groups, "Country", "q", 10.0)}, MORE_LABELS
    )


def q_top_k_score(spark, sf):
    return charts.ranked_bars(joined(spark, sf), "Country", "v", 10)


def q_top_k_index(spark, sf):
    return charts.ranked_bars(joined(spark, sf), "Country", "q", 20)


def q_first_n(spark, sf):
    return rank.first_n(joined(spark, sf), 9, ("Country",))


def q_bubble_dataset(spark, sf):
    return charts.bubble_dataset(ent_countries(spark, sf), "Country", "b", "v", "pop", charts.WORLD_BUBBLE_DIVISOR)


def q_scatter_dataset(spark, sf):
    banded = subset.bands(joined(spark, sf), "q", QUANTITY_BANDS)
    return charts.scatter_dataset(banded, "Country", "q", "v", keep=("band",))


def q_row_counts(spark, sf):
    return profile.row_counts({name: table(spark, sf, name) for name in TABLES})


def q_schema_report(spark, sf):
    return profile.schema_report(table(spark, sf, "orders"))


def q_profile_summary(spark, sf):
    return profile.profile(table(spark, sf, "customer"), round_to=6)


def q_employees_snapshot(spark, sf):
    return customer_employees(spark, sf)


def q_dept_stats(spark, sf):
    return customer_dept_stats(spark, sf)


def q_dept_stats_events(spark, sf):
    ev = table(spark, sf, "events")
    return dept.dept_stats(dept.employees(ev, "event_id", "user_id", "value", "event_type"))


def q_report_table(spark, sf):
    return publish.report_table(customer_dept_stats(spark, sf))


def q_run_metrics(spark, sf):
    params = {k: v for k, v in RUN.items() if k != "run_name"}
    return publish.run_metrics(customer_dept_stats(spark, sf), RUN["run_name"], params)


QUERIES: dict[str, Query] = {
    "scan_indicator": q_scan_indicator,
    "clean_indicator": q_clean_indicator,
    "year_filter": q_year_filter,
    "quoted_columns": q_quoted_columns,
    "drop_nulls": q_drop_nulls,
    "exclude_groups": q_exclude_groups,
    "group_rows": q_group_rows,
    "country_rows": q_country_rows,
    "override_value": q_override_value,
    "bands": q_bands,
    "scalar_stats": q_scalar_stats,
    "above_medians": q_above_medians,
    "above_means": q_above_means,
    "lower_quartile": q_lower_quartile,
    "upper_quartile": q_upper_quartile,
    "quartile_and_mean": q_quartile_and_mean,
    "subset_report": q_subset_report,
    "subset_names": q_subset_names,
    "subset_count": q_subset_count,
    "indicator_join": q_indicator_join,
    "subset_join": q_subset_join,
    "reference_lines": q_reference_lines,
    "group_comparison": q_group_comparison,
    "group_comparison_missing": q_group_comparison_missing,
    "top_k_score": q_top_k_score,
    "top_k_index": q_top_k_index,
    "first_n": q_first_n,
    "bubble_dataset": q_bubble_dataset,
    "scatter_dataset": q_scatter_dataset,
    "row_counts": q_row_counts,
    "schema_report": q_schema_report,
    "profile_summary": q_profile_summary,
    "employees_snapshot": q_employees_snapshot,
    "dept_stats": q_dept_stats,
    "dept_stats_events": q_dept_stats_events,
    "report_table": q_report_table,
    "run_metrics": q_run_metrics,
}


# ---------------------------------------------------------------- oracle SQL

def _in(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def _ok(*cols: str, floats=()) -> str:
    """SQL form of ``na.drop``: no NULL, and no NaN in float columns."""
    parts = [f"{c} IS NOT NULL" for c in cols] + [f"NOT isnan({c})" for c in floats]
    return " AND ".join(parts)


def _rollup_sql(name: str, select_measures: str, fact_from: str, key_year: str) -> str:
    return f"""{name} AS (
  SELECT coalesce(n.n_name, r.r_name, 'World') AS Entity,
         CAST(year({key_year}) AS INTEGER) AS Year,
         {select_measures}
  FROM {fact_from}
  JOIN region r ON n.n_regionkey = r.r_regionkey
  GROUP BY GROUPING SETS ((n.n_name, r.r_name, year({key_year})), (r.r_name, year({key_year})), (year({key_year})))
)"""


ENT = _rollup_sql(
    "ent",
    """CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS v,
         CAST(sum(CAST(c.c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS b,
         count(*) AS pop""",
    "orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey",
    "o.o_orderdate",
)
IDX = _rollup_sql(
    "idx",
    "CAST(sum(CAST(l.l_quantity AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS q",
    "lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey",
    "l.l_shipdate",
)
ENT_C = f"""ent_c AS (
  SELECT Entity AS Country, Year, v, b, pop FROM ent
  WHERE Year = {YEAR} AND {_ok('Entity', 'Year', 'v', 'b', 'pop', floats=('v', 'b'))} AND Entity <> 'World'
)"""
IDX_C = f"""idx_c AS (
  SELECT Entity AS Country, Year, q FROM idx
  WHERE Year = {YEAR} AND {_ok('Entity', 'Year', 'q', floats=('q',))} AND Entity <> 'World'
)"""
COUNTRIES = f"(Country NOT IN {_in(GROUPS)} OR Country IN {_in(ALSO_COUNTRY)})"
ENT_K = f"ent_k AS (SELECT * FROM ent_c WHERE {COUNTRIES})"
IDX_K = f"idx_k AS (SELECT * FROM idx_c WHERE {COUNTRIES})"
JOINED = """j AS (
  SELECT e.Country, e.Year, e.v, e.b, e.pop, i.q FROM ent_k e JOIN idx_k i ON e.Country = i.Country
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


W_ENT_K = _with(ENT, ENT_C, ENT_K)
W_J = _with(ENT, ENT_C, ENT_K, IDX, IDX_C, IDX_K, JOINED)

EMP = """emp AS (
  SELECT c_custkey AS id, c_name AS name, CAST(trunc(c_acctbal) AS BIGINT) AS salary, c_mktsegment AS department
  FROM customer
)"""
DEPT = """dept AS (
  SELECT department, CAST(sum(salary) AS BIGINT) AS total_salary, count(*) AS staff_count,
         CAST(sum(salary) AS DOUBLE) / count(*) AS average_salary
  FROM emp GROUP BY department
)"""


def _band_sql(col: str, table_name: str, edges, out: str) -> str:
    parts = []
    for name, lo, hi in edges:
        conds = []
        if lo is not None:
            conds.append(f"{col} >= CAST({lo} AS DOUBLE)")
        if hi is not None:
            conds.append(f"{col} <= CAST({hi} AS DOUBLE)")
        parts.append(f"SELECT '{name}' AS band, * FROM {table_name} WHERE {' AND '.join(conds)}")
    return f"{out} AS (\n  " + "\n  UNION ALL ".join(parts) + "\n)"


def _schema_sql() -> str:
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    counts = " UNION ALL ".join(f"SELECT '{c}' AS column_name, count({c}) AS non_null FROM orders" for c in cols)
    return f"""WITH d AS (
  SELECT column_name, column_type, "null" AS nul, row_number() OVER () AS pos FROM (DESCRIBE orders)
), c AS ({counts})
SELECT CAST(d.pos AS INTEGER) AS position, d.column_name,
       CASE d.column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string'
            WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(d.column_type) END AS data_type,
       d.nul = 'YES' AS nullable, c.non_null
FROM d JOIN c ON d.column_name = c.column_name"""


def _profile_sql() -> str:
    parts = []
    for c in ["c_custkey", "c_nationkey", "c_acctbal"]:
        x = f"CAST({c} AS DOUBLE)"
        stats_ = [
            ("count", f"CAST(count({x}) AS DOUBLE)"),
            ("mean", f"round(avg({x}), 6)"),
            ("stddev", f"round(stddev_samp({x}), 6)"),
            ("min", f"min({x})"),
            ("25%", f"quantile_disc({x}, 0.25)"),
            ("50%", f"quantile_disc({x}, 0.5)"),
            ("75%", f"quantile_disc({x}, 0.75)"),
            ("max", f"max({x})"),
        ]
        for name, e in stats_:
            parts.append(f"SELECT '{c}' AS column_name, '{name}' AS statistic, CAST({e} AS DOUBLE) AS value, "
                         "CAST(NULL AS VARCHAR) AS text FROM customer")
    for c in ["c_name", "c_mktsegment"]:
        for name, value, text in (("count", f"count({c})", "NULL"), ("min", "NULL", f"min({c})"), ("max", "NULL", f"max({c})")):
            parts.append(f"SELECT '{c}' AS column_name, '{name}' AS statistic, CAST({value} AS DOUBLE) AS value, "
                         f"CAST({text} AS VARCHAR) AS text FROM customer")
    return "\nUNION ALL ".join(parts)


ORACLE_SQL: dict[str, str] = {
    "scan_indicator": _with(ENT) + "SELECT Entity, Year, v, b, pop FROM ent",
    "clean_indicator": _with(ENT, ENT_C) + "SELECT * FROM ent_c",
    "year_filter": _with(ENT) + f"SELECT Entity AS Country, Year, v FROM ent WHERE Year = {YEAR} AND {_ok('Entity', 'Year', 'v', floats=('v',))} AND Entity <> 'World'",
    "quoted_columns": _with(ENT, ENT_C)
    + 'SELECT Country, "v. $2.15 a day" AS share FROM (SELECT Country, v AS "v. $2.15 a day" FROM ent_c)',
    "drop_nulls": """SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE d.doc_id IS NOT NULL AND d.text IS NOT NULL AND d.lang IS NOT NULL AND d.source IS NOT NULL AND d.n_chars IS NOT NULL
  AND l.quality IS NOT NULL AND l.toxic IS NOT NULL""",
    "exclude_groups": _with(ENT)
    + f"""SELECT Entity AS Country, Year, v, b, pop FROM ent
WHERE Year = {YEAR} AND {_ok('Entity', 'Year', 'v', 'b', 'pop', floats=('v', 'b'))} AND Entity NOT IN {_in(EXCLUDED)}""",
    "group_rows": _with(ENT, ENT_C) + f"SELECT * FROM ent_c WHERE Country IN {_in(GROUPS)}",
    "country_rows": W_ENT_K + "SELECT * FROM ent_k",
    "override_value": W_ENT_K
    + "SELECT Country, Year, CASE WHEN Country = 'NATION_5' THEN CAST(52.31 AS DOUBLE) ELSE v END AS v, b, pop FROM ent_k",
    "bands": _with(_band_sql("l_discount", "lineitem", DISCOUNT_BANDS, "banded"))
    + "SELECT band, count(*) AS n_rows FROM banded GROUP BY band",
    "scalar_stats": """SELECT count(*) AS n,
       quantile_cont(c_acctbal, 0.25) AS p25, median(c_acctbal) AS median, quantile_cont(c_acctbal, 0.75) AS p75,
       CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(c_acctbal) AS mean
FROM customer""",
    "above_medians": W_ENT_K
    + "SELECT Country, v, b FROM ent_k WHERE v > (SELECT median(v) FROM ent_k) AND b > (SELECT median(b) FROM ent_k)",
    "above_means": W_ENT_K
    + "SELECT Country, v, b FROM ent_k WHERE v > (SELECT avg(v) FROM ent_k) AND b > (SELECT avg(b) FROM ent_k)",
    "lower_quartile": "SELECT c_custkey, c_name, c_acctbal FROM customer "
    "WHERE c_acctbal <= (SELECT quantile_cont(c_acctbal, 0.25) FROM customer)",
    "upper_quartile": "SELECT c_custkey, c_name, c_acctbal FROM customer "
    "WHERE c_acctbal >= (SELECT quantile_cont(c_acctbal, 0.75) FROM customer)",
    "quartile_and_mean": W_J
    + "SELECT Country, q, v FROM j WHERE q >= (SELECT quantile_cont(q, 0.75) FROM j) AND v > (SELECT avg(v) FROM j)",
    "subset_names": "SELECT c_name AS name FROM customer "
    "WHERE c_acctbal <= (SELECT quantile_cont(c_acctbal, 0.25) FROM customer)",
    "subset_count": "SELECT count(*) AS n FROM customer "
    "WHERE c_acctbal <= (SELECT quantile_cont(c_acctbal, 0.25) FROM customer)",
    "subset_report": W_ENT_K
    + """SELECT count(*) AS n, coalesce(string_agg(Country, ', ' ORDER BY Country), '') AS names FROM ent_k
WHERE v > (SELECT median(v) FROM ent_k) AND b > (SELECT median(b) FROM ent_k)""",
    "indicator_join": W_J + "SELECT * FROM j",
    "subset_join": _with(ENT, ENT_C, ENT_K, IDX, IDX_C, IDX_K)
    + """SELECT e.Country, e.Year, e.v, e.b, e.pop, i.q FROM ent_k e JOIN idx_k i ON e.Country = i.Country
WHERE e.v > (SELECT avg(v) FROM ent_k) AND i.q >= (SELECT quantile_cont(q, 0.75) FROM idx_k)""",
    "reference_lines": W_ENT_K
    + """SELECT Country, v, pop,
       (SELECT quantile_cont(pop, 0.75) FROM ent_k) AS p75,
       (SELECT quantile_cont(pop, 0.25) FROM ent_k) AS p25,
       (SELECT avg(pop) FROM ent_k) AS mean
FROM ent_k WHERE v <= (SELECT quantile_cont(v, 0.25) FROM ent_k)""",
    "group_comparison_missing": _with(ENT, ENT_C, IDX, IDX_C)
    + f"""SELECT CAST(g.position AS INTEGER) AS position, g.label, s.series, val.value
FROM (VALUES {", ".join(f"({i}, '{x}')" for i, x in enumerate(MORE_LABELS))}) g(position, label)
CROSS JOIN (VALUES ('v'), ('q_x10')) s(series)
LEFT JOIN (
  SELECT Country AS label, 'v' AS series, v AS value FROM ent_c WHERE Country IN {_in(MORE_LABELS)}
  UNION ALL SELECT Country, 'q_x10', q * 10.0 FROM idx_c WHERE Country IN {_in(MORE_LABELS)}
    AND q <= (SELECT quantile_cont(q, 0.25) FROM idx_c WHERE Country IN {_in(MORE_LABELS)})
) val ON val.label = g.label AND val.series = s.series""",
    "group_comparison": _with(ENT, ENT_C, IDX, IDX_C)
    + f"""SELECT CAST(g.position AS INTEGER) AS position, g.label, s.series, val.value
FROM (VALUES {", ".join(f"({i}, '{x}')" for i, x in enumerate(GROUPS))}) g(position, label)
CROSS JOIN (VALUES ('v'), ('q_x10')) s(series)
LEFT JOIN (
  SELECT Country AS label, 'v' AS series, v AS value FROM ent_c WHERE Country IN {_in(GROUPS)}
  UNION ALL SELECT Country AS label, 'q_x10' AS series, q * 10.0 AS value FROM idx_c WHERE Country IN {_in(GROUPS)}
) val ON val.label = g.label AND val.series = s.series""",
    "top_k_score": W_J + "SELECT Country AS label, v AS value FROM j ORDER BY v DESC, Country LIMIT 10",
    "top_k_index": W_J + "SELECT Country AS label, q AS value FROM j ORDER BY q DESC, Country LIMIT 20",
    "first_n": W_J + "SELECT * FROM j ORDER BY Country LIMIT 9",
    "bubble_dataset": W_ENT_K + "SELECT Country AS label, b AS x, v AS y, CAST(pop AS DOUBLE) / 1000000.0 AS size FROM ent_k",
    "scatter_dataset": _with(ENT, ENT_C, ENT_K, IDX, IDX_C, IDX_K, JOINED, _band_sql("q", "j", QUANTITY_BANDS, "jb"))
    + "SELECT band, Country AS label, q AS x, v AS y FROM jb",
    "row_counts": "\nUNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES),
    "schema_report": _schema_sql(),
    "profile_summary": _profile_sql(),
    "employees_snapshot": _with(EMP) + "SELECT * FROM emp",
    "dept_stats": _with(EMP, DEPT) + "SELECT * FROM dept",
    "dept_stats_events": """SELECT event_type AS department, CAST(sum(CAST(trunc(value) AS BIGINT)) AS BIGINT) AS total_salary,
       count(*) AS staff_count, CAST(sum(CAST(trunc(value) AS BIGINT)) AS DOUBLE) / count(*) AS average_salary
FROM events GROUP BY event_type""",
    "report_table": _with(EMP, DEPT)
    + """SELECT coalesce(CAST(department AS VARCHAR), '') AS department,
       coalesce(CAST(total_salary AS VARCHAR), '') AS total_salary,
       coalesce(CAST(staff_count AS VARCHAR), '') AS staff_count,
       coalesce(CAST(average_salary AS VARCHAR), '') AS average_salary
FROM dept ORDER BY department""",
    "run_metrics": _with(EMP, DEPT)
    + f"""SELECT '{RUN["run_name"]}' AS run_name, '{RUN["source"]}' AS source, '{RUN["destination"]}' AS destination,
       metric, value FROM (
  SELECT coalesce(department, 'null') || '_avg_salary' AS metric, average_salary AS value FROM dept
  UNION ALL SELECT coalesce(department, 'null') || '_staff_count' AS metric, CAST(staff_count AS DOUBLE) AS value FROM dept
) WHERE value IS NOT NULL""",
}
