"""The indicator analysis over the three indicator files (entry points A1 and A2).

``indicator_analysis`` returns every result of the analysis as a named,
lazy DataFrame: cleaned frames, profiles, band datasets, threshold subsets
with their reports, the joined frame, rankings and the continent
comparison.  Nothing is collected; a caller materialises the results it
needs (all of them are small: one row per country, or fewer).

Shared inputs (the cleaned frames) are plain lazy plans by default, so each
materialised result re-reads and re-cleans the CSV files.  With
``stage_dir`` (a shared folder; ``"checkpoint"`` means a fresh folder under
the session's ``spark.checkpoint.dir``) the cleaned frames are written once
as parquet tables and read back: the lineage is cut there, a lost executor
recomputes from those tables, and every result scans small parquet files
instead of parsing CSV again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from statlens.functions.columns import override_value
from statlens.operators import charts, clean, combine, profile, rank, subset
from statlens.operators.clean import CONTINENT_ALSO_COUNTRY, CONTINENTS, DEFAULT_YEAR, INCOME_GROUPS
from statlens.session import checkpoint_root
from statlens.sources.indicator import read_indicator

# Fixed values from the reference analysis: column names after renaming.
COUNTRY = "Country"
LADDER = "Cantril ladder score"
LIFE = "Life expectancy"
POVERTY = "Share in extreme poverty"
POPULATION = "Population"
CORRUPTION = "Political corruption index"
WORLD_CORRECTIONS = {"Central African Republic": 52.31}
# Every frame here is one row per country (a few hundred rows), so Spark's
# single-merge ``percentile`` is bounded; see ``operators.stats.METHODS``.
M = "exact"


def clean_frames(
    ladder: DataFrame,
    poverty_life: DataFrame,
    corruption: DataFrame,
    year: int = DEFAULT_YEAR,
) -> dict[str, DataFrame]:
    """The three cleaned frames and the two continent frames."""
    ladder_c = clean.clean_indicator(
        ladder, ["Entity", "Year", "Cantril ladder score"], {"Entity": COUNTRY}, year=year, exclude=INCOME_GROUPS
    )
    poverty_c = clean.clean_indicator(
        poverty_life,
        [
            "Entity",
            "Year",
            "Life expectancy - Sex: all - Age: 0 - Variant: estimates",
            "$2.15 a day - Share of population in poverty",
            "Population (historical)",
        ],
        {
            "Entity": COUNTRY,
            "Life expectancy - Sex: all - Age: 0 - Variant: estimates": LIFE,
            "$2.15 a day - Share of population in poverty": POVERTY,
            "Population (historical)": POPULATION,
        },
        year=year,
        exclude=["World"],
    )
    poverty_c = override_value(poverty_c, COUNTRY, LIFE, WORLD_CORRECTIONS)
    corruption_c = clean.clean_indicator(
        corruption,
        ["Entity", "Year", "Political corruption index (best estimate, aggregate: average)"],
        {"Entity": COUNTRY, "Political corruption index (best estimate, aggregate: average)": CORRUPTION},
        year=year,
        exclude=["World"],
    )
    return {
        "ladder": clean.country_rows(ladder_c, COUNTRY, CONTINENTS, CONTINENT_ALSO_COUNTRY),
        "ladder_continents": clean.group_rows(ladder_c, COUNTRY, CONTINENTS),
        "poverty_life": poverty_c,
        "corruption": clean.country_rows(corruption_c, COUNTRY, CONTINENTS, CONTINENT_ALSO_COUNTRY),
        "corruption_continents": clean.group_rows(corruption_c, COUNTRY, CONTINENTS),
    }


def poverty_results(pov: DataFrame) -> dict[str, DataFrame]:
    """Entry point A1: poverty share against life expectancy."""
    out: dict[str, DataFrame] = {
        "poverty_profile": profile.profile(pov),
        "poverty_scatter": charts.scatter_dataset(pov, COUNTRY, POVERTY, LIFE),
        "poverty_bubbles": charts.bubble_dataset(pov, COUNTRY, POVERTY, LIFE, POPULATION,
                                                 charts.WORLD_BUBBLE_DIVISOR),
    }
    for name, lo, hi in subset.POVERTY_BANDS:
        out[f"poverty_band_{name}"] = charts.bubble_dataset(
            subset.band(pov, POVERTY, lo, hi), COUNTRY, POVERTY, LIFE, POPULATION, charts.BAND_BUBBLE_DIVISOR
        )
    medians = subset.above_medians(pov, [LIFE, POVERTY], method=M)
    out["above_medians"] = medians
    out["above_medians_report"] = subset.subset_report(medians, COUNTRY)
    out["above_medians_bubbles"] = charts.bubble_dataset(
        medians, COUNTRY, POVERTY, LIFE, POPULATION, charts.BAND_BUBBLE_DIVISOR
    )
    means = subset.above_means(pov, [LIFE, POVERTY])
    out["above_means"] = means
    out["above_means_report"] = subset.subset_report(means, COUNTRY)
    low = subset.lower_quartile(pov, POVERTY, method=M)
    out["low_poverty"] = low
    out["low_poverty_report"] = subset.subset_report(low, COUNTRY)
    out["low_poverty_lines"] = charts.reference_lines(
        charts.bubble_dataset(low, COUNTRY, POVERTY, LIFE, POPULATION, charts.BAND_BUBBLE_DIVISOR),
        pov, LIFE, probs=(0.75, 0.25), method=M,
    )
    return out


def corruption_results(
    ladder: DataFrame,
    corr: DataFrame,
    ladder_continents: DataFrame,
    corruption_continents: DataFrame,
) -> dict[str, DataFrame]:
    """Entry point A2: corruption against life satisfaction, and continents."""
    j = combine.indicator_join(ladder, corr, on=COUNTRY)
    out: dict[str, DataFrame] = {
        "ladder_profile": profile.profile(ladder),
        "corruption_profile": profile.profile(corr),
        "joined": j,
        "joined_head": rank.first_n(j, 5, (COUNTRY,)),
        "joined_scatter": charts.scatter_dataset(j, COUNTRY, CORRUPTION, LADDER),
        "corruption_bands": charts.scatter_dataset(
            subset.bands(j, CORRUPTION, subset.CORRUPTION_BANDS), COUNTRY, CORRUPTION, LADDER, keep=("band",)
        ),
        "top_10_ladder": charts.ranked_bars(j, COUNTRY, LADDER, 10),
        "top_20_corruption": charts.ranked_bars(j, COUNTRY, CORRUPTION, 20),
    }
    low = subset.lower_quartile(j, CORRUPTION, method=M)
    out["low_corruption"] = low
    out["low_corruption_report"] = subset.subset_report(low, COUNTRY)
    out["low_corruption_lines"] = charts.reference_lines(
        charts.scatter_dataset(low, COUNTRY, CORRUPTION, LADDER), j, LADDER, probs=(0.75, 0.25), method=M
    )
    high = subset.upper_quartile(j, CORRUPTION, method=M)
    out["high_corruption"] = high
    out["high_corruption_report"] = subset.subset_report(high, COUNTRY)
    out["high_corruption_lines"] = charts.reference_lines(
        charts.scatter_dataset(high, COUNTRY, CORRUPTION, LADDER), j, LADDER, probs=(0.75, 0.25), method=M
    )
    hq = subset.quartile_and_mean(j, CORRUPTION, LADDER, method=M)
    out["high_corruption_high_ladder"] = hq
    out["high_corruption_high_ladder_head"] = rank.first_n(hq, 9, (COUNTRY,))
    out["continents"] = combine.group_comparison(
        {
            LADDER: (ladder_continents, COUNTRY, LADDER, 1.0),
            f"{CORRUPTION} x10": (corruption_continents, COUNTRY, CORRUPTION, 10.0),
        },
        CONTINENTS,
    )
    return out


def indicator_analysis(
    spark: SparkSession,
    ladder_path: str,
    poverty_life_path: str,
    corruption_path: str,
    year: int = DEFAULT_YEAR,
    stage_dir: str | None = None,
) -> dict[str, DataFrame]:
    """Every result of the analysis, by name, from the three indicator CSVs."""
    frames = clean_frames(
        read_indicator(spark, ladder_path, "ladder"),
        read_indicator(spark, poverty_life_path, "poverty_life"),
        read_indicator(spark, corruption_path, "corruption"),
        year,
    )
    if stage_dir == "checkpoint":
        stage_dir = f"{checkpoint_root(spark)}/statlens-analysis-{uuid.uuid4().hex}"
    if stage_dir:
        staged = {}
        for name, df in frames.items():
            path = f"{stage_dir.rstrip('/')}/{name}"
            df.write.mode("overwrite").parquet(path)
            staged[name] = spark.read.parquet(path)
        frames = staged
    out = dict(frames)
    out.update(poverty_results(frames["poverty_life"]))
    out.update(corruption_results(frames["ladder"], frames["corruption"],
                                  frames["ladder_continents"], frames["corruption_continents"]))
    return out


def main(argv: list[str] | None = None) -> None:
    """``python -m statlens.plans.analysis LADDER POVERTY_LIFE CORRUPTION OUT [--year Y]``.

    Writes every result as a parquet table ``OUT/<name>``; the cleaned frames
    are staged under ``spark.checkpoint.dir`` first, so the CSVs are parsed once.
    """
    import argparse

    from statlens.session import build_session

    ap = argparse.ArgumentParser(description="indicator analysis over three indicator CSVs")
    ap.add_argument("ladder")
    ap.add_argument("poverty_life")
    ap.add_argument("corruption")
    ap.add_argument("out")
    ap.add_argument("--year", type=int, default=DEFAULT_YEAR)
    args = ap.parse_args(argv)
    spark = build_session()
    results = indicator_analysis(spark, args.ladder, args.poverty_life, args.corruption,
                                 year=args.year, stage_dir="checkpoint")
    for name, df in results.items():
        df.write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/{name}")


if __name__ == "__main__":
    main()
