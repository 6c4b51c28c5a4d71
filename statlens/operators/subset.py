"""Finding subsets: value bands and statistic thresholds.

All thresholds are statistics of the *whole* frame given as ``stats_of``
(default: the frame being filtered), as in the reference, where the mean
used to filter an upper-quartile subset is the mean of the full joined frame
(Q16).  The statistic is a scalar subquery, so the filter is a plain
``Filter`` over the streamed rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlens.functions.columns import qcol, require_columns
from statlens.operators.stats import scalar_stats, stat, stat_name

# Fixed values from the reference analysis: band edges of the two bandings.
POVERTY_BANDS = [("low", None, 0.5), ("middle", 0.5, 5.0), ("high", 5.0, None)]
CORRUPTION_BANDS = [("low", None, 0.3), ("high", 0.3, None)]


def band_condition(column: Column, lo: float | None, hi: float | None) -> Column:
    """``lo <= x <= hi`` with open ends for ``None`` (both ends inclusive, Q2)."""
    conds = []
    if lo is not None:
        conds.append(column >= F.lit(float(lo)))
    if hi is not None:
        conds.append(column <= F.lit(float(hi)))
    if not conds:
        return column.isNotNull()
    return reduce(lambda a, b: a & b, conds) & not_nan(column)


def not_nan(column: Column) -> Column:
    """Spark sorts NaN above every number, so a lower bound alone would keep it."""
    return ~F.isnan(column.cast("double"))


def bands(
    df: DataFrame,
    column: str,
    edges: Sequence[tuple[str, float | None, float | None]] = POVERTY_BANDS,
    band_col: str = "band",
) -> DataFrame:
    """Band membership as a relation: one output row per (row, band it is in).

    Bands share their edges (Q1): a value equal to an edge is in both
    neighbouring bands, so this is not a ``CASE``.  It is one pass: the
    matching band names are built as an array and exploded in the scan's
    pipeline; rows in no band disappear.
    """
    require_columns(df, [column])
    x = qcol(column)
    names = F.array(*[F.when(band_condition(x, lo, hi), F.lit(name)) for name, lo, hi in edges])
    return df.select("*", F.explode(names).alias(band_col)).where(F.col(band_col).isNotNull())


def band_counts(
    df: DataFrame,
    column: str,
    edges: Sequence[tuple[str, float | None, float | None]] = POVERTY_BANDS,
    band_col: str = "band",
    count_col: str = "n_rows",
) -> DataFrame:
    """Rows per band (a row on a shared edge counts in both bands, Q1).

    One global aggregate of conditional counts: no row is multiplied or
    shuffled, each task sends one partial row, and the result is reshaped
    to one row per band.
    """
    require_columns(df, [column])
    x = qcol(column)
    counts = df.agg(*[F.count_if(band_condition(x, lo, hi)).alias(f"__b{i}") for i, (_, lo, hi) in enumerate(edges)])
    items = [F.struct(F.lit(name).alias(band_col), F.col(f"__b{i}").alias(count_col))
             for i, (name, _, _) in enumerate(edges)]
    return counts.select(F.inline(F.array(*items)))


def band(df: DataFrame, column: str, lo: float | None, hi: float | None) -> DataFrame:
    """Rows of one band, ``lo <= x <= hi``."""
    require_columns(df, [column])
    return df.where(band_condition(qcol(column), lo, hi))


def _all(conds: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)


def above_stat(
    df: DataFrame,
    cols: Sequence[str],
    statistic: str = "median",
    stats_of: DataFrame | None = None,
    mean_scale: int | None = None,
    method: str = "distributed",
) -> DataFrame:
    """Rows strictly above the frame's ``median`` or ``mean`` in every column."""
    require_columns(df, cols)
    probs = [0.5] if statistic == "median" else []
    stats = scalar_stats(stats_of if stats_of is not None else df, cols, probs=probs, mean_scale=mean_scale,
                         method=method, with_mean=statistic == "mean")
    return df.where(_all([(qcol(c) > stat(stats, f"{c}_{statistic}")) & not_nan(qcol(c)) for c in cols]))


def above_medians(
    df: DataFrame, cols: Sequence[str], stats_of: DataFrame | None = None, method: str = "distributed"
) -> DataFrame:
    """Rows above the median of each column, all strict."""
    return above_stat(df, cols, "median", stats_of, method=method)


def above_means(
    df: DataFrame, cols: Sequence[str], stats_of: DataFrame | None = None, mean_scale: int | None = None
) -> DataFrame:
    """Rows above the mean of each column, all strict."""
    return above_stat(df, cols, "mean", stats_of, mean_scale, method="exact")


def lower_quartile(
    df: DataFrame, column: str, p: float = 0.25, stats_of: DataFrame | None = None, method: str = "distributed"
) -> DataFrame:
    """Rows at or below the ``p`` quantile, inclusive."""
    stats = scalar_stats(stats_of if stats_of is not None else df, [column], probs=[p], method=method, with_mean=False)
    return df.where(qcol(column) <= stat(stats, f"{column}_{stat_name(p)}"))


def upper_quartile(
    df: DataFrame, column: str, p: float = 0.75, stats_of: DataFrame | None = None, method: str = "distributed"
) -> DataFrame:
    """Rows at or above the ``p`` quantile, inclusive."""
    stats = scalar_stats(stats_of if stats_of is not None else df, [column], probs=[p], method=method, with_mean=False)
    return df.where((qcol(column) >= stat(stats, f"{column}_{stat_name(p)}")) & not_nan(qcol(column)))


def quartile_and_mean(
    df: DataFrame,
    quartile_col: str,
    mean_col: str,
    p: float = 0.75,
    mean_scale: int | None = None,
    method: str = "distributed",
) -> DataFrame:
    """Upper-quantile rows of one column that also exceed another column's mean.

    Both statistics are of the full frame, not of the subset (Q16), and come
    from one aggregate (one scalar subquery).
    """
    require_columns(df, [quartile_col, mean_col])
    cols = [quartile_col] if quartile_col == mean_col else [quartile_col, mean_col]
    stats = scalar_stats(df, cols, probs=[p], mean_scale=mean_scale, method=method)
    return df.where(
        (qcol(quartile_col) >= stat(stats, f"{quartile_col}_{stat_name(p)}"))
        & not_nan(qcol(quartile_col)) & not_nan(qcol(mean_col))
        & (qcol(mean_col) > stat(stats, f"{mean_col}_mean"))
    )


def subset_count(df: DataFrame) -> DataFrame:
    """One row: how many rows the subset has (A5)."""
    return df.agg(F.count(F.lit(1)).alias("n"))


def subset_names(df: DataFrame, label_col: str) -> DataFrame:
    """The subset's labels as rows, sorted (A6): for subsets of any size."""
    require_columns(df, [label_col])
    return df.select(qcol(label_col).alias("name")).orderBy("name")


def subset_report(df: DataFrame, label_col: str, sep: str = ", ") -> DataFrame:
    """One row: how many rows the subset has and their labels.

    Labels are sorted (Q15: the reference lists them in file order, which a
    distributed frame does not have).  The list is one value, so this is for
    label-sized subsets (countries); ``subset_names`` and ``subset_count`` are for
    larger ones.
    """
    require_columns(df, [label_col])
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.array_join(F.array_sort(F.collect_list(qcol(label_col))), sep).alias("names"),
    )
