"""Chart-ready datasets (V1-V5).

Drawing is not part of the library; each figure of the reference analysis
reduces to a small, explicit DataFrame that a plotting tool can read after
``toPandas()`` on the bounded result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from statlens.functions.columns import qcol, require_columns, rescale
from statlens.operators.rank import top_k
from statlens.operators.stats import scalar_stats, stat, stat_name

# Fixed values from the reference analysis: bubble size divisors.
WORLD_BUBBLE_DIVISOR = 1_000_000
BAND_BUBBLE_DIVISOR = 200_000


def scatter_dataset(df: DataFrame, label: str, x: str, y: str, keep: Sequence[str] = ()) -> DataFrame:
    """Labelled scatter points ``*keep, label, x, y`` (V1, V3)."""
    require_columns(df, [label, x, y, *keep])
    return df.select(
        *[qcol(c) for c in keep],
        qcol(label).alias("label"), qcol(x).cast("double").alias("x"), qcol(y).cast("double").alias("y"),
    )


def bubble_dataset(
    df: DataFrame, label: str, x: str, y: str, size: str, divisor: float = BAND_BUBBLE_DIVISOR
) -> DataFrame:
    """Bubble points ``label, x, y, size`` with ``size = size_col / divisor`` (V2, P5)."""
    require_columns(df, [label, x, y, size])
    return df.select(
        qcol(label).alias("label"),
        qcol(x).cast("double").alias("x"),
        qcol(y).cast("double").alias("y"),
        rescale(size, divisor).alias("size"),
    )


def reference_lines(
    points: DataFrame,
    full: DataFrame,
    column: str,
    probs: Sequence[float] = (0.75, 0.25),
    mean: bool = True,
    mean_scale: int | None = None,
    method: str = "distributed",
) -> DataFrame:
    """Points of a subset with horizontal lines from the *full* frame.

    Adds one column per quantile (``p75``, ``p25``) and ``mean`` of
    ``column`` over ``full``.  The statistics are one aggregate, used as
    merged scalar subqueries.
    """
    require_columns(full, [column])
    stats = scalar_stats(full, [column], probs=probs, mean_scale=mean_scale, method=method)
    names = [stat_name(p) for p in probs] + (["mean"] if mean else [])
    return points.select("*", *[stat(stats, f"{column}_{n}").alias(n) for n in names])


def ranked_bars(df: DataFrame, label: str, value: str, k: int) -> DataFrame:
    """Horizontal bar data: the top k ``label, value`` pairs."""
    return top_k(df, value, k, tie_break=(label,)).select(
        qcol(label).alias("label"), qcol(value).cast("double").alias("value")
    )
