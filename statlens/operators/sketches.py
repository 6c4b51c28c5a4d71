"""Mergeable quantile sketches per snapshot.

A profile's approximate percentiles need the data again for every new question.
A KLL sketch (Spark's ``kll_sketch_agg_double``) of each column is a few KB, is
built by partial aggregation, can be stored with its snapshot, and sketches of
many snapshots merge into one of the same size: quantiles over any choice of
snapshots come from a handful of stored rows.

A quantile's rank is off by at most ``rank_error(k)`` of the values, with a
confidence of about 99 % (the sketch's published bound); merging keeps it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlens.functions.columns import quote, require_columns, sql_str

#: Size parameter of a sketch, from 8 to 65535: larger is more exact.
DEFAULT_K = 400


def rank_error(k: int = DEFAULT_K) -> float:
    """The normalised rank error of a sketch of size ``k`` (one quantile, 99 % confidence)."""
    return 2.296 / k ** 0.9723


def column_sketches(df: DataFrame, cols: Sequence[str], k: int = DEFAULT_K, by: str | None = None) -> DataFrame:
    """``column, n, nulls, lo, hi, sketch`` for each of ``cols`` (and each value of ``by``, first column ``snapshot``).

    NULL and NaN are counted as ``nulls`` and are in no sketch.  A column without a
    value has a NULL sketch.  One pass over the data; the shuffle holds a sketch
    per column and task.
    """
    require_columns(df, [*cols, *([by] if by else [])])
    snapshot = f"{quote(by)} AS snapshot, " if by else ""
    items = ", ".join(f"named_struct('column', {sql_str(c)}, 'x', nanvl(CAST({quote(c)} AS DOUBLE), NULL))" for c in cols)
    stacked = df.selectExpr(*([snapshot.rstrip(", ")] if by else []), f"inline(array({items}))")
    return stacked.groupBy(*(["snapshot"] if by else []), "column").agg(
        F.count("x").alias("n"), F.count_if(F.col("x").isNull()).alias("nulls"), F.min("x").alias("lo"), F.max("x").alias("hi"),
        F.kll_sketch_agg_double("x", k).alias("sketch"))


def store_sketches(sketches: DataFrame, path: str) -> None:
    """Write sketches (with ``snapshot``) as a table with a partition by snapshot; writing a snapshot again replaces it."""
    (sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("snapshot").parquet(path))


def merged_quantiles(sketches: DataFrame, probs: Sequence[float]) -> DataFrame:
    """``column, n, nulls, lo, hi, prob, value``: quantiles over all rows of ``sketches`` of a column.

    ``value`` is one of the data's values, NULL where the column has none.
    """
    merged = sketches.groupBy("column").agg(
        F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.expr("kll_merge_agg_double(sketch) FILTER (WHERE n > 0)").alias("sketch"))
    ranks = "array(" + ", ".join(f"CAST('{float(p)!r}' AS DOUBLE)" for p in probs) + ")"
    values = f"if(n > 0, kll_sketch_get_quantile_double(sketch, {ranks}), array_repeat(CAST(NULL AS DOUBLE), {len(probs)}))"
    return merged.selectExpr("column", "n", "nulls", "lo", "hi", f"inline(arrays_zip({ranks}, {values})) AS (prob, value)")
