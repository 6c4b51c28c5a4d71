"""One-row statistics of a frame and their use as thresholds.

``scalar_stats`` computes every statistic of every requested column in a
single aggregate: one scan, one percentile call per column with all
probabilities, partial aggregation in the map tasks.  A global aggregate
always returns exactly one row, so its result is the one thing that is safe
to hand to every task.

Thresholds are used as *scalar subqueries* (``DataFrame.scalar()``):
Catalyst runs the one-row aggregate once, merges the subqueries that read
the same aggregate into one (``MergeScalarSubqueries``) and filters the big
side in a plain ``Filter`` with no join at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlens.functions.aggregates import mean_sql
from statlens.functions.columns import qcol, quote, require_columns, sql_literal
from statlens.operators.quantiles import distributed_stats

DEFAULT_PROBS = (0.25, 0.5, 0.75)
# Quantile methods:
#   "distributed": exact, every step bounded (operators.quantiles); the
#                  default, safe for a column of any size and cardinality.
#   "exact":       Spark's ``percentile``; its final merge holds every
#                  distinct value in one task, so only for frames known to be
#                  small (one row per country, nation, department...).
#   "approx":      ``percentile_approx``, an element of the data, bounded memory.
METHODS = ("distributed", "exact", "approx")


def stat_name(p: float) -> str:
    """Name of a quantile statistic: 0.5 -> ``median``, 0.25 -> ``p25``."""
    if p == 0.5:
        return "median"
    pct = p * 100
    return f"p{int(pct)}" if float(pct).is_integer() else f"p{pct:g}".replace(".", "_")


def scalar_stats(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float] = DEFAULT_PROBS,
    mean_scale: int | None = None,
    method: str = "distributed",
    accuracy: int = 10000,
    with_mean: bool = True,
) -> DataFrame:
    """One row: ``{col}_{stat}`` for each column and statistic, plus ``n``.

    Statistics: ``mean`` and one quantile per probability (``median`` for
    0.5, ``p25``...).  Quantiles are exact and linearly interpolated (as
    ``numpy.quantile``) unless ``method="approx"`` (``percentile_approx``, an
    element of the data, bounded memory).  ``mean_scale`` sums a fixed-scale
    column as DECIMAL for an exact, partition-independent mean.  ``method``
    is one of ``METHODS`` (see above).  Without ``with_mean`` the distributed
    method leaves out ``n`` and the means.
    """
    require_columns(df, cols)
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    probs = list(probs)
    if method == "distributed":
        return distributed_stats(df, cols, probs, [stat_name(p) for p in probs], mean_scale=mean_scale,
                                 with_mean=with_mean, with_count=with_mean)
    # One aggregate, written as SQL expressions (one JVM call per column).
    array = "array(" + ", ".join(sql_literal(float(p)) for p in probs) + ")"
    aggs = ["count(1) AS n"]
    out = ["n"]
    for c in cols:
        x, q = f"CAST({quote(c)} AS DOUBLE)", quote(f"{c}__q")
        if probs:
            fn = f"percentile_approx({x}, {array}, {int(accuracy)})" if method == "approx" else f"percentile({x}, {array})"
            aggs.append(f"{fn} AS {q}")
            out += [f"CAST({q}[{i}] AS DOUBLE) AS {quote(f'{c}_{stat_name(p)}')}" for i, p in enumerate(probs)]
        aggs.append(f"{mean_sql(c, mean_scale)} AS {quote(f'{c}_mean')}")
        out.append(quote(f"{c}_mean"))
    return df.agg(*[F.expr(a) for a in aggs]).selectExpr(*out)


def stat(stats: DataFrame, name: str) -> Column:
    """A statistic of a ``scalar_stats`` row as a scalar-subquery column."""
    return stats.select(qcol(name)).scalar()


def with_stats(df: DataFrame, stats: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Attach statistics of a (possibly different) frame to every row.

    Each statistic becomes a column holding a scalar subquery; the subqueries
    over the same aggregate are merged and computed once.
    """
    names = list(names) if names is not None else stats.columns
    return df.select("*", *[stat(stats, n).alias(n) for n in names])
