"""Exact quantiles without funnelling the data into one task.

Spark's ``percentile`` aggregate keeps a value->count map in every task and
merges all maps in a single final task, so that task holds every distinct
value of the column.  For a continuous column at 100 TB that is unbounded.
``distributed_stats`` gives the same numbers (same interpolation, same float
expression), for several columns in one pass over the data, with every step
bounded:

1. ``hist``: the columns are stacked to ``(k, x)`` and counted per distinct
   value; a column's NULLs are counted under a ``k`` of their own.  Aggregation is
   partial first, so a value held by a third of the rows is one row per task
   before the shuffle.
2. The histogram is range-partitioned on ``(k, x)`` into ``parts`` value
   ranges; one summary row per range and column holds ``lo, hi, cnt`` and the
   exact sum of its values.
3. A running sum per column over the summary rows (a window over at most
   ``parts + 2 * columns`` rows) gives the number of values below each range,
   and each target rank (``floor``/``ceil`` of ``p*(n-1)``) is placed in its
   range.  The placement, the row count and the columns' counts and sums are one
   small row read through one scalar subquery, computed once, so every later step
   sees the same ranges and no mean needs another look at the data.
4. Each histogram row keeps those of the (at most ``2*probs*columns``) targets
   whose range holds it; a window per target walks its range in value order, and
   the row holding the rank gives the value.
5. The two neighbours are interpolated as Spark's ``percentile`` does:
   ``(hi - pos) * v_lo + (pos - lo) * v_hi``.

Steps 2 and 4 read the same histogram, whose shuffle Spark runs once.

The largest piece of work in one task is one value range of the histogram
(about ``distinct / parts`` rows), sorted with spilling.  Sums are exact DECIMALs
when ``mean_scale`` is given.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlens.functions.columns import quote, require_columns


def _parts_default(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def value_histogram(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``k, x, c``: for column ``k`` (its position in ``cols``) each value and its count.

    NULLs are counted as the value 0 of ``k + len(cols)``, so no consumer has to
    filter them, which would make it another plan and another scan.
    """
    require_columns(df, cols)
    items = ", ".join(f"named_struct('k', if({quote(c)} IS NULL, {i + len(cols)}, {i}), 'x', coalesce(CAST({quote(c)} AS DOUBLE), 0D))" for i, c in enumerate(cols))
    return df.selectExpr(f"inline(array({items}))").groupBy("k", "x").agg(F.expr("count(1) AS c"))


def distributed_stats(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    names: Sequence[str] | None = None,
    mean_scale: int | None = None,
    with_mean: bool = True,
    with_count: bool = True,
    parts: int | None = None,
) -> DataFrame:
    """One row: ``n`` (unless ``with_count`` is off), then per column the quantiles and (optionally) the mean.

    Quantile columns are ``{col}_{name}`` with ``names`` matching ``probs``;
    the mean is ``{col}_mean``.  Quantiles equal ``percentile(col, p)`` bit
    for bit (NULLs ignored; NULL when a column has no values).
    """
    cols, probs = list(cols), [float(p) for p in probs]
    names = list(names) if names is not None else [f"q{j}" for j in range(len(probs))]
    parts = parts or _parts_default(df)
    m = len(cols)
    hist = value_histogram(df, cols)
    total = "sum(x * c)" if mean_scale is None else f"sum(CAST(if(k < {m}, x, 0D) AS DECIMAL(28,{mean_scale})) * c)"
    ranges = (hist.repartitionByRange(parts, "k", "x")
              .groupBy(F.spark_partition_id().alias("pid"), F.col("k"))
              .agg(F.expr("min(x) AS lo"), F.expr("max(x) AS hi"), F.expr("sum(c) AS cnt"), F.expr(f"{total} AS total")))
    # At most parts + 2 * len(cols) rows: the running sums are bounded.
    ranges = ranges.selectExpr(
        "k", "lo", "hi", "cnt", "total",
        "sum(cnt) OVER (PARTITION BY k ORDER BY lo ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - cnt"
        " AS before",
        "sum(cnt) OVER (PARTITION BY k) AS n",
    )
    # Target placement as one SQL expression (built once, parsed in the JVM).
    targets = []
    for j, p in enumerate(probs):
        pos = f"CAST(n - 1 AS DOUBLE) * {_dbl(p)}"
        for which, fn in (("lo", "floor"), ("hi", "ceil")):
            rank = f"CAST({fn}({pos}) AS BIGINT)"
            targets.append(
                f"CASE WHEN k < {m} AND before <= {rank} AND {rank} < before + cnt THEN named_struct("
                f"'k', k, 'j', {j}, 'which', '{which}', 'rank', {rank}, "
                f"'lo', lo, 'hi', hi, 'before', before) END"
            )
    placed = f"filter(array({', '.join(targets)}), t -> t IS NOT NULL)" if targets else None
    fields = [f"'n', CAST(coalesce(sum(if(k IN (0, {m}), cnt, 0)), 0) AS BIGINT)"]
    for i in range(m):
        fields += [f"'c{i}', coalesce(sum(if(k = {i}, cnt, 0)), 0)", f"'s{i}', sum(if(k = {i}, total, NULL))"]
    if placed:
        fields.append(f"'ts', flatten(collect_list({placed}))")
    # One small row (the placement has <= 2 * probs * columns structs), read through one
    # scalar subquery, computed once.
    plan = ranges.agg(F.expr(f"named_struct({', '.join(fields)})").alias("plan")).scalar()

    if placed:
        # a row keeps the few targets of its range before it is taken apart
        held = hist.withColumn("ts", plan["ts"]).withColumn("ts", F.expr("filter(ts, t -> t.k = k AND x >= t.lo AND x <= t.hi)"))
        walked = held.select("x", "c", F.explode("ts").alias("t")).selectExpr(
            "x", "c", "t",
            "t.before + sum(c) OVER (PARTITION BY t.k, t.j, t.which ORDER BY x"
            " ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto",
        )
        hits = walked.where("upto - c <= t.rank AND t.rank < upto")
    else:
        hits = df.sparkSession.range(0).selectExpr("0D AS x", "named_struct('k', 0, 'j', 0, 'which', '') AS t")
    picks = {}
    for i in range(m):
        for j in range(len(probs)):
            for which in ("lo", "hi"):
                picks[f"v{i}_{j}_{which}"] = F.expr(f"max(CASE WHEN t.k = {i} AND t.j = {j} AND t.which = '{which}' THEN x END)")
    row = hits.agg(*[v.alias(k) for k, v in picks.items()] or [F.lit(0).alias("none")]).withColumn("plan", plan)
    # The final row as SQL expressions: one JVM call per output column.
    out = ["plan.n AS n"] if with_count else []
    for i, c in enumerate(cols):
        for j, p in enumerate(probs):
            pos = f"(CAST(nullif(plan.c{i}, 0) - 1 AS DOUBLE) * {_dbl(p)})"
            lo, hi, v_lo, v_hi = f"floor({pos})", f"ceil({pos})", f"v{i}_{j}_lo", f"v{i}_{j}_hi"
            out.append(
                f"CASE WHEN {lo} = {hi} THEN {v_lo} WHEN {v_lo} = {v_hi} THEN {v_lo} "
                f"ELSE (CAST({hi} AS DOUBLE) - {pos}) * {v_lo} + ({pos} - CAST({lo} AS DOUBLE)) * {v_hi} END "
                f"AS {quote(f'{c}_{names[j]}')}"
            )
        if with_mean:
            out.append(f"CAST(plan.s{i} AS DOUBLE) / nullif(plan.c{i}, 0) AS {quote(f'{c}_mean')}")
    return row.selectExpr(*out)


def _dbl(p: float) -> str:
    """A double literal that parses back to exactly ``p``."""
    return f"CAST('{float(p)!r}' AS DOUBLE)"
