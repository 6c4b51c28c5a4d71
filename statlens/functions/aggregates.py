"""Aggregate expressions shared by the operators, as SQL text.

They are built-in Catalyst aggregates, so they get partial (map-side)
aggregation and whole-stage codegen; none of them moves rows to the driver.
Operators pass them to ``F.expr`` / ``selectExpr`` (one JVM call each).
"""

from __future__ import annotations

from statlens.functions.columns import quote


def mean_sql(column: str, scale: int | None = None) -> str:
    """Mean of a column (A3).

    ``scale=None`` is ``avg`` (double summation, order dependent in the last
    bits).  With a scale (money: 2), the values are summed as an exact
    DECIMAL and divided once at the end, so every engine and every
    partitioning gives the same double, and partial sums re-aggregate exactly.
    """
    c = quote(column)
    if scale is None:
        return f"avg({c})"
    return f"CAST(sum(CAST({c} AS DECIMAL(28,{int(scale)}))) AS DOUBLE) / count({c})"
