"""Top-k and first-n.

``orderBy(...).limit(k)`` plans as ``TakeOrderedAndProject``: every task
keeps its own k best rows and only those k rows per task reach the final
merge, so nothing is sorted globally and no single-partition window is
used.  Ties are broken by the label (Q14) so the result is deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from statlens.functions.columns import qcol, require_columns


def top_k(
    df: DataFrame,
    column: str,
    k: int = 10,
    tie_break: Sequence[str] = ("Country",),
    ascending: bool = False,
) -> DataFrame:
    """The k rows with the highest (or lowest) ``column``, ties by ``tie_break``."""
    require_columns(df, [column, *tie_break])
    first = qcol(column).asc_nulls_last() if ascending else qcol(column).desc_nulls_last()
    return df.orderBy(first, *[qcol(c).asc() for c in tie_break]).limit(int(k))


def first_n(df: DataFrame, n: int = 5, order: Sequence[str] = ("Country",)) -> DataFrame:
    """The first n rows in an explicit order (T3; ``head()`` is 5 rows)."""
    require_columns(df, order)
    return df.orderBy(*[qcol(c).asc() for c in order]).limit(int(n))
