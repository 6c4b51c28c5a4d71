"""Combining indicator frames.

``indicator_join`` is a plain equi-join; Catalyst picks the strategy from
the sizes (broadcast hash join for a side under the threshold, sort-merge
otherwise) and AQE re-plans it from runtime sizes.  Indicator frames are one
row per entity and year, so after the year filter both sides are at most a
few hundred rows and AQE turns the join into a broadcast join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from statlens.functions.columns import quote, require_columns, sql_in, sql_literal, sql_str


def indicator_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str] = "Country",
    drop_right: Sequence[str] = ("Year",),
    how: str = "inner",
) -> DataFrame:
    """Join two indicator frames on the entity (J1) with one copy of each key.

    The reference joins on ``Country`` only (both sides are one year, Q6)
    and then removes the duplicated ``Country``/``Year`` columns.  Joining
    with ``on=`` names keeps one key column; ``drop_right`` removes the
    right side's other shared columns (its ``Year``).  Pass
    ``on=["Country", "Year"]`` to join several years.
    """
    keys = [on] if isinstance(on, str) else list(on)
    require_columns(left, keys)
    require_columns(right, keys)
    right = right.drop(*[c for c in drop_right if c not in keys and c in right.columns])
    dup = [c for c in right.columns if c in left.columns and c not in keys]
    if dup:
        raise ValueError(f"columns on both sides besides the keys: {dup}")
    return left.join(right, keys, how)


def audited_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str] = "Country",
    drop_right: Sequence[str] = ("Year",),
) -> tuple[DataFrame, Observation]:
    """``indicator_join`` and an account of the rows that it loses, from the same run.

    The observation's ``get`` (after an action on the join) has ``matched`` (rows of
    the result), ``left_unmatched`` and ``right_unmatched`` (rows without a partner; a
    NULL key has none) and ``left_repeated`` and ``right_repeated`` (rows whose key
    comes more than once on their side).  No side is scanned again: the sides are
    joined outwards, the metrics are taken on the way, and the unmatched rows then
    go.  So both sides are shuffled by the key; use ``indicator_join`` where no
    account is wanted.
    """
    keys = [on] if isinstance(on, str) else list(on)
    marks = ["__left", "__right"]
    require_columns(left, keys)
    require_columns(right, keys)
    per_key = Window.partitionBy(*[quote(k) for k in keys])
    sides = [df.withColumn(m, F.count(F.lit(1)).over(per_key)) for df, m in zip((left, right), marks)]
    both = indicator_join(*sides, on=keys, drop_right=drop_right, how="full_outer")
    account = Observation()
    here = [F.col(m).isNotNull() for m in marks]
    seen = both.observe(
        account,
        F.count_if(here[0] & here[1]).alias("matched"),
        F.count_if(here[0] & ~here[1]).alias("left_unmatched"),
        F.count_if(here[1] & ~here[0]).alias("right_unmatched"),
        # a row of one side comes as often as the other side has its key
        F.coalesce(F.sum(F.when(F.col(marks[0]) > 1, 1 / F.coalesce(F.col(marks[1]), F.lit(1)))), F.lit(0)).alias("left_repeated"),
        F.coalesce(F.sum(F.when(F.col(marks[1]) > 1, 1 / F.coalesce(F.col(marks[0]), F.lit(1)))), F.lit(0)).alias("right_repeated"),
    )
    return seen.where(here[0] & here[1]).drop(*marks), account


def group_comparison(
    series: Mapping[str, tuple[DataFrame, str, str, float]],
    labels: Sequence[str],
) -> DataFrame:
    """Line up several group frames on a fixed label list, long form.

    ``series`` maps a series name to ``(frame, label_col, value_col,
    factor)``; the value is multiplied by ``factor`` (the reference puts a
    0-1 index on a 0-10 axis with ``factor=10``).  The reference matches
    rows to labels *by position* (Q5), which mislabels a bar when a row is
    missing or reordered; here each value is joined to its label, and a
    label missing from a frame gives a NULL value.

    Output: ``position, label, series, value``.
    """
    parts = []
    for name, (frame, label_col, value_col, factor) in series.items():
        require_columns(frame, [label_col, value_col])
        parts.append(frame.where(sql_in(label_col, labels)).selectExpr(
            f"{quote(label_col)} AS label",
            f"{sql_str(name)} AS series",
            f"CAST({quote(value_col)} AS DOUBLE) * {sql_literal(float(factor))} AS value",
        ))
    values = parts[0]
    for p in parts[1:]:
        values = values.unionByName(p)
    grid_items = ", ".join(
        f"named_struct('position', {i}, 'label', {sql_str(lab)}, 'series', {sql_str(name)})"
        for i, lab in enumerate(labels)
        for name in series
    )
    # The grid is |labels| x |series| literal rows (the display order).
    grid = values.sparkSession.range(1).selectExpr(f"inline(array({grid_items}))")
    return grid.join(values, ["label", "series"], "left").select("position", "label", "series", "value")
