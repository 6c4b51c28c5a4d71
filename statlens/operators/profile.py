"""Inspection of frames.

Each report is one aggregate over the frame: the schema report counts the
non-null values of every column in one pass, the profile computes every
statistic of every column in one pass.  Only the one-row result is
reshaped, so the work grows with the data and nothing but that row crosses
a task boundary.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from statlens.functions.columns import qcol, quote, require_columns, sql_str

PROFILE_STATS = ("count", "mean", "stddev", "min", "25%", "50%", "75%", "max")


def schema_report(df: DataFrame) -> DataFrame:
    """``position, column_name, data_type, nullable, non_null`` per column."""
    items = [
        f"named_struct('position', {i + 1}, 'column_name', {sql_str(f.name)}, "
        f"'data_type', {sql_str(f.dataType.simpleString())}, 'nullable', {str(f.nullable).lower()}, "
        f"'non_null', count({quote(f.name)}))"
        for i, f in enumerate(df.schema.fields)
    ]
    return df.agg(F.expr(f"array({', '.join(items)})").alias("r")).select(F.inline("r"))


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, n_rows`` for several frames.

    For a parquet scan ``count`` reads no column data (row-group metadata and
    an empty projection).
    """
    if not frames:
        raise ValueError("row_counts needs at least one frame")
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
             for name, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def profile(
    df: DataFrame,
    cols: Sequence[str] | None = None,
    accuracy: int = 10000,
    round_to: int | None = None,
) -> DataFrame:
    """Typed long profile ``column_name, statistic, value, text``.

    The statistics of ``DataFrame.summary()`` for its columns, the numeric and the
    string ones.  A numeric column has count, mean, sample stddev, min, approximate
    25/50/75 % (``percentile_approx``, elements of the data, Q18) and max, as doubles
    in ``value``.  A string column has its count in ``value`` and its min and max in
    ``text``; its other statistics aren't defined and have no row.  ``round_to``
    rounds mean and stddev, whose last bits depend on summation order.
    """
    profiled = {f.name: f.dataType for f in df.schema.fields if isinstance(f.dataType, (NumericType, StringType))}
    cols = list(cols) if cols is not None else list(profiled)
    require_columns(df, cols)
    items = []

    def row(column: str, statistic: str, value: str = "NULL", text: str = "NULL") -> None:
        items.append(f"named_struct('column_name', {sql_str(column)}, 'statistic', {sql_str(statistic)}, "
                     f"'value', CAST({value} AS DOUBLE), 'text', CAST({text} AS STRING))")

    for c in cols:
        if isinstance(profiled.get(c), StringType):
            row(c, "count", f"count({quote(c)})")
            row(c, "min", text=f"min({quote(c)})")
            row(c, "max", text=f"max({quote(c)})")
            continue
        x = f"CAST({quote(c)} AS DOUBLE)"
        q = f"percentile_approx({x}, array(0.25D, 0.5D, 0.75D), {int(accuracy)})"
        mean, sd = f"avg({x})", f"stddev_samp({x})"
        if round_to is not None:
            mean, sd = f"round({mean}, {int(round_to)})", f"round({sd}, {int(round_to)})"
        values = [f"count({x})", mean, sd, f"min({x})", f"{q}[0]", f"{q}[1]", f"{q}[2]", f"max({x})"]
        for name, v in zip(PROFILE_STATS, values):
            row(c, name, v)
    if not items:
        return df.sparkSession.createDataFrame([], "column_name string, statistic string, value double, text string")
    return df.agg(F.expr(f"array({', '.join(items)})").alias("r")).select(F.inline("r"))


def summary_strings(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """The reference's ``summary()``: all statistics as strings, one column per input column."""
    return (df.select(*[qcol(c) for c in cols]) if cols else df).summary()
