"""Publishing statistics: a report table and a run's metrics.

The reference sends the statistics to a spreadsheet and to an experiment
tracker.  Here both are tables: the report is the statistics as text in a
fixed column order, the metrics are a long table of named values tagged
with the run's name and parameters.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType

from statlens.functions.columns import qcol, require_columns
from statlens.operators.dept import STATS_COLUMNS

# Fixed values from the reference: metric name suffixes.
METRIC_SUFFIXES = {"average_salary": "_avg_salary", "staff_count": "_staff_count"}


def report_table(
    stats: DataFrame,
    headers: Sequence[str] = STATS_COLUMNS,
    decimals: int | None = None,
    sort_by: str | None = "department",
) -> DataFrame:
    """The statistics as text cells under fixed headers.

    Every header becomes a string column; a NULL becomes ``""`` (Q12).
    Floating values are written in full; ``decimals`` asks for that many
    places instead (a fixed decimal).
    Rows are sorted by ``sort_by`` (Q10).
    """
    require_columns(stats, headers)
    cells = []
    for h in headers:
        dt = stats.schema[h].dataType
        c = qcol(h)
        if decimals is not None and isinstance(dt, (DoubleType, FloatType, DecimalType)):
            c = c.cast(f"decimal(38,{decimals})")
        cells.append(F.coalesce(c.cast("string"), F.lit("")).alias(h))
    out = stats.select(*cells)
    if sort_by:
        out = out.orderBy(qcol(sort_by))
    return out


def run_metrics(
    stats: DataFrame,
    run_name: str,
    params: Mapping[str, str],
    key_col: str = "department",
    suffixes: Mapping[str, str] = METRIC_SUFFIXES,
) -> DataFrame:
    """Long metric table ``run_name, <params...>, metric, value``.

    Each statistic of each group becomes a metric named
    ``{group}{suffix}``; a NULL value is skipped, as the reference skips
    ``None``.  The run's parameters are constant columns.
    """
    require_columns(stats, [key_col, *suffixes])
    long = stats.select(
        qcol(key_col).alias("__key"),
        *[qcol(c).cast("double").alias(c) for c in suffixes],
    ).unpivot(["__key"], list(suffixes), "__stat", "value")
    # A NULL group (Q11) is named "null" rather than dropping its metrics.
    name = F.concat(F.coalesce(F.col("__key").cast("string"), F.lit("null")), F.create_map(
        *[x for k, v in suffixes.items() for x in (F.lit(k), F.lit(v))]
    )[F.col("__stat")])
    return long.where(F.col("value").isNotNull()).select(
        F.lit(run_name).alias("run_name"),
        *[F.lit(v).alias(k) for k, v in params.items()],
        name.alias("metric"),
        "value",
    )
