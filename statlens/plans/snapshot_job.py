"""Snapshot -> statistics -> publish, as one batch job (W1; K1-K5, A1, F16).

Steps, each after the previous one succeeded:

1. The snapshot is written beside the employee table.  Writing evaluates every
   row, so a malformed or missing salary fails here (``SnapshotDataError``),
   while the live table is still untouched; an empty snapshot is rejected (Q9).
2. The written table is renamed into the employee table's place; nothing is
   copied.
3. Department statistics are computed from the employee *table* (reading a
   written table cuts the lineage: a lost executor recomputes from the
   table, not from the source) and replace the statistics table.
4. The report table (text cells) is overwritten and the run's metrics are
   written to the metrics table, partitioned by run id with dynamic
   partition overwrite, so re-running a run replaces its metrics instead
   of duplicating them.

All paths are under ``root``, which must be a shared file system on a
cluster (the same rule as ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlens.operators.dept import dept_stats
from statlens.operators.publish import report_table, run_metrics
from statlens.sources.employees import read_employees_csv, read_employees_quarantined
from statlens.sources.tables import SnapshotDataError, read_table, replace_table, write_report_csv

DEFAULT_RUN_NAME = "dept_stats_publish"
DEFAULT_PARAMS = {"source": "employees", "destination": "report_table"}


# Error conditions by which Spark says that the data, not the job, is at fault.
DATA_ERRORS = ("MALFORMED_RECORD_IN_PARSING", "MALFORMED_CSV_RECORD", "CAST_INVALID_INPUT", "CAST_OVERFLOW",
               "NUMERIC_VALUE_OUT_OF_RANGE", "USER_RAISED_EXCEPTION", "CSV header does not conform to the schema")


@dataclass(frozen=True)
class TablePaths:
    root: str

    @property
    def employees(self) -> str:
        return f"{self.root}/employees"

    @property
    def stats(self) -> str:
        return f"{self.root}/department_stats"

    @property
    def report(self) -> str:
        return f"{self.root}/report_table"

    @property
    def metrics(self) -> str:
        return f"{self.root}/run_metrics"

    @property
    def rejected_rows(self) -> str:
        return f"{self.root}/rejected_rows"

    @property
    def rejected(self) -> str:
        return f"{self.root}/rejected_snapshots"


def load_snapshot(spark: SparkSession, snapshot: DataFrame, paths: TablePaths) -> DataFrame:
    """Replace the employee table (K1); rows that can't be read as a snapshot raise ``SnapshotDataError``."""
    try:
        replace_table(snapshot, paths.employees)
    except (PySparkException, Py4JJavaError) as err:
        if any(mark in str(err) for mark in DATA_ERRORS):
            raise SnapshotDataError(str(err)) from err
        raise
    return read_table(spark, paths.employees)


def compute_stats(spark: SparkSession, paths: TablePaths) -> DataFrame:
    """Statistics of the employee table, written to the statistics table (A1, K2)."""
    replace_table(dept_stats(read_table(spark, paths.employees)), paths.stats)
    return read_table(spark, paths.stats)


def publish(
    spark: SparkSession,
    paths: TablePaths,
    run_id: str,
    run_name: str = DEFAULT_RUN_NAME,
    params: dict[str, str] | None = None,
) -> bool:
    """Write the report and the run's metrics; ``False`` if there were no statistics (F16)."""
    stats = read_table(spark, paths.stats)
    if stats.isEmpty():
        return False
    write_report_csv(report_table(stats), paths.report)
    metrics = run_metrics(stats, run_name, params or DEFAULT_PARAMS).withColumn("run_id", F.lit(run_id))
    (metrics.write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_id")
     .parquet(paths.metrics))
    return True


def run_snapshot_job(
    spark: SparkSession,
    snapshot: DataFrame | str,
    root: str,
    run_id: str | None = None,
    run_name: str = DEFAULT_RUN_NAME,
    params: dict[str, str] | None = None,
    quarantine: bool = False,
) -> DataFrame:
    """Run the whole chain for one snapshot (a CSV path or an employee frame).

    With ``quarantine`` (CSV paths only) bad lines don't fail the run: they are
    written to the ``rejected_rows`` table (``file, line, reason``, a partition by
    run) before the good rows replace the employee table.

    Returns the published statistics table.  Raises ``EmptySnapshotError``
    (tables unchanged) for an empty snapshot and ``SnapshotDataError`` (tables
    unchanged) for a malformed one; any other fault is raised as it is.
    """
    paths = TablePaths(root.rstrip("/"))
    run_id = run_id or f"{time.strftime('%Y%m%dT%H%M%S')}-{uuid.uuid4().hex[:8]}"
    if isinstance(snapshot, str) and quarantine:
        snapshot, rejected = read_employees_quarantined(spark, snapshot)
        (rejected.withColumn("run_id", F.lit(run_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(paths.rejected_rows))
    elif quarantine:
        raise ValueError("quarantine needs the path of a CSV snapshot")
    elif isinstance(snapshot, str):
        snapshot = read_employees_csv(spark, snapshot)
    load_snapshot(spark, snapshot, paths)
    stats = compute_stats(spark, paths)
    publish(spark, paths, run_id, run_name, params)
    return stats


def main(argv: list[str] | None = None) -> None:
    """``python -m statlens.plans.snapshot_job SNAPSHOT_CSV ROOT [--run-id ID]``."""
    import argparse

    from statlens.session import build_session

    ap = argparse.ArgumentParser(description="snapshot -> department statistics -> report and metrics")
    ap.add_argument("snapshot", help="employee snapshot CSV (id,name,salary,department)")
    ap.add_argument("root", help="shared folder holding the tables")
    ap.add_argument("--run-id", default=None)
    ap.add_argument("--run-name", default=DEFAULT_RUN_NAME)
    ap.add_argument("--quarantine", action="store_true", help="keep bad lines aside instead of failing")
    args = ap.parse_args(argv)
    spark = build_session()
    run_snapshot_job(spark, args.snapshot, args.root, run_id=args.run_id, run_name=args.run_name, quarantine=args.quarantine)


if __name__ == "__main__":
    main()
