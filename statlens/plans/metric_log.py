"""Compaction of the metric log (K4, K5).

The snapshot job writes a partition per run, so a replayed run replaces its own
rows; a run a minute makes half a million small folders a year.  ``compact_metrics``
moves them into one archive table of a bounded number of files, and
``read_metrics`` reads both as one log.

The archive is replaced first (with its journal, see ``sources.tables``) and the
run folders go afterwards.  A job that is lost in between leaves runs in both
places; the log shows such a run once, as its folder has it, and the next
compaction takes it in again.  A run that is replayed after its compaction gets a
folder again, which counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from statlens.functions.columns import quote
from statlens.plans.snapshot_job import TablePaths
from statlens.sources.tables import _file_system, delete, read_table, recover, replace_table

#: Rows of an archive file.
FILE_ROWS = 1_000_000


def archive_path(paths: TablePaths) -> str:
    return f"{paths.metrics}_archive"


def _table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, its ``run_id`` as text; None where there is none or it has no file."""
    fs, where = _file_system(spark, path)
    if not fs.exists(where):
        return None
    if not any(s.isDirectory() or s.getPath().getName().endswith(".parquet") for s in fs.listStatus(where)):
        return None  # every run has been compacted
    schema = read_table(spark, path).schema
    as_text = StructType([StructField(f.name, StringType()) if f.name == "run_id" else f for f in schema.fields])
    return spark.read.schema(as_text).parquet(path)  # a run named 007 stays 007


def read_metrics(spark: SparkSession, root: str) -> DataFrame:
    """The whole metric log of the tables under ``root``: every run once."""
    paths = TablePaths(root.rstrip("/"))
    recover(spark, archive_path(paths))
    live, archive = _table(spark, paths.metrics), _table(spark, archive_path(paths))
    if live is None and archive is None:
        raise FileNotFoundError(f"no metric log under {root}")
    if live is None or archive is None:
        return archive if live is None else live
    return archive.join(live.select("run_id").distinct(), "run_id", "left_anti").unionByName(live, allowMissingColumns=True)


def compact_metrics(spark: SparkSession, root: str, file_rows: int = FILE_ROWS) -> int:
    """Move the runs that have a folder into the archive; how many there were.

    The archive is sorted by run and has a file per ``file_rows`` rows.
    """
    paths = TablePaths(root.rstrip("/"))
    live = _table(spark, paths.metrics)
    if live is None:
        return 0
    fs, where = _file_system(spark, paths.metrics)
    folders = [s.getPath().toString() for s in fs.listStatus(where) if s.isDirectory() and s.getPath().getName().startswith("run_id=")]
    log = read_metrics(spark, root)
    files = -(-log.count() // file_rows)
    log = log.select(*sorted(map(quote, log.columns))).repartitionByRange(max(1, files), "run_id").sortWithinPartitions("run_id")
    replace_table(log, archive_path(paths))
    for folder in folders:  # those that were there before the archive was written, and only these
        delete(spark, folder)
    spark.catalog.refreshByPath(paths.metrics)
    return len(folders)


def main(argv: list[str] | None = None) -> None:
    """``python -m statlens.plans.metric_log ROOT``."""
    import argparse

    from statlens.session import build_session

    ap = argparse.ArgumentParser(description="move the metric log's run folders into its archive")
    ap.add_argument("root", help="shared folder holding the tables")
    args = ap.parse_args(argv)
    print(compact_metrics(build_session(), args.root))


if __name__ == "__main__":
    main()
