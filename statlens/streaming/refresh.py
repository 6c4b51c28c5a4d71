"""Periodic full refresh as a Structured Streaming query.

The reference re-runs the snapshot job every minute on a fixed file, with
no backfill of missed runs.  Here new snapshot files landing in a directory
drive the job through a file source and ``foreachBatch``, which runs the
batch chain of ``snapshot_job``:

* ``backfill=False`` (default, the reference's behaviour): a micro-batch
  is the signal that files have arrived; it loads only the newest file of the
  folder, by its listing, so older snapshots of the same interval are skipped.
  The first attempt of a batch pins its file in the checkpoint folder, so a
  replay publishes the same file whatever has landed since.
* ``backfill=True``: one file per micro-batch (``maxFilesPerTrigger=1``), in
  arrival order, so every snapshot is published in turn.

After each batch the tables hold the statistics of exactly one snapshot.

The work is stateless (every batch overwrites the tables), so a batch that
is replayed after a failure produces the same tables; the metrics of a batch
are written under its own run id with dynamic partition overwrite, so a
replay does not duplicate them.  An empty snapshot is skipped and the
tables keep the previous snapshot (Q9).  A malformed snapshot (bad header, bad
salary, bad row) is found while it is written beside the tables: they keep the previous
snapshot, the batch is recorded in the ``rejected_snapshots`` table with the
reason, and the stream goes on.  Any other error (storage, executors, a fault of
the job) fails the query, and the batch is replayed when it is started again.  The stream's checkpoint lives
under ``spark.checkpoint.dir`` (a shared folder), so the query resumes
where it stopped after a driver restart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from statlens.operators.dept import employees
from statlens.plans.snapshot_job import DEFAULT_PARAMS, DEFAULT_RUN_NAME, TablePaths, run_snapshot_job
from statlens.session import checkpoint_root
from statlens.sources.employees import EMPLOYEES_RAW_SCHEMA, read_employees_csv
from statlens.sources.tables import EmptySnapshotError, SnapshotDataError, read_file, write_file


def snapshot_stream(spark: SparkSession, snapshot_dir: str, backfill: bool = False) -> DataFrame:
    """Streaming frame of snapshot rows with their file's path and modification time."""
    reader = (spark.readStream
              .schema(EMPLOYEES_RAW_SCHEMA)
              .option("header", True)
              .option("enforceSchema", False)     # a header in another order raises
              .option("mode", "FAILFAST"))
    if backfill:
        reader = reader.option("maxFilesPerTrigger", 1)
    return reader.csv(snapshot_dir).select(
        "*",
        F.col("_metadata.file_modification_time").alias("_file_time"),
        F.col("_metadata.file_path").alias("_file_path"),
    )


def newest_snapshot(spark: SparkSession, snapshot_dir: str) -> str | None:
    """The newest file of the folder by its listing (latest modification time, then path).

    It is chosen before its rows are looked at, so an older snapshot never stands
    in for a newest file without rows.  A file of 0 bytes is not listed: it counts
    as not there.
    """
    files = spark.read.format("binaryFile").load(snapshot_dir).select("path", "modificationTime")
    return files.agg(F.max_by("path", F.struct("modificationTime", "path"))).first()[0]


def pinned_snapshot(spark: SparkSession, snapshot_dir: str, checkpoint: str, epoch_id: int) -> str:
    """The file of a batch: the newest one when the batch is first tried, the same one ever after."""
    pin = f"{checkpoint.rstrip('/')}/snapshot_pins/{epoch_id:08d}"
    path = read_file(spark, pin)
    if path is None:
        path = newest_snapshot(spark, snapshot_dir)
        if path is None:
            raise EmptySnapshotError(f"no file in {snapshot_dir}")
        write_file(spark, pin, path)
    return path


def record_rejection(spark: SparkSession, root: str, run_id: str, reason: str) -> None:
    """One row in ``rejected_snapshots``: the batch and the error."""
    (spark.createDataFrame([(run_id, reason)], "run_id string, reason string")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_id").parquet(TablePaths(root.rstrip("/")).rejected))


def start_refresh(
    spark: SparkSession,
    snapshot_dir: str,
    root: str,
    name: str = "snapshot_refresh",
    interval: str | None = "1 minute",
    available_now: bool = False,
    backfill: bool = False,
    run_name: str = DEFAULT_RUN_NAME,
    params: dict[str, str] | None = None,
    checkpoint: str | None = None,
) -> StreamingQuery:
    """Start the refresh query.

    ``interval`` is the processing-time trigger (the reference's one
    minute); ``available_now=True`` processes what is waiting and stops
    (tests, catch-up runs): the newest snapshot, or with ``backfill=True``
    every snapshot in turn.  A snapshot with no rows is skipped (Q9).
    """
    params = params or DEFAULT_PARAMS
    checkpoint = checkpoint or f"{checkpoint_root(spark)}/{name}"

    def each_batch(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        run_id = f"batch-{epoch_id:08d}"
        try:
            rows = employees(batch) if backfill else read_employees_csv(session, pinned_snapshot(session, snapshot_dir, checkpoint, epoch_id))
            run_snapshot_job(session, rows, root, run_id=run_id, run_name=run_name, params=params)
        except EmptySnapshotError:
            pass
        except SnapshotDataError as err:    # any other error fails the query, and the batch is replayed
            record_rejection(session, root, run_id, str(err))

    writer = (snapshot_stream(spark, snapshot_dir, backfill).writeStream
              .queryName(name)
              .foreachBatch(each_batch)
              .option("checkpointLocation", checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


def main(argv: list[str] | None = None) -> None:
    """``python -m statlens.streaming.refresh SNAPSHOT_DIR ROOT [--interval I] [--available-now] [--backfill]``."""
    import argparse

    from statlens.session import build_session

    ap = argparse.ArgumentParser(description="refresh department statistics whenever a snapshot lands")
    ap.add_argument("snapshot_dir")
    ap.add_argument("root")
    ap.add_argument("--interval", default="1 minute")
    ap.add_argument("--available-now", action="store_true")
    ap.add_argument("--backfill", action="store_true")
    args = ap.parse_args(argv)
    spark = build_session()
    q = start_refresh(spark, args.snapshot_dir, args.root, interval=args.interval,
                      available_now=args.available_now, backfill=args.backfill)
    q.awaitTermination()


if __name__ == "__main__":
    main()
