"""Spark session settings used by the library, the tests and the bench.

The library never creates a session behind the caller's back: every operator
takes DataFrames, every plan takes a ``SparkSession``.  ``build_session`` is a
convenience for scripts and tests; on a cluster the session comes from the
launcher and only ``shared_dir`` is used.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings that matter for the plans this library builds.  AQE re-plans joins
# from runtime sizes (a side that turns out small is broadcast, skewed shuffle
# partitions are split), and coalesces small shuffle partitions.
PLAN_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Coalesce small shuffle partitions up to the advisory size rather than
    # keeping one task per core (recommended by Spark for busy clusters).
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "statlens",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with ``PLAN_CONF`` applied.

    ``shuffle_partitions`` defaults to twice the local cores in local mode; on
    a cluster leave it to the launcher (or size it to about 128 MB of shuffle
    data per partition) and let AQE coalesce.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in PLAN_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions is None and master and master.startswith("local"):
        shuffle_partitions = 2 * (os.cpu_count() or 4)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Jobs put stream checkpoints and lineage-cutting tables under it, so they
    survive the loss of any executor.  It must be set by whoever launches the
    application (tests set a temporary one); a machine-local default would be
    wrong on a cluster, so there is none.
    """
    value = spark.conf.get("spark.checkpoint.dir", None)
    if not value:
        value = spark.sparkContext.getCheckpointDir()
    if not value:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS, object store) before running jobs"
        )
    return value.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """Use the session's checkpoint folder, or set ``fallback`` if it has none.

    Only for tests and local runs: on a cluster the setting is always given.
    """
    value = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if value:
        return value.rstrip("/")
    spark.sparkContext.setCheckpointDir(fallback)
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback.rstrip("/")
