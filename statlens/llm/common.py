"""Helpers shared by the training-data operators.

Tables that cut lineage are Parquet tables under the shared folder that the
cluster names in ``spark.checkpoint.dir``; a later job rereads them, so the
loss of an executor costs only the tasks that it ran.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_root(spark: SparkSession) -> str:
    """The shared folder for tables between jobs.

    It is read from the session (``spark.checkpoint.dir``).  Where it is unset,
    a local session gets a temporary folder and any other session a folder in
    its warehouse, and the setting is kept for the session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master == "local" or master.startswith("local["):
            root = "file://" + tempfile.mkdtemp(prefix="statlens-shared-")
        else:
            root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_statlens"
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def new_folder(spark: SparkSession, tag: str) -> str:
    """A path under the shared folder that no other job uses."""
    return f"{shared_root(spark)}/statlens-llm/{tag}-{uuid.uuid4().hex}"


def staged(spark: SparkSession, df: DataFrame, tag: str) -> DataFrame:
    """``df`` written as a Parquet table in the shared folder and reread."""
    path = new_folder(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hand texts to Python in batches of at most ``rows`` rows, unless the session says otherwise.

    Spark's default of 10,000 rows makes batches of tens of MB, which a task holds
    several times (on the JVM's side, as read, and as Python values).
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(rows))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else (``lower`` changes other letters too)."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def text_key(text: str = "text") -> dict[str, Column]:
    """``t1, t2``: 128 bits that stand for a text; null counts as empty."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return {"t1": F.xxhash64(F.lit(1), t), "t2": F.xxhash64(F.lit(2), t)}


def row_key(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """``given, d, t1, t2``: whether a row has an id, the id (0: none) and its text's key; none is null."""
    i = F.col(id_col).cast("long")
    return [i.isNotNull().alias("given"), F.coalesce(i, F.lit(0).cast("long")).alias("d"), *(v.alias(k) for k, v in text_key(text_col).items())]


#: Bits of the bitmap with which ``drop_rows`` tells rows that surely stay, at most (a word of 64 bits is a row that is broadcast).
SIEVE_BITS = 1 << 24


def drop_rows(docs: DataFrame, gone: DataFrame, key: dict[str, Column]) -> DataFrame:
    """Rows of ``docs`` whose id and ``key`` are not in ``gone`` (``doc_id`` and the key's columns); a null id equals a null id.

    So a decision holds for an id and its text: other texts under the same id, or without one, stay.

    Only rows that may be in ``gone`` (a written table) are joined with it: a bitmap
    of its keys, of at most ``SIEVE_BITS / 64`` rows, is broadcast, and rows that it
    rules out pass without a shuffle of their texts.  A full bitmap lets all rows
    through to the join.
    """
    other = gone.select(*(F.col(k).alias(f"__{k}") for k in ("doc_id", *key))).distinct()
    n, bits = gone.count(), 1 << 12
    while bits < min(16 * n, SIEVE_BITS):
        bits *= 2
    names = [f"__{k}" for k in ("doc_id", *key)]
    at = lambda h: F.shiftrightunsigned(h.bitwiseAND(F.lit(bits - 1)), 6)
    bit = F.expr("shiftleft(1L, cast(__h & 63 AS int))")
    marks = other.select(F.xxhash64(*names).alias("__h")).select(at(F.col("__h")).alias("__w"), bit.alias("__b"))
    marks = marks.groupBy("__w").agg(F.bit_or("__b").alias("__b"))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row"), F.col("doc_id").alias("__doc_id"),
                       *(v.alias(f"__{k}") for k, v in key.items())).withColumn("__h", F.xxhash64(*names))
    rows = rows.withColumn("__w", at(F.col("__h"))).join(F.broadcast(marks), "__w", "left")
    doubt = F.coalesce(F.col("__b"), F.lit(0).cast("long")).bitwiseAND(bit) != 0
    left, right, on = rows.where(doubt).alias("l"), other.alias("r"), F.lit(True)
    for k in names:
        on &= F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    return rows.where(~doubt).select("__row.*").unionAll(left.join(right, on, "left_anti").select("__row.*"))


def keep_rows(docs: DataFrame, ids: DataFrame, column: str = "doc_id", keep: bool = True) -> DataFrame:
    """Rows of ``docs`` whose id is (``keep``) or is not in ``ids``; a null id equals a null id."""
    other = ids.select(F.col(column).alias("__id")).distinct()
    return docs.join(other, docs[column].eqNullSafe(other["__id"]), "left_semi" if keep else "left_anti")
