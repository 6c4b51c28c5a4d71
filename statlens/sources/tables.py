"""Parquet tables: the collections of the reference re-aimed as tables.

A table is a parquet directory with a fixed schema.  Replacing a table writes
the new content beside it first and switches by renaming once that is complete
and known to be non-empty (Q9: the reference deletes first and can be left with
an empty collection), so a write that fails leaves the old table whole.

A switch takes two renames, so a journal file beside the table names both
versions before the first and goes after the second.  A driver lost in between
leaves the journal and at least one whole version; whoever opens or replaces the
table next (``read_table``, ``replace_table``) finishes the switch.  A table has one
writer at a time.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

INTERNAL_ID = "_id"


class EmptySnapshotError(ValueError):
    """A replacement would have emptied a table."""


class SnapshotDataError(ValueError):
    """A snapshot holds a header, a value or a record that cannot be read; tables are unchanged."""


def read_table(spark: SparkSession, path: str, hide_internal_id: bool = True) -> DataFrame:
    """Full scan of a table (S4); without the store's internal id column.

    A table that is missing because its replacement was cut short is put in place first.
    """
    fs, where = _file_system(spark, path)
    if not fs.exists(where):
        recover(spark, path)
    df = spark.read.parquet(path)
    if hide_internal_id and INTERNAL_ID in df.columns:
        df = df.drop(INTERNAL_ID)
    return df


def replace_table(df: DataFrame, path: str, allow_empty: bool = False) -> None:
    """Replace the table at ``path`` with ``df`` (K1, K2): one evaluation, one write.

    The new table is written beside the old one.  If that fails, or ``df`` turns
    out to be empty, the old table stays as it was.  A replacement that was cut
    short before is finished first.
    """
    spark, new = df.sparkSession, beside(path, "new")
    recover(spark, path)
    try:
        df.write.parquet(new)
        if not allow_empty and spark.read.schema(df.schema).parquet(new).isEmpty():
            raise EmptySnapshotError(f"refusing to replace {path} with an empty snapshot")
    except BaseException:
        delete(spark, new)
        raise
    switch(spark, new, path)


def beside(path: str, tag: str) -> str:
    """A name in ``path``'s folder that readers of the folder skip and no other writer uses."""
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/_{tag}_{name}_{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _file_system(spark, path)
    fs.delete(where, True)


def journal(path: str) -> str:
    """The journal of a table's switch, in its folder under a name that readers skip."""
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/_switch_{name}"


def write_file(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, whole or not at all: written beside it and renamed."""
    fs, to = _file_system(spark, path)
    part = spark._jvm.org.apache.hadoop.fs.Path(beside(path, "part"))
    out = fs.create(part, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(part, to):
        fs.delete(part, False)
        raise FileExistsError(path)


def read_file(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None where there is none."""
    fs, where = _file_system(spark, path)
    if not fs.exists(where):
        return None
    got = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(got, "UTF-8")
    finally:
        got.close()


def switch(spark: SparkSession, new: str, path: str) -> None:
    """Put the complete table ``new`` in the place of ``path``: journal, then ``recover``'s steps."""
    write_file(spark, journal(path), json.dumps({"new": new, "old": beside(path, "old")}))
    recover(spark, path)
    spark.catalog.refreshByPath(path)


def recover(spark: SparkSession, path: str) -> bool:
    """Finish the switch that the table's journal names; whether there was one.

    Every step can be taken again: the old version moves aside unless it has, the
    new one moves into its place unless it has, the old version goes, the journal goes.
    """
    said = read_file(spark, journal(path))
    if said is None:
        return False
    fs, to = _file_system(spark, path)
    make = spark._jvm.org.apache.hadoop.fs.Path
    new, old = (make(json.loads(said)[k]) for k in ("new", "old"))
    if fs.exists(new):
        if fs.exists(to) and not fs.rename(to, old):
            raise OSError(f"cannot move {path} aside")
        if not fs.rename(new, to):
            raise OSError(f"cannot move {new.toString()} to {path}")
    fs.delete(old, True)
    fs.delete(make(journal(path)), False)
    return True


def append_table(df: DataFrame, path: str) -> None:
    """Append rows to a table (the metrics log, K4)."""
    df.write.mode("append").parquet(path)


def write_report_csv(df: DataFrame, path: str) -> None:
    """Write a report as header CSV text files (K3)."""
    df.write.mode("overwrite").option("header", True).csv(path)
