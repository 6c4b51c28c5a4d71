"""CSV files with a header row, their columns bound by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from statlens.functions.columns import qcol, quote

CORRUPT, FILE = "_corrupt_record", "_file"


class NoHeaderError(ValueError):
    """A CSV file without a line."""


class MissingColumnsError(ValueError):
    """A CSV file whose header lacks columns."""


def _header(spark: SparkSession, path: str, schema: StructType, sep: str) -> list[str]:
    """The file's columns; raises if it has no line or lacks a column of ``schema``."""
    header = spark.read.option("header", True).option("sep", sep).csv(path).columns
    if not header:
        raise NoHeaderError(f"no header in {path}")
    missing = [n for n in schema.names if n not in header]
    if missing:
        raise MissingColumnsError(f"columns not in the header of {path}: {missing}; it has {header}")
    return header


def read_csv_by_name(spark: SparkSession, path: str, schema: StructType, sep: str = ",") -> DataFrame:
    """The columns of ``schema``, in its order, wherever the file has them.

    The header line tells the file's own order (other columns are read as text
    and dropped); a missing column raises.  Every further file under ``path`` is
    held against that header (``enforceSchema=false``) and raises if it differs,
    as do rows that don't fit (``FAILFAST``).
    """
    header = _header(spark, path, schema, sep)
    own = StructType([schema[c] if c in schema.names else StructField(c, StringType(), True) for c in header])
    reader = spark.read.option("header", True).option("sep", sep).option("mode", "FAILFAST").option("enforceSchema", False)
    return reader.schema(own).csv(path).select(*[quote(n) for n in schema.names])


def read_csv_quarantined(spark: SparkSession, path: str, schema: StructType, sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """(good rows with the columns of ``schema`` and ``_file``, rejected lines ``file, line, reason``) of CSV files.

    Every field is read as text (``PERMISSIVE``).  A line is rejected if it has
    another number of fields than the header, or a field that is no value of its
    column's type; the reason names the first such column.  Empty fields are
    NULL and no fault.  A header that lacks a column still raises.
    """
    header = _header(spark, path, schema, sep)
    text = StructType([StructField(c, StringType(), True) for c in [*header, CORRUPT]])
    reader = (spark.read.option("header", True).option("sep", sep).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", CORRUPT).option("enforceSchema", False))
    rows = reader.schema(text).csv(path).withColumn(FILE, F.col("_metadata.file_path"))
    faults = [F.when(qcol(CORRUPT).isNotNull(), F.lit(f"not {len(header)} fields"))]
    for field in schema.fields:
        bad = qcol(field.name).isNotNull() & qcol(field.name).try_cast(field.dataType).isNull()
        faults.append(F.when(bad, F.concat(F.lit(f"{field.name} is not {field.dataType.simpleString()}: "), qcol(field.name))))
    rows = rows.withColumn("_reason", F.coalesce(*faults))
    good = rows.where("_reason IS NULL").select(*[qcol(f.name).cast(f.dataType).alias(f.name) for f in schema.fields], FILE)
    line = F.coalesce(qcol(CORRUPT), F.concat_ws(sep, *[F.coalesce(qcol(c), F.lit("")) for c in header]))
    return good, rows.where("_reason IS NOT NULL").select(qcol(FILE).alias("file"), line.alias("line"), qcol("_reason").alias("reason"))
