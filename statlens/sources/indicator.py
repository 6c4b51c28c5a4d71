"""Indicator files: delimited text with a header row.

The reference reads each file with ``inferSchema``, which costs an extra
pass over the file before the query starts.  Here the schema is given; the
three known files have their schemas below (taken from the reference's
schema dumps) and inference stays available as an opt-in.  Any Hadoop
file-system URI (``hdfs://``, ``s3a://``, ``file:``) is passed through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from statlens.sources.csvfiles import read_csv_by_name


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


# Column names and types of the three indicator files.
LADDER_SCHEMA = _schema(
    ("Entity", StringType()),
    ("Code", StringType()),
    ("Year", IntegerType()),
    ("Cantril ladder score", DoubleType()),
)
POVERTY_LIFE_SCHEMA = _schema(
    ("Entity", StringType()),
    ("Code", StringType()),
    ("Year", IntegerType()),
    ("Life expectancy - Sex: all - Age: 0 - Variant: estimates", DoubleType()),
    ("$2.15 a day - Share of population in poverty", DoubleType()),
    ("990305-annotations", StringType()),
    ("Population (historical)", LongType()),
    ("World regions according to OWID", StringType()),
)
CORRUPTION_SCHEMA = _schema(
    ("Entity", StringType()),
    ("Code", StringType()),
    ("Year", IntegerType()),
    ("Political corruption index (best estimate, aggregate: average)", DoubleType()),
)

SCHEMAS = {"ladder": LADDER_SCHEMA, "poverty_life": POVERTY_LIFE_SCHEMA, "corruption": CORRUPTION_SCHEMA}


def read_indicator(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    infer: bool = False,
    sep: str = ",",
) -> DataFrame:
    """Read an indicator CSV with a header row.

    ``schema`` is a ``StructType`` or a key of ``SCHEMAS``.  With no schema,
    ``infer=True`` must be asked for explicitly (it scans the file twice).
    Columns are bound by header name.  Rows that do not fit the schema raise (``FAILFAST``) rather than turning
    into silent NULLs.
    """
    if isinstance(schema, str):
        schema = SCHEMAS[schema]
    if schema is not None:
        return read_csv_by_name(spark, path, schema, sep)
    if not infer:
        raise ValueError("give a schema, or infer=True to let Spark scan the file for one")
    reader = spark.read.option("header", True).option("sep", sep).option("mode", "FAILFAST")
    return reader.option("inferSchema", True).csv(path)
