"""The employee snapshot file (S3).

Salary is read as text and converted by ``operators.dept.to_salary`` so a
bad value raises (as the reference's integer conversion does) instead of
becoming NULL in the CSV reader.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from statlens.operators.dept import employees, salary_fault
from statlens.sources.csvfiles import FILE, MissingColumnsError, NoHeaderError, read_csv_by_name, read_csv_quarantined
from statlens.sources.tables import EmptySnapshotError, SnapshotDataError

EMPLOYEES_RAW_SCHEMA = StructType([
    StructField("id", IntegerType(), True),
    StructField("name", StringType(), True),
    StructField("salary", StringType(), True),
    StructField("department", StringType(), True),
])


def read_employees_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read a snapshot CSV (``id,name,salary,department``, in any order) as a typed snapshot.

    A file without a line raises ``EmptySnapshotError``, one without one of the
    columns ``SnapshotDataError``.
    """
    with _header_faults():
        return employees(read_csv_by_name(spark, path, EMPLOYEES_RAW_SCHEMA))


def read_employees_quarantined(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(the good rows as a typed snapshot, the rejected lines ``file, line, reason``) of a snapshot CSV.

    Rejected are lines that ``read_csv_quarantined`` rejects, and those whose
    salary is missing or not a number.
    """
    with _header_faults():
        good, rejected = read_csv_quarantined(spark, path, EMPLOYEES_RAW_SCHEMA)
    fault = salary_fault(F.col("salary"), good.schema["salary"].dataType)
    names = [f.name for f in EMPLOYEES_RAW_SCHEMA.fields]
    line = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names])
    bad = good.withColumn("_reason", fault).where("_reason IS NOT NULL").select(F.col(FILE).alias("file"), line.alias("line"), F.col("_reason").alias("reason"))
    return employees(good.where(fault.isNull()).select(*names)), rejected.unionAll(bad)


@contextmanager
def _header_faults():
    try:
        yield
    except NoHeaderError as err:
        raise EmptySnapshotError(str(err)) from err
    except MissingColumnsError as err:
        raise SnapshotDataError(str(err)) from err
