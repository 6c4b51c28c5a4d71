"""Employee snapshot and per-department statistics.

``dept_stats`` is one grouped aggregate.  Spark aggregates partially in every
map task before the shuffle, so a department holding a third of all rows
reaches the shuffle as one partial row per task, not as a third of the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from statlens.functions.columns import qcol, require_columns

EMPLOYEE_COLUMNS = ("id", "name", "salary", "department")
STATS_COLUMNS = ("department", "total_salary", "staff_count", "average_salary")


def _whole(number: Column) -> Column:
    """Whether a double is a number within the range of BIGINT."""
    return ~F.isnan(number) & (F.abs(number) < F.lit(2.0 ** 63))


def _salary_value(column: Column, data_type) -> Column:
    """The whole-unit salary; NULL where it is missing, not a number or out of range."""
    if isinstance(data_type, StringType):
        # The digits before the point are the truncated value: no scale is lost
        # on the way.  Other spellings of a number (1e3, .5) go through a double.
        text = F.trim(column)
        plain = text.rlike(r"^[+-]?[0-9]+([.][0-9]*)?$")
        number = F.when(~plain, text.try_cast("double"))
        return (F.when(plain, F.regexp_extract(text, r"^([+-]?[0-9]+)", 1).try_cast("bigint"))
                .when(_whole(number), number.cast("bigint")))
    if isinstance(data_type, NumericType):
        return F.when(_whole(column.cast("double")), column.cast("bigint"))
    raise TypeError(f"salary must be text or numeric, not {data_type.simpleString()}")


def salary_fault(column: Column, data_type) -> Column:
    """Why a salary cannot be taken; NULL for one that can."""
    return (F.when(column.isNull(), F.lit("salary is missing"))
            .when(_salary_value(column, data_type).isNull(), F.concat(F.lit("salary is not a number: '"), column.cast("string"), F.lit("'"))))


def to_salary(column: Column, data_type) -> Column:
    """Whole-unit salary as BIGINT, truncating decimals.

    Like ``astype(int)`` in the reference: ``2000.7 -> 2000``, ``-2.7 ->
    -2``; malformed text (``abc``, empty) raises (ANSI cast), and a missing
    value raises instead of passing through as NULL.
    """
    # The checks hold whatever spark.sql.ansi.enabled is.
    fault = salary_fault(column, data_type)
    return F.when(fault.isNotNull(), F.raise_error(fault)).otherwise(_salary_value(column, data_type))


def employees(
    df: DataFrame,
    id_col: str = "id",
    name_col: str = "name",
    salary_col: str = "salary",
    department_col: str = "department",
) -> DataFrame:
    """Normalise any frame to the employee snapshot ``id, name, salary, department``."""
    require_columns(df, [id_col, name_col, salary_col, department_col])
    return df.select(
        qcol(id_col).alias("id"),
        qcol(name_col).cast("string").alias("name"),
        to_salary(qcol(salary_col), df.schema[salary_col].dataType).alias("salary"),
        qcol(department_col).cast("string").alias("department"),
    )


def dept_stats(emp: DataFrame) -> DataFrame:
    """``department, total_salary, staff_count, average_salary``.

    ``average_salary`` is the true division of the exact BIGINT total by the
    count.  A NULL department is one group (Q11).  Groups are unordered
    (Q10); the report sorts them.
    """
    require_columns(emp, ["salary", "department"])
    agg = emp.groupBy("department").agg(
        F.sum("salary").alias("total_salary"),
        F.count(F.lit(1)).alias("staff_count"),
    )
    return agg.select(
        "department",
        "total_salary",
        "staff_count",
        (F.col("total_salary") / F.col("staff_count")).alias("average_salary"),
    )
