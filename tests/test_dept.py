"""Department statistics: golden values on the reference's 25 sample rows, and edges."""

import pytest
from pyspark.errors import PySparkException

from conftest import rows
from fixtures import EMPLOYEES_CSV, EMPLOYEES_STATS
from statlens.operators.dept import dept_stats, employees
from statlens.operators.publish import report_table, run_metrics
from statlens.sources.employees import read_employees_csv


@pytest.fixture(scope="module")
def emp_csv(tmp_path_factory):
    p = tmp_path_factory.mktemp("emp") / "employers.csv"
    p.write_text(EMPLOYEES_CSV)
    return str(p)


@pytest.fixture(scope="module")
def stats(spark, emp_csv):
    return dept_stats(read_employees_csv(spark, emp_csv))


def test_golden_stats(stats):
    got = {r["department"]: (r["total_salary"], r["staff_count"], r["average_salary"]) for r in stats.collect()}
    assert got == EMPLOYEES_STATS
    assert dict(stats.dtypes) == {"department": "string", "total_salary": "bigint",
                                  "staff_count": "bigint", "average_salary": "double"}


def test_report_table(stats):
    rep = report_table(stats)
    assert rep.columns == ["department", "total_salary", "staff_count", "average_salary"]
    got = [tuple(r) for r in rep.collect()]
    assert got[0] == ("finance", "22400", "4", "5600.0")
    assert got[2] == ("it", "60300", "7", "8614.285714285714")
    assert [g[0] for g in got] == sorted(EMPLOYEES_STATS)


def test_run_metrics(stats):
    m = run_metrics(stats, "run1", {"source": "employees", "destination": "report"})
    got = {r["metric"]: r["value"] for r in m.collect()}
    assert len(got) == 10
    assert got["it_staff_count"] == 7.0 and got["sales_avg_salary"] == 2000.0
    assert set(m.columns) == {"run_name", "source", "destination", "metric", "value"}


def test_run_metrics_skip_null(spark):
    s = spark.createDataFrame([("a", 10, 1, None)], "department string, total_salary bigint, staff_count bigint, average_salary double")
    assert rows(run_metrics(s, "r", {}), "metric") == [("a_staff_count",)]


@pytest.mark.parametrize("text,expected", [("2000", 2000), ("2000.7", 2000), ("2000.9999999", 2000), ("-0.9999999", 0), ("1e3", 1000), (".5", 0), ("-2.7", -2), (" 15 ", 15)])
def test_salary_truncates(spark, text, expected):
    df = spark.createDataFrame([(1, "x", text, "d")], "id int, name string, salary string, department string")
    assert employees(df).first()["salary"] == expected


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("value", [float("nan"), float("inf"), 1e19])
def test_salary_out_of_range_raises(spark, ansi, value):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([(1, "x", value, "d")], "id int, name string, salary double, department string")
        with pytest.raises(PySparkException):
            employees(df).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


@pytest.mark.parametrize("text", ["abc", "", None])
def test_salary_bad_raises(spark, text):
    df = spark.createDataFrame([(1, "x", text, "d")], "id int, name string, salary string, department string")
    with pytest.raises(PySparkException):
        employees(df).collect()


def test_null_department_is_one_group(spark):
    df = spark.createDataFrame([(1, "a", 10.0, None), (2, "b", 20.0, None), (3, "c", 5.0, "x")],
                               "id int, name string, salary double, department string")
    got = {r["department"]: r["staff_count"] for r in dept_stats(employees(df)).collect()}
    assert got == {None: 2, "x": 1}
    rep = report_table(dept_stats(employees(df))).collect()
    assert rep[0]["department"] == ""   # NULL -> "" in the report (Q12)


@pytest.mark.parametrize("text", ["abc", ""])
def test_salary_bad_raises_without_ansi(spark, text):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        df = spark.createDataFrame([(1, "x", text, "d")], "id int, name string, salary string, department string")
        with pytest.raises(PySparkException):
            employees(df).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
