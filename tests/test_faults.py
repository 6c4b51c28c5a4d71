"""Faults that silently gave wrong rows: header order, half-written tables, label lists, NaN, stale listings."""

import os
import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fixtures import EMPLOYEES_CSV
from statlens.operators import clean, subset
from statlens.plans.snapshot_job import SnapshotDataError, TablePaths, load_snapshot
from statlens.sources.employees import read_employees_csv
from statlens.sources.indicator import read_indicator
from statlens.sources.tables import replace_table
from statlens.sources.testdata import table
from statlens.streaming.refresh import start_refresh


def test_csv_columns_are_bound_by_name(spark, tmp_path):
    p = tmp_path / "e.csv"
    p.write_text("id,department,extra,salary,name\n1,sales,z,10,Ann\n")
    assert tuple(read_employees_csv(spark, str(p)).first()) == (1, "Ann", 10, "sales")
    q = tmp_path / "i.csv"
    q.write_text("Code,Entity,Cantril ladder score,Year\nBGR,Bulgaria,5.5,2021\n")
    assert tuple(read_indicator(spark, str(q), "ladder").first()) == ("Bulgaria", "BGR", 2021, 5.5)
    q.write_text("Code,Entity,Year\nBGR,Bulgaria,2021\n")
    with pytest.raises(ValueError):
        read_indicator(spark, str(q), "ladder")


def test_failed_write_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.range(5), path)
    bad = spark.range(100).select(F.when(F.col("id") > 50, F.raise_error(F.lit("disk"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(PySparkException):
        replace_table(bad, path)
    assert spark.read.parquet(path).count() == 5 and os.listdir(tmp_path) == ["t"]
    replace_table(spark.read.parquet(path).selectExpr("id + 1 AS id"), path)    # it may read the table that it replaces
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 2, 3, 4, 5]


def test_only_data_errors_are_rejected(spark, tmp_path):
    paths = TablePaths(str(tmp_path))
    schema = "id int, name string, salary string, department string"
    from statlens.operators.dept import employees

    with pytest.raises(SnapshotDataError):
        load_snapshot(spark, employees(spark.createDataFrame([(1, "a", "abc", "x")], schema)), paths)
    lost = spark.read.schema("id long").parquet(str(tmp_path / "no such folder")) if False else spark.range(3).select(
        F.expr("assert_true(id < 1, 'x')").cast("string").alias("id"))
    with pytest.raises(Exception) as e:
        load_snapshot(spark, lost.withColumn("n", F.expr("1 / 0")), paths)
    assert not os.path.exists(paths.employees) and e.value is not None


def test_other_errors_fail_the_stream(spark, tmp_path):
    incoming = tmp_path / "in"
    incoming.mkdir()
    (incoming / "a.csv").write_text(EMPLOYEES_CSV)
    q = start_refresh(spark, str(incoming), str(tmp_path / "tables"), name=f"refresh_{uuid.uuid4().hex[:8]}", available_now=True,
                      params={"metric": "clashes with a metrics column"})
    with pytest.raises(Exception):
        q.awaitTermination(300)
    assert not os.path.exists(TablePaths(str(tmp_path / "tables")).rejected)


def test_empty_newest_file_leaves_tables(spark, tmp_path):
    incoming = tmp_path / "in"
    incoming.mkdir()
    (incoming / "a.csv").write_text(EMPLOYEES_CSV)
    (incoming / "b.csv").write_text("id,name,salary,department\n")
    os.utime(incoming / "a.csv", (1_700_000_000, 1_700_000_000))
    os.utime(incoming / "b.csv", (1_700_000_009, 1_700_000_009))
    q = start_refresh(spark, str(incoming), str(tmp_path / "tables"), name=f"refresh_{uuid.uuid4().hex[:8]}", available_now=True)
    q.awaitTermination(300)
    assert q.exception() is None and not os.path.exists(TablePaths(str(tmp_path / "tables")).employees)


@pytest.mark.parametrize("n", [0, 1, 1000, 1001, 5000])
def test_label_lists_of_any_length(spark, n):
    df = spark.range(6000).selectExpr("concat('c', id) AS c")
    labels = [f"c{i}" for i in range(n)]
    assert clean.group_rows(df, "c", labels).count() == n
    assert clean.exclude_groups(df, "c", labels).count() == 6000 - n


def test_label_list_is_pushed_to_the_scan(spark, tmp_path, capsys):
    path = str(tmp_path / "l")
    spark.range(10).selectExpr("concat('c', id) AS c").write.parquet(path)
    clean.group_rows(spark.read.parquet(path), "c", [f"c{i}" for i in range(1001)]).explain()
    assert "PushedFilters: [In(c" in capsys.readouterr().out


def test_nan_is_in_no_band_and_no_quartile(spark):
    df = spark.createDataFrame([(1.0,), (6.0,), (float("nan"),), (None,)], "x double")
    assert [r.x for r in subset.band(df, "x", 5, None).collect()] == [6.0]
    stats_of = df.where("x < 10")
    assert [r.x for r in subset.upper_quartile(df, "x", stats_of=stats_of).collect()] == [6.0]
    assert [r.x for r in subset.above_means(df, ["x"], stats_of=stats_of).collect()] == [6.0]


def test_a_file_added_between_reads_is_seen(spark, tmp_path):
    rows = spark.createDataFrame([(1, "EUROPE")], "r_regionkey int, r_name string")
    rows.write.parquet(str(tmp_path / "region.parquet"))
    assert table(spark, str(tmp_path), "region").count() == 1
    rows.write.mode("append").parquet(str(tmp_path / "region.parquet"))
    assert table(spark, str(tmp_path), "region").count() == 2
