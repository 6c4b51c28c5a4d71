"""Audited joins (J1) against anti-joins, and stored quantile sketches (I4, A7) against exact ranks."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from statlens.operators.combine import audited_join, indicator_join
from statlens.operators.sketches import column_sketches, merged_quantiles, rank_error, store_sketches
from statlens.sources.testdata import table


@pytest.mark.parametrize("broadcast", ["-1", "10485760"])
def test_account_equals_anti_joins(spark, broadcast):
    rng = random.Random(1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        left = spark.createDataFrame([(rng.choice([None, "a", "b", *map(str, range(30))]), 2000, float(i)) for i in range(60)], "Country string, Year int, v double")
        right = spark.createDataFrame([(rng.choice([None, "a", "c", *map(str, range(20, 60))]), 2000, float(i)) for i in range(50)], "Country string, Year int, q double")
        joined, account = audited_join(left, right)
        want = indicator_join(left, right)
        assert sorted(joined.collect(), key=str) == sorted(want.collect(), key=str) and joined.columns == want.columns
        got = account.get
        assert got["matched"] == want.count()
        assert got["left_unmatched"] == left.join(right, "Country", "left_anti").count() > 0
        assert got["right_unmatched"] == right.join(left, "Country", "left_anti").count() > 0
        for side, name in ((left, "left"), (right, "right")):
            n = side.groupBy("Country").count().where("count > 1").agg(F.sum("count")).first()[0]
            assert round(got[f"{name}_repeated"]) == n
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_account_of_keys_and_empty_sides(spark):
    left = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 2.0)], "Country string, Year int, v double")
    right = spark.createDataFrame([("a", 2, 5.0)], "Country string, Year int, q double")
    joined, account = audited_join(left, right, on=["Country", "Year"])
    assert [tuple(r) for r in joined.collect()] == [("a", 2, 2.0, 5.0)]
    assert account.get == {"matched": 1, "left_unmatched": 1, "right_unmatched": 0, "left_repeated": 0, "right_repeated": 0}
    joined, account = audited_join(left, right.where("q < 0"))
    assert joined.collect() == [] and account.get["left_unmatched"] == 2 and account.get["left_repeated"] == 2


def test_merged_sketches_within_the_stated_error(spark, tmp_path):
    lines = table(spark, SF01, "lineitem").select("l_orderkey", "l_extendedprice", F.expr("l_orderkey % 7").alias("day"))
    path = str(tmp_path / "sketches")
    store_sketches(column_sketches(lines, ["l_extendedprice", "l_orderkey"], by="day"), path)
    store_sketches(column_sketches(lines.where("day = 3"), ["l_extendedprice", "l_orderkey"], by="day"), path)  # a replay replaces
    stored = spark.read.parquet(path)
    assert stored.count() == 14
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    for part, frame in ((stored, lines), (stored.where("snapshot IN (1, 5)"), lines.where("day IN (1, 5)"))):
        n = frame.count()
        for r in merged_quantiles(part, probs).collect():
            below, upto = frame.agg(F.count_if(F.col(r.column) < r.value), F.count_if(F.col(r.column) <= r.value)).first()
            assert r.n == n and r.nulls == 0
            assert below / n - rank_error() <= r.prob <= upto / n + rank_error()


def test_sketches_of_nulls_nan_and_nothing(spark):
    df = spark.createDataFrame([(1, 1.0, None), (1, float("nan"), None), (2, None, None), (2, 3.0, None)], "s int, x double, y double")
    got = {(r.column, r.prob): r for r in merged_quantiles(column_sketches(df, ["x", "y"], by="s"), [0.0, 1.0]).collect()}
    assert (got["x", 0.0].value, got["x", 1.0].value, got["x", 0.0].n, got["x", 0.0].nulls) == (1.0, 3.0, 2, 2)
    assert got["y", 0.0].value is None and got["y", 0.0].nulls == 4
    assert merged_quantiles(column_sketches(df.where("s > 5"), ["x"]), [0.5]).collect() == []
