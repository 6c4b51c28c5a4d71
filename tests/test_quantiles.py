"""Distributed exact quantiles equal Spark's percentile bit for bit."""

import math
import random

from pyspark.sql import functions as F

from conftest import SF01
from statlens.operators.quantiles import distributed_stats
from statlens.operators.stats import scalar_stats
from statlens.sources.testdata import table

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0, 1 / 3]
NAMES = [f"p{j}" for j in range(len(PROBS))]


def _same(a, b):
    if a is None or b is None:
        return a is None and b is None
    return a == b or (math.isnan(a) and math.isnan(b))


def _check(df, cols, parts=None):
    got = distributed_stats(df, cols, PROBS, NAMES, parts=parts).first()
    exp = df.agg(*[F.percentile(F.col(c).cast("double"), PROBS).alias(c) for c in cols],
                 F.count(F.lit(1)).alias("n")).first()
    assert got["n"] == exp["n"]
    for c in cols:
        e = list(exp[c]) if exp[c] is not None else [None] * len(PROBS)
        for j, nm in enumerate(NAMES):
            assert _same(got[f"{c}_{nm}"], e[j]), (c, PROBS[j], got[f"{c}_{nm}"], e[j])


def test_on_test_tables(spark):
    _check(table(spark, SF01, "customer"), ["c_acctbal", "c_custkey"])
    _check(table(spark, SF01, "lineitem"), ["l_quantity", "l_discount"], parts=3)


def test_hot_value_nulls_nan(spark):
    rnd = random.Random(7)
    rows = [((rnd.choice([1.0, 2.0, 2.0, 3.5, None, float("nan")]) if i % 3 else rnd.random()),
             rnd.choice([None, 1.0, 2.0])) for i in range(3000)]
    rows += [(42.0, None)] * 1500        # one value holds a third of the rows
    _check(spark.createDataFrame(rows, "x double, y double"), ["x", "y"], parts=16)


def test_tiny_and_empty(spark):
    _check(spark.createDataFrame([(5.0,)], "x double"), ["x"])
    _check(spark.createDataFrame([(5.0,), (1.0,)], "x double"), ["x"], parts=4)
    empty = distributed_stats(spark.createDataFrame([], "x double"), ["x"], [0.5]).first()
    assert empty["n"] == 0 and empty["x_q0"] is None


def test_scalar_stats_methods_agree(spark):
    cust = table(spark, SF01, "customer")
    a = scalar_stats(cust, ["c_acctbal"], mean_scale=2, method="distributed").first().asDict()
    b = scalar_stats(cust, ["c_acctbal"], mean_scale=2, method="exact").first().asDict()
    assert a == b


def test_no_single_partition_percentile(spark):
    p = scalar_stats(table(spark, SF01, "customer"), ["c_acctbal"])._jdf.queryExecution().executedPlan().toString()
    assert "percentile(" not in p and "rangepartitioning" in p


def test_approx_method_returns_elements(spark):
    cust = table(spark, SF01, "customer")
    st = scalar_stats(cust, ["c_acctbal"], probs=[0.25, 0.5], method="approx").first()
    values = {r[0] for r in cust.select("c_acctbal").collect()}
    assert st["c_acctbal_p25"] in values and st["c_acctbal_median"] in values


def test_with_stats_attaches_one_row(spark):
    from statlens.operators.stats import with_stats

    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    st = scalar_stats(df, ["x"], probs=[0.5], method="exact")
    rows = with_stats(df, st, ["x_median", "x_mean"]).collect()
    assert len(rows) == 4
    assert {(r["x_median"], r["x_mean"]) for r in rows} == {(2.5, 4.0)}
    plan = with_stats(df, st)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_means_and_quantiles_from_one_scan(spark):
    """Histogram, placement, counts and means read the table once."""
    df = table(spark, SF01, "customer")
    one = distributed_stats(df, ["c_acctbal", "c_custkey"], [0.25, 0.5], ["a", "b"], mean_scale=2)
    exp = df.agg(F.expr("CAST(sum(CAST(c_acctbal AS DECIMAL(28,2))) AS DOUBLE) / count(c_acctbal) AS m"), F.count(F.lit(1)).alias("n")).first()
    got = one.first()
    assert (got["c_acctbal_mean"], got["n"]) == (exp["m"], exp["n"])


def test_scalar_stats_reads_its_table_once(tmp_path):
    """By the event log: the rows that the tasks of ``scalar_stats`` read are those of ``customer``, once."""
    import json
    import subprocess
    import sys
    from pathlib import Path

    code = f"""
from statlens.session import build_session
from statlens.plans.registry import QUERIES
spark = build_session("local[2]", shuffle_partitions=4, extra={{"spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://{tmp_path}", "spark.eventLog.compress": "false"}})
QUERIES["scalar_stats"](spark, {SF01!r}).collect()
spark.stop()
"""
    res = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parent.parent, capture_output=True, text=True, timeout=300)
    assert res.returncode == 0, res.stderr[-2000:]
    read = 0
    for path in tmp_path.rglob("*"):
        for line in path.read_text().splitlines() if path.is_file() and not path.name.endswith(".crc") else ():
            event = json.loads(line)
            if event["Event"] == "SparkListenerTaskEnd":
                read += event["Task Metrics"]["Input Metrics"]["Records Read"]
    assert read == 1500


def test_nulls_nan_and_no_probs(spark):
    df = spark.createDataFrame([(None, 1.0), (2.0, None), (None, float("nan")), (4.0, 3.0)], "x double, y double")
    got = distributed_stats(df, ["x", "y"], [0.5], ["q"]).first()
    assert (got["n"], got["x_q"], got["x_mean"]) == (4, 3.0, 3.0) and got["y_q"] == 3.0 and math.isnan(got["y_mean"])
    got = distributed_stats(df, ["x"], [], []).first()
    assert (got["n"], got["x_mean"]) == (4, 3.0)
    none = distributed_stats(df.where("x < 0"), ["x", "y"], [0.5], ["q"]).first()
    assert none["n"] == 0 and none["x_q"] is None and none["y_mean"] is None
