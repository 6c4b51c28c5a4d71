"""Plan shape: pushdown, pruning, top-k, scalar subqueries, and no Python in any plan."""

import re

import pytest

import __spark_entry__ as entry_mod
from conftest import SF001
from statlens.plans.registry import QUERIES

FORBIDDEN = ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", list(QUERIES))
def test_no_python_no_cross_join(spark, key):
    p = plan(QUERIES[key](spark, SF001))
    for bad in FORBIDDEN:
        assert bad not in p, f"{key}: {bad}"


def test_year_filter_reaches_scan(spark):
    p = plan(QUERIES["clean_indicator"](spark, SF001))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate,2000-01-01" in p
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in p


def test_fact_tables_pre_aggregated_before_join(spark):
    p = plan(QUERIES["indicator_join"](spark, SF001))
    for key in ("o_custkey", "l_suppkey"):
        assert re.search(rf"HashAggregate\(keys=\[{key}#\d+L?\], functions=\[partial_sum", p), key


def test_one_year_is_shuffled_once_before_the_join(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(QUERIES["indicator_join"](spark, SF001))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    for key in ("o_custkey", "l_suppkey"):
        assert len(re.findall(rf"Exchange hashpartitioning\([^)]*{key}#", p)) == 1, key


def test_top_k_is_take_ordered(spark):
    for key in ("top_k_score", "top_k_index", "first_n"):
        assert "TakeOrderedAndProject" in plan(QUERIES[key](spark, SF001))


def test_thresholds_are_scalar_subqueries(spark):
    for key in ("lower_quartile", "above_medians", "quartile_and_mean", "reference_lines"):
        assert "Subquery" in plan(QUERIES[key](spark, SF001)), key


def test_column_pruning(spark):
    p = plan(QUERIES["lower_quartile"](spark, SF001))
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string,c_acctbal:double>" in p
    assert "c_mktsegment" not in p


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert df.columns == ["Country", "Year", "v", "b", "pop", "q"]
    assert set(QUERIES) <= set(entry_mod.oracle_sql()) <= set(entry_mod.queries())
