"""Results do not depend on the session's plan settings.

The driver brings its own session.  With broadcast joins off (every join a
sort-merge join), AQE off, ANSI off and 200 shuffle partitions, a
representative set of queries must still equal the DuckDB oracle.
"""

import duckdb
import pytest

from conftest import SF01
from statlens.plans.registry import ORACLE_SQL, QUERIES
from statlens.sources.testdata import TABLES
from tools.oracle_check import _rows

KEYS = ["clean_indicator", "indicator_join", "quartile_and_mean", "scalar_stats", "lower_quartile",
        "group_comparison", "top_k_score", "drop_nulls", "dept_stats", "report_table", "bands"]
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.enabled": "false",
    "spark.sql.ansi.enabled": "false",
    "spark.sql.shuffle.partitions": "200",
}


@pytest.fixture(scope="module")
def other_settings(spark):
    old = {k: spark.conf.get(k) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", KEYS)
def test_same_result_under_other_settings(other_settings, con, key):
    df = QUERIES[key](other_settings, SF01)
    if key in ("clean_indicator", "indicator_join"):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    rel = con.execute(ORACLE_SQL[key])
    dcols = [d[0] for d in rel.description]
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(dcols, rel.fetchall())
