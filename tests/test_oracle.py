"""Every registered query against its DuckDB SQL on the sf0.01 test tables."""

import duckdb
import pytest

from conftest import SF01
from statlens.plans.registry import ORACLE_SQL, QUERIES
from statlens.sources.testdata import TABLES
from tools.oracle_check import _rows


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    return c


def test_every_query_has_sql():
    assert set(ORACLE_SQL) == set(QUERIES)


@pytest.mark.parametrize("key", list(QUERIES))
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF01)
    srows = [tuple(r) for r in df.collect()]
    rel = con.execute(ORACLE_SQL[key])
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _rows(df.columns, srows) == _rows(dcols, drows)


def test_rows_are_lost_where_the_operators_must_lose_them(spark):
    """Without the year filter, the inner join or the outer alignment these queries would have other rows."""
    from statlens.plans.frames import entity_frame
    from statlens.plans.registry import QUERIES, ent_countries, idx_countries

    assert 0 < QUERIES["year_filter"](spark, SF01).count() < entity_frame(spark, SF01).count() / 3
    n = QUERIES["subset_join"](spark, SF01).count()
    assert 0 < n < min(ent_countries(spark, SF01).where("v > 0").count(), idx_countries(spark, SF01).count()) / 2
    values = QUERIES["group_comparison_missing"](spark, SF01)
    assert values.where("label = 'World' AND value IS NULL").count() == 2 and values.where("label = 'NOWHERE' AND value IS NULL").count() == 2
    assert 0 < values.where("series = 'q_x10' AND value IS NOT NULL").count() < values.where("series = 'v' AND value IS NOT NULL").count()
