"""Hot keys: one customer and one supplier hold a third of the fact rows.

The derived frames pre-aggregate the fact table on (key, year) before any
join, so the hot key is one partial row per task.  The results must equal the
DuckDB oracle SQL on the same skewed tables.
"""

import datetime as dt
import random

import duckdb
import pytest

from statlens.plans.frames import entity_frame, index_frame
from statlens.plans.registry import ENT, IDX
from statlens.sources.testdata import SCHEMAS
from tools.oracle_check import _rows


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    rnd = random.Random(3)
    root = tmp_path_factory.mktemp("skewed")
    base = dt.datetime(1999, 1, 1)
    data = {
        "region": [(0, "NORTH"), (1, "SOUTH")],
        "nation": [(i, f"N{i}", i % 2) for i in range(4)],
        "customer": [(c, f"C{c}", c % 4, round(rnd.uniform(-999, 9999), 2), "SEG") for c in range(50)],
        "supplier": [(s, f"S{s}", s % 4, round(rnd.uniform(-999, 9999), 2)) for s in range(10)],
        "orders": [(o, 7 if o % 3 == 0 else rnd.randrange(50), "O", round(rnd.uniform(900, 500000), 2),
                    base + dt.timedelta(days=rnd.randrange(3 * 365)), "1-URGENT") for o in range(3000)],
        "lineitem": [(li // 4, 1, 3 if li % 3 == 0 else rnd.randrange(10), li % 4, float(rnd.randint(1, 50)),
                      1.0, 0.05, 0.01, "N", "O", base + dt.timedelta(days=rnd.randrange(3 * 365)))
                     for li in range(6000)],
    }
    for name, rows in data.items():
        spark.createDataFrame(rows, SCHEMAS[name]).write.parquet(str(root / f"{name}.parquet"))
    return str(root)


def _oracle(sf_dir, cte, name):
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    rel = con.execute(f"WITH {cte} SELECT * FROM {name}")
    return [d[0] for d in rel.description], rel.fetchall()


@pytest.mark.parametrize("frame,cte,name", [(entity_frame, ENT, "ent"), (index_frame, IDX, "idx")])
def test_frames_with_hot_keys_match_oracle(spark, skewed, frame, cte, name):
    for year in (None, 2000):
        df = frame(spark, skewed, year)
        cols, rows = _oracle(skewed, cte, name)
        if year is not None:
            rows = [r for r in rows if r[cols.index("Year")] == year]
        assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(cols, rows)


def test_hot_key_is_pre_aggregated(spark, skewed):
    p = entity_frame(spark, skewed, 2000)._jdf.queryExecution().executedPlan().toString()
    # The exchange on the customer key sits above a partial aggregate in the scan stage.
    assert "functions=[partial_sum(cast(o_totalprice" in p
