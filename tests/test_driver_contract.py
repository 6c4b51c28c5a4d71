"""The driver's contract, run the way the driver runs it: a fresh process with
a plain default SparkSession (none of this library's session settings)."""

import subprocess
import sys
import textwrap
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent

SCRIPT = textwrap.dedent("""
    import sys
    sys.path.insert(0, {repo!r})
    import duckdb
    from pyspark.sql import SparkSession
    import __spark_entry__ as e
    from tools.oracle_check import _rows

    spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
    df = e.entry(spark)
    assert df.count() > 0
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "orders", "lineitem", "events", "documents", "labels"):
        con.execute(f"CREATE VIEW {{t}} AS SELECT * FROM read_parquet('{{sf}}/{{t}}.parquet')")
    q, sql = e.queries(), e.oracle_sql()
    for key in ("indicator_join", "scalar_stats", "lower_quartile", "bands", "report_table", "group_comparison"):
        got = q[key](spark, sf)
        rel = con.execute(sql[key])
        cols = [d[0] for d in rel.description]
        assert _rows(got.columns, [tuple(r) for r in got.collect()]) == _rows(cols, rel.fetchall()), key
    print("CONTRACT OK")
""")


def test_contract_with_default_session(tmp_path):
    script = tmp_path / "driver.py"
    script.write_text(SCRIPT.format(repo=str(REPO)))
    res = subprocess.run([sys.executable, str(script)], capture_output=True, text=True, timeout=900, cwd=tmp_path)
    assert "CONTRACT OK" in res.stdout, res.stderr[-3000:]
