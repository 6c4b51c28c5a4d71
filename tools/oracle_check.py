"""Compare every registered query with its DuckDB SQL (row count, columns, values).

    python tools/oracle_check.py [sf_dir] [key ...]

Values are compared exactly (floats by ``repr``) after sorting rows; a
mismatch that disappears at 1e-9 relative tolerance is reported as ``near``.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from statlens.plans.registry import ORACLE_SQL, QUERIES  # noqa: E402
from statlens.session import build_session  # noqa: E402
from statlens.sources.testdata import TABLES  # noqa: E402


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (2, repr(float(v)))
    if hasattr(v, "isoformat"):
        return (3, v.isoformat())
    if isinstance(v, bool):
        return (4, str(v))
    if isinstance(v, int):
        return (5, str(v))
    return (6, str(v))


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def _close(a, b):
    if len(a) != len(b):
        return False
    for ra, rb in zip(a, b):
        for x, y in zip(ra, rb):
            if x == y:
                continue
            if x[0] == 2 and y[0] == 2:
                fx, fy = float(x[1]), float(y[1])
                if math.isclose(fx, fy, rel_tol=1e-9, abs_tol=1e-12):
                    continue
            return False
    return True


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:] or list(QUERIES)
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    bad = 0
    for k in keys:
        t0 = time.time()
        try:
            df = QUERIES[k](spark, sf)
            cols = df.columns
            srows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"{k:22s} SPARK ERROR {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        sql = ORACLE_SQL.get(k)
        if sql is None:
            print(f"{k:22s} rows={len(srows)} (no oracle) {ts:.2f}s")
            continue
        try:
            rel = con.execute(sql)
            dcols = [d[0] for d in rel.description]
            drows = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{k:22s} DUCKDB ERROR {str(e)[:300]}")
            bad += 1
            continue
        a, b = _rows(cols, srows), _rows(dcols, drows)
        same_cols = sorted(cols) == sorted(dcols)
        status = "OK" if (same_cols and a == b) else ("near" if same_cols and _close(a, b) else "MISMATCH")
        if status != "OK":
            bad += 1
        print(f"{k:22s} {status:8s} rows={len(srows)}/{len(drows)} cols={'ok' if same_cols else (cols, dcols)} {ts:.2f}s")
        if status == "MISMATCH" and os.environ.get("SHOW"):
            sa, sb = set(a), set(b)
            print("   spark only:", sorted(sa - sb)[:3])
            print("   duck only: ", sorted(sb - sa)[:3])
    print("FAILED" if bad else "ALL OK", bad)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
