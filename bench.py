"""Benchmark: run every registered query over the test tables, print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed in full with the ``noop`` sink (the whole plan runs,
nothing is collected to the driver).  One untimed warm-up pass compiles
and caches; each query is then timed ``BENCH_REPEAT`` times and the best
time is reported.  ``value`` is the sum of the per-query times; each time
is split into ``build_sec`` (building the DataFrame in the driver, mostly
py4j round trips) and ``execute_sec`` (planning and running it).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from statlens.plans.registry import QUERIES  # noqa: E402
from statlens.session import build_session  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    only = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k]
    keys = only or list(QUERIES)
    spark = build_session(
        f"local[{cpus}]",
        app_name="statlens-bench",
        shuffle_partitions=cpus,
        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")},
    )
    for k in keys:
        run(QUERIES[k](spark, sf_dir))
    times, build, execute = {}, {}, {}
    for k in keys:
        best = (float("inf"), 0.0, 0.0)
        for _ in range(max(1, repeat)):
            t0 = time.perf_counter()
            df = QUERIES[k](spark, sf_dir)      # driver-side plan construction
            t1 = time.perf_counter()
            run(df)                              # planning + execution on the cluster
            t2 = time.perf_counter()
            if t2 - t0 < best[0]:
                best = (t2 - t0, t1 - t0, t2 - t1)
        times[k], build[k], execute[k] = (round(x, 4) for x in best)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "build_sec": round(sum(build.values()), 4),
        "execute_sec": round(sum(execute.values()), 4),
        "execute_queries": execute,
        "cpus": cpus,
        "repeat": repeat,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
