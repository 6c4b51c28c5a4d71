"""Plan audit: run every registered query and tabulate its final (AQE) physical plan.

    python tools/plan_audit.py [sf_dir] > PLANS.md

Counts per query: shuffle exchanges by kind, broadcast exchanges, join
strategies, scalar subqueries, top-k operators, pushed scan filters and the
widest scan (columns read).  Python evaluation, cartesian products and
nested-loop joins are flagged.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from statlens.plans.registry import QUERIES  # noqa: E402
from statlens.session import build_session  # noqa: E402


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def _text_start(line: str) -> int:
    return len(line) - len(line.lstrip(" :|+-"))


def final_only(plan: str) -> str:
    """Drop every ``== Initial Plan ==`` block (AQE prints the pre-execution plan
    after the final one, and repeats nested subqueries inside it)."""
    kept, skip_below = [], None
    for line in plan.split("\n"):
        start = _text_start(line)
        if skip_below is not None:
            if start >= skip_below:
                continue
            skip_below = None
        if "== Initial Plan ==" in line:
            skip_below = start
            continue
        kept.append(line)
    return "\n".join(kept)


def audit(plan: str) -> dict:
    final = final_only(plan)
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", final)
    pushed = [p for p in pushed if p and any(not x.strip().startswith("IsNotNull") for x in p.split(", "))]
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", final)
    widest = max((s.count(":") for s in schemas), default=0)
    return {
        "hash": len(re.findall(r"Exchange hashpartitioning", final)),
        "range": len(re.findall(r"Exchange rangepartitioning", final)),
        "single": len(re.findall(r"Exchange SinglePartition", final)),
        "bcast": len(re.findall(r"BroadcastExchange", final)),
        "reused": len(re.findall(r"Reused(Exchange|Subquery)", final)),
        "bhj": len(re.findall(r"BroadcastHashJoin", final)),
        "smj": len(re.findall(r"SortMergeJoin", final)),
        "subq": len(set(re.findall(r"Subquery subquery#\d+", final))),
        "topk": len(re.findall(r"TakeOrderedAndProject", final)),
        "pushed": len(pushed),
        "widest": widest,
        "flags": ",".join(sorted({f for f in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython",
                                                "CartesianProduct", "BroadcastNestedLoopJoin")
                                  if f in final})) or "-",
    }


def main(argv) -> None:
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=8,
                          extra={"spark.sql.maxMetadataStringLength": "100000"})
    cols = ["hash", "range", "single", "bcast", "reused", "bhj", "smj", "subq", "topk", "pushed", "widest", "flags"]
    print(f"# Plan audit ({os.path.basename(sf)}, final AQE plans)\n")
    print("Generated by `tools/plan_audit.py`. Columns: shuffle exchanges (hash, range, single-partition "
          "merges of one-row partial aggregates), broadcast exchanges, reused exchanges/subqueries, "
          "broadcast-hash and sort-merge joins, scalar subqueries, top-k operators, scans with a pushed "
          "filter beyond IS NOT NULL, columns read by the widest scan, and flags for Python evaluation, "
          "cartesian products or nested-loop joins (none expected).\n")
    print("| query | " + " | ".join(cols) + " |")
    print("|---" * (len(cols) + 1) + "|")
    for key, fn in QUERIES.items():
        a = audit(final_plan(fn(spark, sf)))
        print(f"| {key} | " + " | ".join(str(a[c]) for c in cols) + " |")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
