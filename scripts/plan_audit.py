"""Audit the physical plan of every registered query for operators that do
not scale: single-partition exchanges, nested-loop / cartesian joins, Python
evaluation, windows without partitioning, and explicit broadcasts.

    python scripts/plan_audit.py [--sf /root/testdata/sf0.01] [key ...]
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

FLAGS = {
    "single_partition": r"Exchange SinglePartition",
    "nested_loop": r"BroadcastNestedLoopJoin|CartesianProduct",
    "python": r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas",
    "window": r"\bWindow\b",
    "broadcast": r"BroadcastExchange",
    "sort_aggregate": r"SortAggregate",
}


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("keys", nargs="*")
    args = ap.parse_args()
    from playstats.plans.registry import QUERIES
    from playstats.session import get_spark

    spark = get_spark("plan-audit")
    for key in args.keys or sorted(QUERIES):
        df = QUERIES[key](spark, args.sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        exchanges = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan))
        hits = [name for name, pat in FLAGS.items() if re.search(pat, plan)]
        print(f"{key:22s} exchanges={exchanges:2d} {' '.join(hits)}")
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
