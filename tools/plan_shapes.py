"""Print the physical-plan shape of registered queries.

Usage: python tools/plan_shapes.py [sf_dir] [query ...]

For each query: number of exchanges (and single-partition ones), broadcast
exchanges, sort-merge / broadcast-hash / nested-loop joins, windows, and the
columns each parquet scan reads.  ``--formatted`` prints the whole plan.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from holecard.plans import queries as q  # noqa: E402
from holecard.session import build_session  # noqa: E402


def shape(plan: str) -> dict:
    return {
        "exchanges": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobin|SinglePartition)", plan)),
        "single_partition": len(re.findall(r"SinglePartition", plan)),
        "broadcasts": len(re.findall(r"BroadcastExchange", plan)),
        "smj": len(re.findall(r"SortMergeJoin", plan)),
        "bhj": len(re.findall(r"BroadcastHashJoin", plan)),
        "nested_loop": len(re.findall(r"BroadcastNestedLoopJoin|CartesianProduct", plan)),
        "windows": len(re.findall(r"\bWindow\b", plan)),
        "read_schemas": sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan))),
    }


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(q.QUERIES)
    spark = build_session("local[8]", shuffle_partitions=16)
    for name in names:
        df = q.QUERIES[name](spark, sf_dir)
        if "--formatted" in sys.argv:
            df.explain("formatted")
            continue
        s = shape(df._jdf.queryExecution().executedPlan().toString())
        schemas = s.pop("read_schemas")
        print(name, " ".join(f"{k}={v}" for k, v in s.items()))
        for r in schemas:
            print("    reads", r)
    spark.stop()


if __name__ == "__main__":
    main()
