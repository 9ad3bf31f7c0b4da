"""Counts of plan nodes of the library's queries, as the table of PLANS.md (planned tree, before adaptive re-planning)."""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from logweave.plans import load_all  # noqa: E402
from logweave.session import get_spark  # noqa: E402

NODES = {"hash exch.": r"Exchange hashpartitioning", "range exch.": r"Exchange rangepartitioning", "single-partition exch.": r"Exchange SinglePartition",
         "broadcast joins": r"BroadcastHashJoin", "sort-merge joins": r"SortMergeJoin", "windows": r"\bWindow\b", "loop or cross joins": r"BroadcastNestedLoopJoin|CartesianProduct"}

if __name__ == "__main__":
    spark = get_spark(master="local[4]", shuffle_partitions=8)
    only = set(sys.argv[2:])
    print("| Query | " + " | ".join(NODES) + " |\n|" + "---|" * (len(NODES) + 1), flush=True)
    for name, q in load_all().items():
        if not only or name in only or q.fn.__module__.rsplit(".", 1)[-1] in only:
            plan = q.fn(spark, sys.argv[1])._jdf.queryExecution().executedPlan().toString()
            print(f"| {name} | " + " | ".join(str(len(re.findall(p, plan))) for p in NODES.values()) + " |", flush=True)
