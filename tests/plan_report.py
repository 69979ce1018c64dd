"""Print a markdown table of the final (AQE) physical plan shape per query.

Usage: ``python tests/plan_report.py [sf_dir]``.  Counts shuffles, broadcast
exchanges, join and aggregate operators, windows, scans and whether any scan
received pushed filters.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

OPS = [
    ("shuffles", r"\bExchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)"),
    ("broadcasts", r"\bBroadcastExchange\b"),
    ("SMJ", r"SortMergeJoin"),
    ("BHJ", r"BroadcastHashJoin"),
    ("hash agg", r"\bHashAggregate\b"),
    ("sort agg", r"SortAggregate"),
    ("window", r"\bWindow\b"),
    ("NLJ/cartesian", r"NestedLoopJoin|CartesianProduct"),
]


def shape(plan: str) -> dict:
    # keep the final adaptive plan only; reused stages are counted once
    plan = plan.split("== Initial Plan ==")[0]
    plan = "\n".join(line for line in plan.splitlines() if "ReusedExchange" not in line)
    out = {name: len(re.findall(rx, plan)) for name, rx in OPS}
    out["scans"] = len(re.findall(r"Scan (parquet|orc|json|ExistingRDD)|FileScan", plan))
    out["pushed"] = "yes" if re.search(r"PushedFilters: \[[^\]]*(EqualTo|LessThan|GreaterThan|In\(|IsNotNull)", plan) else "-"
    return out


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from cataloom.session import build_session

    spark = build_session(master="local[8]", checkpoint_dir=tempfile.mkdtemp(prefix="ckpt-", dir="/tmp"))
    import __spark_entry__ as entry

    cols = [name for name, _ in OPS] + ["scans", "pushed"]
    print("| query | " + " | ".join(cols) + " |")
    print("| --- |" + " --- |" * len(cols))
    for name, fn in sorted(entry.queries().items()):
        df = fn(spark, sf_dir)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = shape(plan)
        print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |", flush=True)


if __name__ == "__main__":
    main(sys.argv)
