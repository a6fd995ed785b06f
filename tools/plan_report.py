"""Write PLANS.md: for every registered query, the shape of its final physical plan
(after AQE) on a given scale: shuffles by kind, join strategies, windows, Python
nodes, and what the scans read.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from strandline.plans.queries import QUERIES  # noqa: E402
from strandline.session import build_session  # noqa: E402

KINDS = [
    ("hash shuffles", r"Exchange hashpartitioning"),
    ("range shuffles", r"Exchange rangepartitioning"),
    ("round-robin", r"Exchange RoundRobinPartitioning"),
    ("single-partition", r"Exchange SinglePartition"),
    ("broadcasts", r"BroadcastExchange"),
    ("BHJ", r"BroadcastHashJoin"),
    ("SMJ", r"SortMergeJoin"),
    ("windows", r"\bWindow \["),
    ("python", r"MapInPandas|ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas"),
]


def final_plan(df) -> str:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Initial Plan ==")[0]          # AQE appends the initial plan
    # a reused exchange repeats the description of the one it reuses: not a new shuffle
    return "\n".join(ln for ln in plan.splitlines() if "ReusedExchange" not in ln)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8, app="plan-report")
    print("# PLANS\n")
    print(f"Final physical plans (after AQE) of every registered query on `{sf_dir}`, "
          "generated by `tools/plan_report.py`.  Counts are plan nodes of the query "
          "itself; tables written beforehand by `materialize` / `broadcast_checked` "
          "(size checks, phase-1 tables) appear as scans.  Reused exchanges are "
          "counted once, and a scan below a reused exchange is not listed again "
          "(`fastq_chunks`: both mates and the pair-count subquery share one scan).\n")
    print("| query | " + " | ".join(k for k, _ in KINDS) + " | scans (columns read) |")
    print("| --- | " + " | ".join("---" for _ in KINDS) + " | --- |")
    plans = {}
    for name, fn in QUERIES.items():
        plan = plans[name] = final_plan(fn(spark, sf_dir))
        counts = [len(re.findall(p, plan)) for _, p in KINDS]
        scans = re.findall(r"FileScan parquet \S*\[([^\]]*)\]", plan)
        cols = sorted({len(s.split(",")) for s in scans})
        print(f"| `{name}` | " + " | ".join(str(c) for c in counts)
              + f" | {len(scans)} ({', '.join(map(str, cols))}) |")
    print()
    print("## Selected final plans\n")
    print("Operator trees (AQE final plans, expressions cut at 110 characters).\n")
    for name in SELECTED:
        print(f"### `{name}`\n\n```")
        for ln in plans[name].splitlines():
            print(ln[:110].rstrip())
        print("```\n")


SELECTED = ["covered_ranges", "interval_restrict", "mark_duplicates", "pileup", "recal_apply"]


if __name__ == "__main__":
    main()
