"""Summarise the executed (AQE final) physical plan of every batch query:
exchanges, join strategies, window and aggregate operators, pushed filters.

usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from postscope.plans.catalog import QUERIES  # noqa: E402
from postscope.session import get_session  # noqa: E402


def summary(plan: str) -> dict:
    plan = plan.split("== Initial Plan ==")[0]
    ex = re.findall(r"(?<!Reused)Exchange (hashpartitioning\([^)]*\)|RoundRobinPartitioning\(\d+\)|rangepartitioning\([^)]*\)|"
                    r"SinglePartition|HashedRelationBroadcastMode)", plan)
    ex = [re.sub(r"#\d+L?", "", e) for e in ex]
    ops = {k: plan.count(k) for k in ("ReusedExchange", "BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin",
                                      "Window", "HashAggregate", "ObjectHashAggregate", "SortAggregate",
                                      "Generate", "MergingSessions")}
    pushed = sorted(set(re.findall(r"PushedFilters: \[([^\]]*)\]", plan)) - {""})
    return {"exchanges": ex, "ops": {k: v for k, v in ops.items() if v}, "pushed": pushed}


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", shuffle_partitions=16)
    print("# Physical plans (AQE final plans, sf = %s)\n" % os.path.basename(sf))
    print("Generated by `tools/plan_report.py`; queries that write tables when called are left out, for the")
    print("sliced ones the plan starts from the sliced rows.\n")
    print("| query | exchanges | operators | pushed filters |")
    print("| --- | --- | --- | --- |")
    for name, fn in QUERIES.items():
        if name.startswith("stream_") or re.search("archive|documents$|live_feed|ingest|reports", name) and name not in (
                "historic_stats_documents", "quarantine_documents"):
            continue
        df = fn(spark, sf)
        df.collect()          # runs the DataFrame's own plan, so AQE prints its final form
        s = summary(df._jdf.queryExecution().executedPlan().toString())
        exs = "<br>".join(s["exchanges"]) or "none"
        ops = ", ".join(f"{k}×{v}" for k, v in s["ops"].items()) or "-"
        pushed = "<br>".join(s["pushed"]) or "-"
        print(f"| `{name}` | {exs} | {ops} | {pushed} |")


if __name__ == "__main__":
    main()
