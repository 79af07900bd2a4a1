"""Summarise the physical plans of registered queries (for PLANS.md).

Usage: python tools/plan_report.py [sf_dir] [key ...]
Per query: exchanges by kind, join strategies, scans with their pushed
filters and read schemas, Python stages and subqueries, as Markdown.
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

HEADLINE = [
    "index_interactions",
    "split_train",
    "user_item_plays",
    "user_history",
    "ranking_metrics_per_user",
    "unseen_items",
    "parse_events",
    "drift_report",
    "topk_for_users",
    "latest_batch",
]


def summary(plan: str) -> dict:
    ex = Counter()
    for m in re.finditer(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)[^\n]*", plan):
        kind = m.group(1)
        if kind == "SinglePartition":
            ex["single"] += 1
        else:
            ex[kind.replace("partitioning", "")] += 1
    ex["broadcast"] = plan.count("BroadcastExchange")
    joins = Counter(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)", plan))
    scans = []
    for line in plan.splitlines():
        if "FileScan parquet" in line:
            cols = re.search(r"FileScan parquet \[([^\]]*)\]", line)
            pushed = re.search(r"PushedFilters: \[([^\]]*)\]", line)
            loc = re.search(r"InMemoryFileIndex\(\d+ paths?\)\[([^\],]*)", line)
            table = os.path.basename(loc.group(1)).replace(".parquet", "") if loc else "?"
            scans.append((table, cols.group(1) if cols else "", pushed.group(1) if pushed else ""))
    return {
        "exchanges": dict(ex),
        "joins": dict(joins),
        "scans": scans,
        "python": len(re.findall(r"FlatMapCoGroupsInPandas|ArrowEvalPython|BatchEvalPython|MapInPandas", plan)),
        "subqueries": plan.count("Subquery subquery"),
        "window_group_limit": plan.count("WindowGroupLimit"),
    }


def main(argv):
    from encore.plans import catalog
    from encore.session import local_session

    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:] or HEADLINE
    spark = local_session()
    print("| query | exchanges | joins | python stages | subqueries | scans (columns read; pushed filters) |")
    print("| --- | --- | --- | --- | --- | --- |")
    for k in keys:
        df = catalog.QUERIES[k](spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summary(plan)
        scans = "; ".join(
            f"`{t}`: {re.sub(r'#[0-9L]+', '', c)}" + (f" / {re.sub(r'#[0-9L]+', '', p)[:90]}" if p else "")
            for t, c, p in sorted(set(s["scans"]))
            if not t.startswith("part-") and "encore" not in t
        )
        ex = ", ".join(f"{v} {k}" for k, v in sorted(s["exchanges"].items()) if v)
        jn = ", ".join(f"{v} {k}" for k, v in sorted(s["joins"].items()))
        print(f"| `{k}` | {ex} | {jn} | {s['python']} | {s['subqueries']} | {scans} |")


if __name__ == "__main__":
    main(sys.argv)
