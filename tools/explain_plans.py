"""Summarise the physical plans of registered queries (after execution, AQE final).

    python tools/explain_plans.py [--sf 0.01] [--full name] [key ...]

Prints, per query: exchanges (shuffles), broadcast and sort-merge joins,
partial WindowGroupLimits, scans with their pushed filters and read schemas.
``--full name`` prints the formatted plan of one query.
"""

from __future__ import annotations

import argparse
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def summary(df) -> dict:
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return {
        # distinct shuffle exchanges (a reused subquery prints its exchange once per use)
        "shuffles": len(set(re.findall(
            r"(?<!Broadcast)Exchange (?:hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)"
            r"[^\n]*?\[plan_id=(\d+)\]", plan))),
        "broadcasts": plan.count("BroadcastExchange"),
        "bhj": plan.count("BroadcastHashJoin"),
        "smj": plan.count("SortMergeJoin"),
        "wgl_partial": len(re.findall(r"WindowGroupLimit .*Partial", plan)),
        "take_ordered": plan.count("TakeOrderedAndProject"),
        "scans": sorted(set(re.findall(r"Location: \w+\(\d+ paths\)\[[^\]]*/([\w_]+)(?:\.parquet)?[^\]]*\]", plan))),
        "pushed": sorted(set(re.findall(r"PushedFilters: (\[[^\]]*\])", plan)) - {"[]"})[:3],
    }


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="0.01")
    ap.add_argument("--full")
    ap.add_argument("keys", nargs="*")
    a = ap.parse_args()
    sf_dir = f"/root/testdata/sf{a.sf}"
    from sideline.plans.catalog import QUERIES
    from sideline.session import get_spark
    spark = get_spark("local[8]", shuffle_partitions=8)
    if a.full:
        df = QUERIES[a.full](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        df.explain("formatted")
        return
    print("| query | shuffles | broadcast joins | sort-merge joins | partial WindowGroupLimit | top-k |")
    print("| --- | --- | --- | --- | --- | --- |")
    for k in a.keys or list(QUERIES):
        s = summary(QUERIES[k](spark, sf_dir))
        print(f"| {k} | {s['shuffles']} | {s['bhj']} | {s['smj']} | {s['wgl_partial']} | "
              f"{s['take_ordered']} |", flush=True)


if __name__ == "__main__":
    main()
