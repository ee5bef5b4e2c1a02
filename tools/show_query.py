"""Print a registered query's result (and optionally its plan).

    python tools/show_query.py team_alltime_splits [--sf 0.01] [--rows 20] [--explain]
"""

from __future__ import annotations

import argparse
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("name")
    ap.add_argument("--sf", default="0.01")
    ap.add_argument("--rows", type=int, default=20)
    ap.add_argument("--explain", action="store_true")
    a = ap.parse_args()
    from sideline.plans.catalog import QUERIES
    from sideline.session import get_spark
    spark = get_spark("local[8]", shuffle_partitions=8)
    df = QUERIES[a.name](spark, f"/root/testdata/sf{a.sf}")
    df.show(a.rows, truncate=False)
    if a.explain:
        df.explain("formatted")


if __name__ == "__main__":
    main()
