"""Command line: the source's scripts as subcommands.

    python -m sideline load    --tables DIR --out DIR            # historical load
    python -m sideline load    --landed DIR --out DIR [--play-by-play 2000 2024]   # the same, from landed files
    python -m sideline build   --tables DIR --out DIR [--database mart]
    python -m sideline report  --tables DIR --out DIR            # profiles, drift and coverage as CSV
    python -m sideline peek    --tables DIR [--report top_teams_alltime] [--rows 10]
    python -m sideline update  --out DIR --schedules FEED --weekly FEED [--season N --weeks 1 2] [--game-type REG]
    python -m sideline coaches   --out DIR --feed FEED [--seasons 2024]   # merge into the stored dimension
    python -m sideline divisions --out DIR --csv FILE
    python -m sideline profile   --out DIR [--seasons 2024]      # profile anew only these seasons
    python -m sideline refresh --landing DIR --table DIR --checkpoint DIR [--rejects DIR]

``--tables`` is a folder with the driver's parquet tables.  The session comes
from ``spark-submit`` (or ``--master`` for a local run); on a cluster the
session must name a shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import sys

# Reports that the source exported as CSV files.
CSV_REPORTS = ("profile_schedules", "profile_weekly", "schema_drift", "games_by_season", "weekly_rows_by_season")
PEEK_REPORTS = ("top_teams_alltime", "top_teams_last_season", "top_qbs_alltime",
                "top_coaches_alltime", "rb_leaders_alltime")


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="python -m sideline")
    ap.add_argument("--master", default=None)
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("load", help="derive the fact tables and write them")
    given = p.add_mutually_exclusive_group(required=True)
    given.add_argument("--tables")
    given.add_argument("--landed")
    p.add_argument("--out", required=True)
    p.add_argument("--play-by-play", type=int, nargs=2, metavar=("FIRST", "LAST"), default=None)
    p = sub.add_parser("coaches", help="merge the coaches of played games into the stored dimension")
    p.add_argument("--out", required=True)
    p.add_argument("--feed", required=True)
    p.add_argument("--seasons", type=int, nargs="*", default=None)
    p = sub.add_parser("divisions", help="merge a division CSV into the stored dimension")
    p.add_argument("--out", required=True)
    p.add_argument("--csv", required=True)
    p = sub.add_parser("profile", help="profile the stored weekly table, season by season")
    p.add_argument("--out", required=True)
    p.add_argument("--seasons", type=int, nargs="*", default=None)
    p = sub.add_parser("update", help="refresh the season's completed weeks of the loaded tables")
    p.add_argument("--out", required=True)
    p.add_argument("--schedules", required=True)
    p.add_argument("--weekly", required=True)
    p.add_argument("--season", type=int, default=None)
    p.add_argument("--weeks", type=int, nargs="*", default=None)
    p.add_argument("--game-type", default="REG")
    p = sub.add_parser("build", help="publish every mart as a table")
    p.add_argument("--tables", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--database", default=None)
    p = sub.add_parser("report", help="export profiles, drift and coverage as CSV")
    p.add_argument("--tables", required=True)
    p.add_argument("--out", required=True)
    p = sub.add_parser("peek", help="show leaderboards")
    p.add_argument("--tables", required=True)
    p.add_argument("--report", action="append", choices=PEEK_REPORTS)
    p.add_argument("--rows", type=int, default=10)
    p = sub.add_parser("refresh", help="apply landed in-season weekly files")
    p.add_argument("--landing", required=True)
    p.add_argument("--table", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--rejects", default=None)
    a = ap.parse_args(argv)

    from sideline.session import get_spark
    spark = get_spark(a.master)
    if a.cmd == "load" and a.landed:
        from sideline.plans.pipelines import load_landed, load_play_by_play
        load_landed(spark, a.landed, a.out).show(truncate=False)
        if a.play_by_play:
            first, last = a.play_by_play
            load_play_by_play(spark, a.landed, a.out, range(first, last + 1)).orderBy("season").show(100)
    elif a.cmd == "coaches":
        from sideline.plans.pipelines import merge_coaches
        print("seasons merged:", *[s for (s,) in merge_coaches(spark, a.out, spark.read.parquet(a.feed), a.seasons)])
    elif a.cmd == "divisions":
        from sideline.plans.pipelines import merge_divisions
        print("seasons merged:", *[s for (s,) in merge_divisions(spark, a.out, a.csv)])
    elif a.cmd == "profile":
        from sideline.plans.pipelines import refresh_profiles
        refresh_profiles(spark, a.out, seasons=a.seasons).orderBy("column_name").show(200, truncate=False)
    elif a.cmd == "load":
        from sideline.plans.pipelines import historical_load
        from sideline.plans.warehouse import stage_months
        from sideline.session import ensure_checkpoint_dir
        from sideline.sources import fixtures as FX
        months = stage_months(spark, a.tables, f"{ensure_checkpoint_dir(spark).rstrip('/')}/supplier-months")
        counts = historical_load({"hist_schedules": FX.hist_schedules(spark, a.tables, months),
                                  "hist_weekly": FX.hist_weekly(spark, a.tables, months)}, a.out)
        counts.show(truncate=False)
    elif a.cmd == "update":
        from sideline.plans.pipelines import refresh_tables
        refresh_tables(spark, a.out, spark.read.parquet(a.schedules), spark.read.parquet(a.weekly),
                       a.season, a.weeks, a.game_type).show(100, truncate=False)
    elif a.cmd == "build":
        from sideline.plans.catalog import marts
        from sideline.plans.publish import publish_marts
        publish_marts(marts(spark, a.tables), a.out, database=a.database).show(100, truncate=False)
    elif a.cmd == "report":
        from sideline.plans.catalog import QUERIES
        from sideline.sources.io import write_csv
        for report in CSV_REPORTS:
            print(write_csv(QUERIES[report](spark, a.tables), f"{a.out.rstrip('/')}/{report}"))
    elif a.cmd == "peek":
        from sideline.plans.catalog import QUERIES
        for report in a.report or PEEK_REPORTS:
            print(report)
            QUERIES[report](spark, a.tables).show(a.rows, truncate=False)
    elif a.cmd == "refresh":
        from sideline.streaming.refresh import start_weekly_refresh
        feed_schema = spark.read.parquet(a.landing).schema  # the feed's own columns
        q = start_weekly_refresh(spark, a.landing, a.table, a.checkpoint, feed_schema,
                                 rejects_dir=a.rejects)
        q.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
