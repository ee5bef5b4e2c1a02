"""Leaderboards and ordered reports over the marts.

Each report is ``where -> orderBy -> limit -> select``, which Spark plans as
``TakeOrderedAndProject``: every task keeps its own top k and only k rows
per task reach the final merge, whatever the table size.  A unique column
closes every ordering, so ties cannot make the result depend on the plan.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sideline.operators.games import in_latest_season, played, vs500_leaderboard
from sideline.operators.players import player_games
from sideline.plans.marts import Marts
from sideline.session import ensure_checkpoint_dir
from sideline.sources.io import in_slices


def top(df: DataFrame, order: list[Column], k: int, columns: list[str],
        where: Column | None = None) -> DataFrame:
    if where is not None:
        df = df.where(where)
    return df.orderBy(*order).limit(k).select(*columns)


def d(c: str) -> Column:
    """Descending, NULLs last (the reports spell it out)."""
    return F.col(c).desc_nulls_last()


def a(c: str) -> Column:
    return F.col(c).asc_nulls_last()


TEAM_TOP = ["team", "games", "wins", "losses", "ties", "win_pct"]
QB_TOP = ["qb_id", "qb_name", "games", "wins", "losses", "ties", "win_pct",
          "games_home", "wins_home", "games_away", "wins_away",
          "games_primetime", "wins_primetime", "games_playoff", "wins_playoff",
          "games_vs_500", "wins_vs_500"]
COACH_TOP = ["head_coach"] + QB_TOP[2:]
RB_TOP = ["player_id", "player_name", "games", "total_yards", "rushing_yards", "receiving_yards",
          "rushing_attempts", "targets", "total_tds", "avg_yards_per_game"]
REC_TOP = ["player_id", "player_name", "games", "receiving_yards", "receptions", "targets",
           "receiving_tds", "total_yards", "avg_rec_yards_per_game"]
QB_STATS_TOP = ["player_id", "player_name", "games", "passing_yards", "completions", "attempts",
                "passing_tds", "interceptions", "rushing_yards", "total_yards_qb",
                "avg_pass_yards_per_game", "passing_tds_primetime"]


def top_teams_alltime(m: Marts, k: int = 10) -> DataFrame:
    return top(m.team_alltime_splits, [d("win_pct"), d("wins"), a("team")], k, TEAM_TOP)


def top_teams_last_season(m: Marts, k: int = 10) -> DataFrame:
    return top(m.team_last_season_splits, [d("win_pct"), d("wins"), a("team")], k,
               ["season", "team", "wins_home", "wins_away", "wins", "losses", "ties", "win_pct"])


def top_qbs_alltime(m: Marts, k: int = 20) -> DataFrame:
    return top(m.qb_alltime_splits, [d("wins"), a("qb_id")], k, QB_TOP)


def top_qbs_last_season(m: Marts, k: int = 20) -> DataFrame:
    return top(m.qb_last_season_splits, [d("wins"), d("win_pct"), a("qb_id")], k,
               ["season", "qb_id", "qb_name", "games", "wins", "losses", "ties", "win_pct",
                "games_primetime", "wins_primetime", "games_playoff", "wins_playoff"])


def top_coaches_alltime(m: Marts, k: int = 20) -> DataFrame:
    return top(m.coach_alltime_splits, [d("wins"), a("head_coach")], k, COACH_TOP)


def rb_leaders_alltime(m: Marts, k: int = 25, min_games: int = 16) -> DataFrame:
    return top(m.position_alltime("RB"), [d("total_yards"), a("player_id")], k,
               RB_TOP + ["tds_primetime", "yards_primetime"], where=F.col("games") >= min_games)


def rb_leaders_last_season(m: Marts, k: int = 25) -> DataFrame:
    return top(m.position_last_season("RB"), [d("total_yards"), a("player_id")], k, RB_TOP)


def rb_primetime_leaders(m: Marts, k: int = 20) -> DataFrame:
    return top(m.position_alltime("RB"), [d("tds_primetime"), d("yards_primetime"), a("player_id")], k,
               ["player_id", "player_name", "tds_primetime", "yards_primetime", "total_tds", "games"],
               where=F.col("tds_primetime").isNotNull())


def _hot_last3(m: Marts, group: str, avg_col: str, cols: list[str], k: int) -> DataFrame:
    roll = in_latest_season(m.rolling3(group), m.schedules)
    return top(roll, [d(avg_col), a("player_id"), a("week")], k, cols)


def rb_hot_last3(m: Marts, k: int = 25) -> DataFrame:
    return _hot_last3(m, "RB", "avg_yards_last3",
                      ["player_id", "player_name", "team", "season", "week",
                       "avg_yards_last3", "yards_last3", "tds_last3"], k)


def qb_hot_last3(m: Marts, k: int = 25) -> DataFrame:
    return _hot_last3(m, "QB", "avg_pass_yards_last3",
                      ["player_id", "player_name", "team", "season", "week",
                       "pass_yards_last3", "avg_pass_yards_last3", "pass_tds_last3"], k)


def wr_leaders_alltime(m: Marts, k: int = 25, min_games: int = 16) -> DataFrame:
    return top(m.position_alltime("WR"), [d("receiving_yards"), a("player_id")], k, REC_TOP,
               where=F.col("games") >= min_games)


def te_leaders_alltime(m: Marts, k: int = 25, min_games: int = 16) -> DataFrame:
    return top(m.position_alltime("TE"), [d("receiving_yards"), a("player_id")], k, REC_TOP,
               where=F.col("games") >= min_games)


def qb_leaders_alltime(m: Marts, k: int = 25, min_games: int = 16) -> DataFrame:
    return top(m.position_alltime("QB"), [d("passing_yards"), a("player_id")], k, QB_STATS_TOP,
               where=F.col("games") >= min_games)


def rb_home_away_top(m: Marts, k: int = 25) -> DataFrame:
    from sideline.operators.players import rb_home_away_splits
    s = rb_home_away_splits(m.player_games)
    return top(s, [d("yards_primetime"), a("player_name")], k, s.columns)


def def_rank_qb_top10(m: Marts, k: int = 10, group: str = "QB") -> DataFrame:
    """Best defences against a position in the latest season *of the rank view*.

    Every season of the view has all four position groups, so the latest
    season per group is the view's latest season; a window per group (at
    most seasons x teams rows, bounded by the calendar) finds it in the same
    branch, instead of a second evaluation of the whole rank view.
    """
    latest = F.max("season").over(Window.partitionBy("position_group"))
    r = (m.def_rank_by_pos.where(F.col("position_group") == group)
         .withColumn("_latest", latest)
         .where(F.col("season") == F.col("_latest")))
    return top(r, [a("def_rank_pos"), a("team")], k,
               ["season", "team", "position_group", "yards_per_game", "def_rank_pos"])


def scored_sample(schedules: DataFrame, k: int = 10, start: int | None = None,
                  end: int | None = None) -> DataFrame:
    """First scored games by season and week, optionally in a season range."""
    g = played(schedules)
    if start is not None:
        g = g.where(F.col("season") >= start)
    if end is not None:
        g = g.where(F.col("season") <= end)
    return top(g, [a("season"), a("week"), a("game_id")], k,
               ["game_id", "season", "week", "gameday", "home_team", "away_team",
                "home_score", "away_score"])


def newest_first(weekly: DataFrame, enough) -> DataFrame:
    """The rows of the newest (season, week) partitions, as many of them as ``enough(rows)`` asks for.

    The partitions are known without reading a column; each try doubles how
    many of them are taken, as a literal filter on the partition columns, so
    older files are never opened.
    """
    weeks = weekly.select("season", "week").where("season is not null and week is not null").distinct()
    newest = [(r["season"], r["week"]) for r in weeks.orderBy(F.desc("season"), F.desc("week")).collect()]
    take = 1
    while take < len(newest):
        some = weekly.where(in_slices(newest[:take]))
        if enough(some):
            return some
        take *= 2
    return weekly


def player_games_latest(m: Marts, k: int = 20) -> DataFrame:
    def games(weekly: DataFrame) -> DataFrame:
        return player_games(weekly, m.team_games_enriched, m.schedules)

    weekly = newest_first(m.weekly, lambda some: games(some).limit(k).count() >= k)
    return top(games(weekly), [d("season"), d("week"), a("player_id")], k,
               ["player_id", "season", "week", "team", "player_name", "position_group",
                "rushing_attempts", "rushing_yards", "targets", "receptions", "receiving_yards",
                "completions", "attempts", "passing_yards", "passing_tds", "interceptions",
                "is_home", "is_playoff", "is_primetime"])


# ---- whole ordered outputs ----------------------------------------------------
def numbered(df: DataFrame, *order: Column) -> DataFrame:
    """The whole frame sorted, with ``position`` from 1, for any number of rows.

    Rows are range-partitioned and sorted in their partitions, numbered there
    and written once; the partitions' counts (one row each) give each its
    offset.  No task sees more than its range.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/numbered-{uuid.uuid4().hex}"
    # The high bits of the id are the partition, the low ones the place in it.
    df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_row", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("_row", T.LongType())])).parquet(path).withColumn("_range", F.shiftright("_row", 33))
    offsets, before = [], 0
    for r in sorted(rows.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect()):
        offsets.append((r["_range"], before))
        before += r["n"]
    known = spark.createDataFrame(offsets, "_range long, _before long")
    place = F.col("_before") + F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return rows.join(F.broadcast(known), "_range").select(*df.columns, place.alias("position")).orderBy("position")


def vs500_in_order(m: Marts, min_games: int) -> DataFrame:
    """Teams by their win rate against opponents at .500 or above."""
    return numbered(vs500_leaderboard(m.schedules, min_games), d("win_pct_vs_500_pct"), d("games_vs_500"), a("team"))


def teams_last_season_in_order(m: Marts) -> DataFrame:
    return numbered(m.team_last_season_wide, d("win_pct"), d("wins"), a("team"))


def in_order(df: DataFrame, *order: Column) -> DataFrame:
    """The whole frame sorted, with ``position`` from 1.

    One task numbers the rows, so this is for reports whose rows are bounded by
    teams or seasons; ``numbered`` is for any size.
    """
    position = F.row_number().over(Window.orderBy(*order))
    return df.withColumn("position", position).orderBy("position")


def teams_in_order(m: Marts) -> DataFrame:
    """Every team's all-time record, best first."""
    return in_order(m.team_alltime_splits.select(*TEAM_TOP), d("win_pct"), d("wins"), a("team"))


def last_seasons(games_by_season: DataFrame, k: int = 10) -> DataFrame:
    """The last ``k`` rows of the season report, latest first."""
    return in_order(games_by_season.orderBy(F.col("season").desc()).limit(k), F.col("season").desc())


def head_and_tail(df: DataFrame, keys: list[str], head: int = 5, tail: int = 10) -> DataFrame:
    """First and last rows by a unique key, with ``part`` and ``position`` (from that end).

    Each end is a top-k: every task keeps its own k rows, nothing is sorted as a whole.
    """
    def end(part: str, k: int, order: list[Column]) -> DataFrame:
        rows = df.orderBy(*order).limit(k)
        return in_order(rows, *order).withColumn("part", F.lit(part))

    first = end("head", head, [a(c) for c in keys])
    last = end("tail", tail, [d(c) for c in keys])
    return first.unionByName(last)
