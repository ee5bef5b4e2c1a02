"""Player-game base and the per-position season, all-time and rolling marts.

``player_games`` joins the weekly player fact (grows with data) with the
enriched team games (bounded by the calendar: seasons x weeks x teams rows),
which is broadcast, so the player side is never shuffled for that join.

Position marts are one hash aggregate each (partial + final); the rolling
marts use a window over (player_id, season) whose partitions hold one row per
week a player played, so no partition can grow with data volume.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sideline.functions.joins import bounded
from sideline.functions.exprs import filter_sum, first_present, name_or_display, round_avg, round_int

# Alternative source names for each measure, in order of preference (fixed
# values: the feed changed names between providers).
MEASURE_SOURCES = {
    "completions": (["completions", "cmp"], "int"),
    "attempts": (["attempts", "pass_attempts", "att"], "int"),
    "passing_yards": (["passing_yards", "pass_yards"], "double"),
    "passing_tds": (["passing_tds", "pass_tds"], "int"),
    "interceptions": (["interceptions", "interceptions_thrown", "ints"], "int"),
    "rushing_attempts": (["rushing_attempts", "rushing_att", "rush_attempts", "carries"], "int"),
    "rushing_yards": (["rushing_yards", "rush_yards"], "double"),
    "rushing_tds": (["rushing_tds", "rush_tds"], "int"),
    "targets": (["targets"], "int"),
    "receptions": (["receptions", "rec"], "int"),
    "receiving_yards": (["receiving_yards", "rec_yards"], "double"),
    "receiving_tds": (["receiving_tds", "rec_tds"], "int"),
}

PLAYER_GAME_COLUMNS = [
    "player_id", "player_name", "position", "position_group", "team", "opp_team",
    "season", "week", "game_id", "game_type", "is_home", "is_playoff", "is_primetime",
    *MEASURE_SOURCES, "scrimmage_yards", "skill_tds", "qb_total_yards",
]


def pick(df: DataFrame, options: Sequence[str], cast: str | None = None,
         default: Column | None = None) -> Column:
    """First existing alternative, NULL replaced by ``default``, then cast.

    With no alternative present the default alone is used.  A fractional
    source cast to int rounds half to even, as a ``::int`` cast of a real
    would (a plain Spark cast truncates).
    """
    default = F.lit(0) if default is None else default
    name = first_present(df.columns, options)
    expr = F.coalesce(F.col(name), default) if name is not None else default
    if cast is None:
        return expr
    if cast == "int" and name is not None and isinstance(
            df.schema[name].dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
        return round_int(expr)
    return expr.cast(cast)


def player_lines(weekly: DataFrame) -> DataFrame:
    """Weekly rows with typed keys and measures, whatever the feed calls them; one projection."""
    cols = weekly.columns
    measures = {name: pick(weekly, opts, cast).alias(name)
                for name, (opts, cast) in MEASURE_SOURCES.items()}
    position = F.col("position") if "position" in cols else F.lit(None).cast("string")
    group = F.coalesce(F.col("position_group"), position) if "position_group" in cols else position
    return weekly.select(
        F.col("player_id").cast("string").alias("player_id"),
        name_or_display().cast("string").alias("player_name"),
        position.cast("string").alias("position"),
        group.cast("string").alias("position_group"),
        F.col("recent_team").cast("string").alias("team"),
        F.col("opponent_team").cast("string").alias("opp_team"),
        F.col("season").cast("int").alias("season"),
        F.col("week").cast("int").alias("week"),
        *measures.values(),
    )


def player_games(weekly: DataFrame, enriched: DataFrame, schedules: DataFrame | None = None) -> DataFrame:
    """One row per player per team game: typed measures plus game flags.

    The inner join on (season, week, team) drops weekly rows whose team code
    has no game that week (bye weeks, code mismatches).  ``schedules``, if
    given, is what the games come from: its size decides on their broadcast.
    """
    hw = player_lines(weekly)
    g = enriched.select("season", "week", "team", "game_id", "game_type",
                        "is_home", "is_playoff", "is_primetime")
    j = hw.join(bounded(g, schedules), ["season", "week", "team"])
    return j.select(
        *PLAYER_GAME_COLUMNS[:-3],
        (F.col("rushing_yards") + F.col("receiving_yards")).alias("scrimmage_yards"),
        (F.col("rushing_tds") + F.col("receiving_tds")).cast("int").alias("skill_tds"),
        (F.col("passing_yards") + F.col("rushing_yards")).alias("qb_total_yards"),
    )


def join_loss(weekly: DataFrame, enriched: DataFrame) -> DataFrame:
    """Weekly rows that find no team game (code mismatch or bye): a check."""
    g = enriched.select("season", "week", "team").withColumnRenamed("team", "recent_team")
    return weekly.join(bounded(g), ["season", "week", "recent_team"], "left_anti")


# Position marts: ordered (output, kind, source) triples.  Kinds: sum, avg3
# (rounded average), pt/po (sum FILTERed by primetime/playoff, NULL if none).
POSITION_MEASURES = {
    "RB": [("total_yards", "sum", "scrimmage_yards"), ("rushing_yards", "sum", "rushing_yards"),
           ("receiving_yards", "sum", "receiving_yards"), ("rushing_attempts", "sum", "rushing_attempts"),
           ("targets", "sum", "targets"), ("total_tds", "sum", "skill_tds"),
           ("avg_yards_per_game", "avg3", "scrimmage_yards"),
           ("tds_primetime", "pt", "skill_tds"), ("yards_primetime", "pt", "scrimmage_yards"),
           ("tds_playoff", "po", "skill_tds"), ("yards_playoff", "po", "scrimmage_yards")],
    "WR": [("receiving_yards", "sum", "receiving_yards"), ("receptions", "sum", "receptions"),
           ("targets", "sum", "targets"), ("receiving_tds", "sum", "receiving_tds"),
           ("total_yards", "sum", "scrimmage_yards"),
           ("avg_rec_yards_per_game", "avg3", "receiving_yards"),
           ("tds_primetime", "pt", "receiving_tds"), ("yards_primetime", "pt", "receiving_yards"),
           ("tds_playoff", "po", "receiving_tds"), ("yards_playoff", "po", "receiving_yards")],
    "QB": [("passing_yards", "sum", "passing_yards"), ("completions", "sum", "completions"),
           ("attempts", "sum", "attempts"), ("passing_tds", "sum", "passing_tds"),
           ("interceptions", "sum", "interceptions"), ("rushing_yards", "sum", "rushing_yards"),
           ("total_yards_qb", "sum", "qb_total_yards"),
           ("avg_pass_yards_per_game", "avg3", "passing_yards"),
           ("passing_tds_primetime", "pt", "passing_tds"),
           ("passing_yards_primetime", "pt", "passing_yards"),
           ("passing_tds_playoff", "po", "passing_tds"),
           ("passing_yards_playoff", "po", "passing_yards")],
}
POSITION_MEASURES["TE"] = POSITION_MEASURES["WR"]

# Rolling three-game marts: (yards sum, yards avg, tds sum) names and sources.
ROLLING_MEASURES = {
    "RB": (("yards_last3", "avg_yards_last3", "tds_last3"), ("scrimmage_yards", "skill_tds")),
    "WR": (("rec_yards_last3", "avg_rec_yards_last3", "rec_tds_last3"), ("receiving_yards", "receiving_tds")),
    "TE": (("rec_yards_last3", "avg_rec_yards_last3", "rec_tds_last3"), ("receiving_yards", "receiving_tds")),
    "QB": (("pass_yards_last3", "avg_pass_yards_last3", "pass_tds_last3"), ("passing_yards", "passing_tds")),
}


@lru_cache(maxsize=None)
def _position_measure(out: str, kind: str, src: str) -> Column:
    c = F.col(src)
    if kind == "sum":
        e = F.sum(c)
    elif kind == "avg3":
        e = round_avg(c, 3)
    elif kind == "pt":
        e = filter_sum(F.col("is_primetime"), c)
    elif kind == "po":
        e = filter_sum(F.col("is_playoff"), c)
    else:
        raise ValueError(kind)
    return e.alias(out)


def position_stats(games: DataFrame, group: str, keys: Sequence[str] = ("player_id",)) -> DataFrame:
    """Totals per ``keys`` for one position group (RB, WR, TE, QB)."""
    measures = [_position_measure(*m) for m in POSITION_MEASURES[group]]
    return (games.where(F.col("position_group") == group)
            .groupBy(*keys)
            .agg(F.max("player_name").alias("player_name"),
                 F.count(F.lit(1)).alias("games"), *measures))


def rolling3(games: DataFrame, group: str) -> DataFrame:
    """Sum and average over the current and two previous games of the season."""
    (sum_name, avg_name, td_name), (yards, tds) = ROLLING_MEASURES[group]
    w = Window.partitionBy("player_id", "season").orderBy("week").rowsBetween(-2, 0)
    return (games.where(F.col("position_group") == group)
            .select("season", "player_id", "player_name", "team", "week",
                    F.sum(yards).over(w).alias(sum_name),
                    F.avg(yards).over(w).alias(avg_name),
                    F.sum(tds).over(w).alias(td_name)))


def rb_home_away_splits(games: DataFrame) -> DataFrame:
    """RB totals per *name* (namesakes merge) at home, away and in primetime.

    Keeps names with positive total scrimmage yards.
    """
    y, t = F.col("scrimmage_yards"), F.col("skill_tds")
    home, pt = F.col("is_home"), F.col("is_primetime")

    rb = games.where(F.col("position_group") == "RB")
    agg = rb.groupBy("player_name").agg(
        F.sum(F.when(home, y).otherwise(F.lit(0.0))).alias("yards_home"),
        F.sum(F.when(~home, y).otherwise(F.lit(0.0))).alias("yards_away"),
        F.sum(F.when(home, t).otherwise(F.lit(0))).alias("tds_home"),
        F.sum(F.when(~home, t).otherwise(F.lit(0))).alias("tds_away"),
        F.sum(F.when(pt, y).otherwise(F.lit(0.0))).alias("yards_primetime"),
        F.sum(F.when(pt, t).otherwise(F.lit(0))).alias("tds_primetime"),
        F.sum(y).alias("_total"),
    )
    return agg.where(F.col("_total") > 0).drop("_total")
