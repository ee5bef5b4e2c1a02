"""Primary quarterback per team-week and the head-coach dimension.

* ``qb_primary_game``: a top-1-per-group.  Written as ``row_number() == 1``;
  Catalyst turns the filter into a ``WindowGroupLimit`` that keeps one row
  per (season, week, team) in every map task *before* the shuffle, so a
  team-week with many passers never lands whole on one reducer.
* ``coach_map``: both sides of every played game become (season, week, team,
  head_coach) rows through an ``explode`` of two structs; the first row per
  key (home side before away side, then game id) is kept with the same
  top-1 pattern.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sideline.functions.exprs import PLAYOFF_TYPES, name_or_display, round_int, strip_ws
from sideline.functions.joins import bounded
from sideline.operators.align import require_columns
from sideline.operators.games import played

COACH_GAME_TYPES = ("REG",) + PLAYOFF_TYPES
GAME_KEYS = ["game_id", "season", "week", "game_type"]
SIDES = ["home_team", "away_team", "home_coach", "away_coach"]


def qb_primary_game(weekly: DataFrame) -> DataFrame:
    """Most attempts per (season, week, team); ties by passing yards, then id."""
    att = F.coalesce(F.col("attempts"), F.lit(0))
    yds = F.coalesce(F.col("passing_yards"), F.lit(0.0))
    w = Window.partitionBy("season", "week", "recent_team").orderBy(
        att.desc(), yds.desc(), F.col("player_id").asc())
    qb = (weekly
          .where((F.col("position") == "QB") | (F.col("position_group") == "QB"))
          .select(
              F.col("season").cast("int").alias("season"),
              F.col("week").cast("int").alias("week"),
              F.col("recent_team").alias("team"),
              F.col("player_id").alias("qb_id"),
              name_or_display().alias("qb_name"),
              round_int(att).alias("attempts"),
              round_int(yds).alias("passing_yards"),
              F.row_number().over(w).alias("rn")))
    return qb.where((F.col("rn") == 1) & (F.col("attempts") >= 1)).drop("rn")


def qb_games(enriched: DataFrame, primary: DataFrame) -> DataFrame:
    g = enriched.select(
        "game_id", "season", "week", "game_type", "gamedate", "gametime", "weekday",
        "team", "opp", "is_home", "is_playoff", "is_primetime", "is_morning",
        "is_afternoon", "is_evening", "win_pts", "opp_is_500_plus")
    # The games' side is the one with a checked bound; quarterbacks come from the player rows.
    return bounded(g).join(primary, ["season", "week", "team"]).select(
        *g.columns, "qb_id", "qb_name", "attempts", "passing_yards")


def coach_map(schedules: DataFrame, feed: DataFrame, validate: bool = True) -> DataFrame:
    """(season, week, team, head_coach) for every side of every played game.

    ``feed`` carries (game_id, season, week, game_type, home_coach, away_coach);
    it is matched to the played games one-to-one in one aggregate of both
    sides (``validate`` raises at run time if either side repeats a key, else
    a repeated key is taken once); a frame that lacks a needed column fails at
    once, by name.  Rows of other game types and
    rows without a coach are dropped, names are stripped of white space and
    the first row per (season, week, team) is kept.
    """
    require_columns(schedules, [*GAME_KEYS, "home_team", "away_team", "home_score", "away_score"], "coach_map: schedule")
    require_columns(feed, [*GAME_KEYS, "home_coach", "away_coach"], "coach_map: feed")
    def keyed(df: DataFrame, feed_side: bool, columns: list[str]) -> DataFrame:
        """One side, tagged; the other side's columns are NULL."""
        return df.select("game_id", F.col("season").cast("int").alias("season"), F.col("week").cast("int").alias("week"), "game_type",
                         F.lit(feed_side).alias("_feed"), *[(F.col(c) if c in columns else F.lit(None)).cast("string").alias(c) for c in SIDES])

    # Both sides meet in one aggregate on the keys (one exchange), which also counts each side's rows of a key.
    both = keyed(played(schedules), False, SIDES[:2]).union(keyed(feed, True, SIDES[2:]))
    n = {"schedule": F.count_if(~F.col("_feed")), "feed": F.count_if(F.col("_feed"))}
    m = both.groupBy(*GAME_KEYS).agg(*[F.max(c).alias(c) for c in SIDES], n["schedule"].alias("_n_schedule"), n["feed"].alias("_n_feed"))
    # A left join: games without a feed row have no coaches, and a NULL in a key matches nothing.
    keep = F.col("_n_schedule") > 0
    for k in GAME_KEYS:
        keep = keep & F.col(k).isNotNull()
    if validate:
        # One expression with the filter, so that nothing is filtered before it is checked.
        shown = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in GAME_KEYS])
        refuse = {side: F.raise_error(F.concat(F.lit(f"coach_map: {side} keys: duplicate key "), shown)) for side in n}
        keep = F.when(F.col("_n_schedule") > 1, refuse["schedule"]).when(F.col("_n_feed") > 1, refuse["feed"]).otherwise(keep)
    m = m.where(keep)
    home = F.struct(F.lit(0).alias("side"), F.col("home_team").alias("team"),
                    F.col("home_coach").alias("head_coach"))
    away = F.struct(F.lit(1).alias("side"), F.col("away_team").alias("team"),
                    F.col("away_coach").alias("head_coach"))
    rows = (m.select("game_id", "season", "week", "game_type",
                     F.explode(F.array(home, away)).alias("r"))
            .select("game_id", "season", "week", "game_type", "r.*")
            .where(F.col("game_type").isin(*COACH_GAME_TYPES) & F.col("head_coach").isNotNull())
            .withColumn("head_coach", strip_ws("head_coach")))
    first = Window.partitionBy("season", "week", "team").orderBy("side", "game_id")
    return (rows.withColumn("rn", F.row_number().over(first))
            .where(F.col("rn") == 1)
            .select(F.col("season").cast("int").alias("season"),
                    F.col("week").cast("int").alias("week"),
                    F.col("team").cast("string").alias("team"),
                    F.col("head_coach").cast("string").alias("head_coach")))


def coach_games(enriched: DataFrame, coaches: DataFrame) -> DataFrame:
    """Team games with the team's head coach that week (inner join)."""
    return enriched.join(bounded(coaches), ["season", "week", "team"]).select(
        *enriched.columns, "head_coach")
