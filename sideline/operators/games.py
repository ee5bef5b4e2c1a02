"""Team-game marts: one row per team per played game, season records, enrichment.

Sizes: these frames are bounded by the calendar (games x 2 sides), not by
the weekly player volume; joins against them broadcast them
(``functions.joins.bounded``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sideline.functions.joins import bounded
from sideline.functions.exprs import (
    AFTERNOON_START_MIN, EVENING_START_MIN, PLAYOFF_TYPES, PRIMETIME_ALWAYS_DAYS,
    PRIMETIME_LATE_DAYS, clock_minutes, empty_to_null, flag_sum, to_decimal,
)

TEAM_GAME_COLUMNS = [
    "game_id", "season", "week", "game_type", "gamedate", "gametime", "weekday",
    "home_team", "away_team", "home_score", "away_score",
    "team", "opp", "is_home", "win_pts", "is_playoff", "is_primetime",
    "is_morning", "is_afternoon", "is_evening", "team_score", "opp_score",
]


def played(schedules: DataFrame) -> DataFrame:
    """Games with both scores present."""
    return schedules.where(F.col("home_score").isNotNull() & F.col("away_score").isNotNull())


def latest_season(schedules: DataFrame) -> DataFrame:
    """One-row frame ``(season)`` = MAX(season) over the whole schedule."""
    return schedules.agg(F.max(F.col("season").cast("int")).alias("season"))


def in_latest_season(df: DataFrame, schedules: DataFrame) -> DataFrame:
    """Rows of ``df`` whose season is the latest season of the schedule.

    ``season = (SELECT MAX(season) FROM schedules)`` as a scalar subquery:
    Catalyst pushes the predicate through aggregates grouped by season and
    through joins on season down to the scans, where it becomes a runtime
    partition filter of a season-partitioned table (only the latest
    season's files are read).
    """
    return df.where(F.col("season") == latest_season(schedules).scalar())


def team_games(schedules: DataFrame) -> DataFrame:
    """Per-team-per-game base with outcome and time-of-day flags.

    Each played game becomes two rows (home side, away side) through an
    ``explode`` of two structs: one scan, no self-join, no union.
    Home means ``home_team`` (neutral sites included).  ``gametime`` is
    minutes after midnight (NULL when missing or not a clock time).
    """
    base = played(schedules).select(
        "game_id",
        F.col("season").cast("int").alias("season"),
        F.col("week").cast("int").alias("week"),
        "game_type",
        F.to_date("gameday").alias("gamedate"),
        clock_minutes(empty_to_null("gametime")).alias("gametime"),
        "weekday", "home_team", "away_team",
        F.col("home_score").cast("double").alias("home_score"),
        F.col("away_score").cast("double").alias("away_score"),
    )
    home = F.struct(F.col("home_team").alias("team"), F.col("away_team").alias("opp"),
                    F.lit(True).alias("is_home"),
                    F.col("home_score").alias("team_score"), F.col("away_score").alias("opp_score"))
    away = F.struct(F.col("away_team").alias("team"), F.col("home_team").alias("opp"),
                    F.lit(False).alias("is_home"),
                    F.col("away_score").alias("team_score"), F.col("home_score").alias("opp_score"))
    sides = base.select("*", F.explode(F.array(home, away)).alias("s")).select("*", "s.*").drop("s")

    t = F.col("gametime")
    wd = F.col("weekday")
    win_pts = (F.when(F.col("home_score") == F.col("away_score"), F.lit(0.5))
               .when(F.col("team_score") > F.col("opp_score"), F.lit(1.0))
               .otherwise(F.lit(0.0)))
    primetime = (F.when(wd.isin(*PRIMETIME_ALWAYS_DAYS), True)
                 .when(wd.isin(*PRIMETIME_LATE_DAYS) & (t >= EVENING_START_MIN), True)
                 .otherwise(False))
    return sides.select(
        "game_id", "season", "week", "game_type", "gamedate", "gametime", "weekday",
        "home_team", "away_team", "home_score", "away_score",
        "team", "opp", "is_home",
        win_pts.alias("win_pts"),
        F.col("game_type").isin(*PLAYOFF_TYPES).alias("is_playoff"),
        primetime.alias("is_primetime"),
        (t.isNotNull() & (t < AFTERNOON_START_MIN)).alias("is_morning"),
        (t.isNotNull() & (t >= AFTERNOON_START_MIN) & (t < EVENING_START_MIN)).alias("is_afternoon"),
        (t.isNotNull() & (t >= EVENING_START_MIN)).alias("is_evening"),
        "team_score", "opp_score",
    )


def season_record(games: DataFrame) -> DataFrame:
    """(season, team) -> wins, losses, ties, unrounded win_pct over all game types."""
    wp = F.col("win_pts")
    return games.groupBy("season", "team").agg(
        flag_sum(wp == 1).alias("wins"),
        flag_sum(wp == 0).alias("losses"),
        flag_sum(wp == 0.5).alias("ties"),
        (F.sum(wp) / F.count(F.lit(1))).alias("win_pct"),
    )


def team_games_enriched(games: DataFrame) -> DataFrame:
    """Team games plus ``opp_is_500_plus`` (opponent's whole-season win% >= .5).

    The season record covers the whole season, later games included, as in the
    source definition (no point-in-time logic).
    """
    rec = season_record(games).select(
        "season", F.col("team").alias("opp"), (F.col("win_pct") >= 0.5).alias("opp_is_500_plus"))
    return games.join(bounded(rec), ["season", "opp"]).select(*TEAM_GAME_COLUMNS, "opp_is_500_plus")




def vs500_leaderboard(schedules: DataFrame, min_games: int = 50,
                      start: int | None = None, end: int | None = None) -> DataFrame:
    """Win% against opponents at or above .500 next to overall win%, per team.

    Seasons may be bounded (``start``/``end`` inclusive); the opponent's
    season record is taken over the same seasons.  One aggregate over the
    enriched games yields both the .500+ and the overall figures.  Ratios
    are exact decimals: percent to 2 places, difference in points to 2.
    """
    s = schedules
    if start is not None:
        s = s.where(F.col("season") >= start)
    if end is not None:
        s = s.where(F.col("season") <= end)
    g = team_games_enriched(team_games(s))
    vs = F.col("opp_is_500_plus")
    wp = F.col("win_pts")
    agg = g.groupBy("team").agg(
        flag_sum(vs).alias("games_vs_500"),
        F.sum(F.when(vs, wp).otherwise(F.lit(0.0))).alias("pts_vs"),
        F.count(F.lit(1)).alias("games_all"),
        F.sum(wp).alias("pts_all"),
    )
    pct_vs = F.try_divide(to_decimal(F.col("pts_vs")), F.col("games_vs_500").cast("decimal(20,0)"))
    pct_all = F.try_divide(to_decimal(F.col("pts_all")), F.col("games_all").cast("decimal(20,0)"))
    return (agg.where((F.col("games_vs_500") > 0) & (F.col("games_vs_500") >= min_games))
            .select("team", "games_vs_500",
                    F.round(F.col("pts_vs"), 1).alias("wins_vs_500"),
                    F.round(pct_vs * 100, 2).cast("double").alias("win_pct_vs_500_pct"),
                    "games_all",
                    F.round(F.col("pts_all"), 1).alias("wins_all"),
                    F.round(pct_all * 100, 2).cast("double").alias("win_pct_all_pct"),
                    F.round((pct_vs - pct_all) * 100, 2).cast("double").alias("diff_vs_overall_pp")))
