"""Weekly team totals and ranks; defence-by-position ranks and their keys.

* The weekly base reads the player fact once: rows are summed by (week, team,
  opponent) first, and only those few sums are exploded into an offence side
  (own team) and a defence side (opponent) for the totals.
* Six dense ranks share one window partitioning (season, week): one shuffle,
  six sorts of partitions that hold one row per team.
* Defence by position is computed in one pass: a single grouped aggregate
  with four conditional sums per (season, game, defence), then one average
  per (season, defence), then ``stack`` to one row per position.  No
  repeated scans of the player-game base, no union of four aggregates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sideline.functions.exprs import dash_key
from sideline.functions.joins import bounded

RANK_POSITIONS = ("QB", "RB", "WR", "TE")
# Yards that count against a defence for each position group (fixed values).
DEFENCE_YARDS = {"QB": "passing_yards", "RB": "rushing_yards",
                 "WR": "receiving_yards", "TE": "receiving_yards"}


def team_weekly_base(weekly: DataFrame, schedules: DataFrame) -> DataFrame:
    """(season, week, team) regular-season totals: offence, defence allowed, points.

    One row per team side of every scheduled regular-season game, played or
    not: a missing score counts as 0 points, missing yards as 0.
    """
    reg = weekly.where(F.col("season_type") == "REG")
    pass_y = F.coalesce(F.col("passing_yards"), F.lit(0)).cast("double")
    rush_y = F.coalesce(F.col("rushing_yards"), F.lit(0)).cast("double")
    # One scan: totals by the two teams first (a few rows a game), then each
    # total counts for its team's offence and against the opponent's defence.
    games = reg.groupBy(
        F.col("season").cast("int").alias("season"), F.col("week").cast("int").alias("week"),
        "recent_team", "opponent_team").agg(F.sum(pass_y).alias("py"), F.sum(rush_y).alias("ry"))
    sides = games.select("season", "week", "py", "ry", F.explode(F.array(
        F.struct(F.col("recent_team").alias("team"), F.lit(True).alias("offence")),
        F.struct(F.col("opponent_team").alias("team"), F.lit(False).alias("offence")))).alias("s"))
    off, py, ry = F.col("s.offence"), F.col("py"), F.col("ry")
    yards = sides.groupBy("season", "week", F.col("s.team").alias("team")).agg(
        F.sum(F.when(off, py)).alias("off_pass_yards"),
        F.sum(F.when(off, ry)).alias("off_rush_yards"),
        F.sum(F.when(~off, py)).alias("def_pass_yards_allowed"),
        F.sum(F.when(~off, ry)).alias("def_rush_yards_allowed"))
    home = F.struct(F.col("home_team").alias("team"), F.col("home_score").alias("points_for"),
                    F.col("away_score").alias("points_allowed"))
    away = F.struct(F.col("away_team").alias("team"), F.col("away_score").alias("points_for"),
                    F.col("home_score").alias("points_allowed"))
    points = (schedules.where(F.col("game_type") == "REG")
              .select(F.col("season").cast("int").alias("season"),
                      F.col("week").cast("int").alias("week"),
                      F.explode(F.array(home, away)).alias("p"))
              .select("season", "week", "p.*"))
    zero = F.lit(0.0)
    return (points
            .join(yards, ["season", "week", "team"], "left")
            .select("season", "week", "team",
                    F.coalesce("off_pass_yards", zero).alias("off_pass_yards"),
                    F.coalesce("off_rush_yards", zero).alias("off_rush_yards"),
                    F.coalesce(F.col("points_for").cast("double"), zero).alias("off_points"),
                    F.coalesce("def_pass_yards_allowed", zero).alias("def_pass_yards_allowed"),
                    F.coalesce("def_rush_yards_allowed", zero).alias("def_rush_yards_allowed"),
                    F.coalesce(F.col("points_allowed").cast("double"), zero).alias("def_points_allowed")))


def team_weekly_ranks(base: DataFrame) -> DataFrame:
    """Dense ranks per (season, week): offence high-is-best, defence low-is-best."""
    def rank(col, desc):
        order = F.col(col).desc() if desc else F.col(col).asc()
        return F.dense_rank().over(Window.partitionBy("season", "week").orderBy(order))

    return base.select(
        "*",
        rank("off_pass_yards", True).alias("off_pass_rank"),
        rank("off_rush_yards", True).alias("off_rush_rank"),
        rank("off_points", True).alias("off_points_rank"),
        rank("def_pass_yards_allowed", False).alias("def_pass_rank"),
        rank("def_rush_yards_allowed", False).alias("def_rush_rank"),
        rank("def_points_allowed", False).alias("def_points_rank"),
    )


def def_rank_by_pos(player_games: DataFrame) -> DataFrame:
    """Average yards allowed per regular-season game by position, ranked per season.

    A game where a position gained nothing counts as 0 in the average.
    """
    reg = player_games.where(F.col("game_type") == "REG")
    return _ranked(reg.groupBy("season", "game_id", F.col("opp_team").alias("team")).agg(*_position_yards()))


def weekly_def_ranks(lines: DataFrame, enriched: DataFrame, schedules: DataFrame | None = None) -> DataFrame:
    """``def_rank_by_pos`` from the weekly lines themselves.

    The lines are summed by week and the two teams before they meet their
    games, so the join and what follows see a few rows a game, not a row a
    player.
    """
    sums = lines.groupBy("season", "week", "team", "opp_team").agg(*_position_yards())
    games = enriched.where(F.col("game_type") == "REG").select("season", "week", "team", "game_id")
    met = sums.join(bounded(games, schedules), ["season", "week", "team"])
    return _ranked(met.groupBy("season", "game_id", F.col("opp_team").alias("team")).agg(*[F.sum(p).alias(p) for p in RANK_POSITIONS]))


def _position_yards() -> list:
    """Yards by position, 0 for rows of other positions."""
    return [F.sum(F.when(F.col("position_group") == pos, F.col(DEFENCE_YARDS[pos])).otherwise(F.lit(0.0))).alias(pos) for pos in RANK_POSITIONS]


def _ranked(per_game: DataFrame) -> DataFrame:
    per_team = per_game.groupBy("season", "team").agg(*[F.avg(p).alias(p) for p in RANK_POSITIONS])
    long = per_team.unpivot(["season", "team"], list(RANK_POSITIONS), "position_group", "yards_per_game")
    w = Window.partitionBy("season", "position_group").orderBy(F.col("yards_per_game").asc())
    return long.select(
        "season", "team", "position_group", "yards_per_game",
        F.dense_rank().over(w).alias("def_rank_pos"),
        dash_key("season", "team", "position_group").alias("season_team_pos"),
    )


def player_games_keys(player_games: DataFrame) -> DataFrame:
    """Player games plus the opponent's ``season-team-position`` key."""
    return player_games.select(
        "*", dash_key("season", "opp_team", "position_group").alias("opp_season_team_pos"))


def player_games_vs_def_rank(keys: DataFrame, ranks: DataFrame, schedules: DataFrame | None = None) -> DataFrame:
    """Each player game with the rank of the defence it faced (NULL if unranked).

    Ranks come from games alone, so there are at most eight for each game of
    ``schedules``: if that is small, they are broadcast, and the player side
    streams through without a shuffle.
    """
    r = ranks.select(F.col("season_team_pos").alias("opp_season_team_pos"), "def_rank_pos")
    return keys.join(bounded(r, schedules), "opp_season_team_pos", "left").select(*keys.columns, "def_rank_pos")
