"""Weekly ranks, defence-by-position ranks and composite keys."""


from pyspark.sql import functions as F

from conftest import game, player
from sideline.operators import games as G
from sideline.operators import players as PL
from sideline.operators import ranks as R


def test_dense_rank_ties(spark):
    base = spark.createDataFrame(
        [(2020, 1, t, y, 0.0, 0.0, 0.0, 0.0, 0.0) for t, y in (("A", 10.0), ("B", 10.0), ("C", 8.0))],
        "season int, week int, team string, off_pass_yards double, off_rush_yards double, off_points double, "
        "def_pass_yards_allowed double, def_rush_yards_allowed double, def_points_allowed double")
    got = {r["team"]: r["off_pass_rank"] for r in R.team_weekly_ranks(base).collect()}
    assert got == {"A": 1, "B": 1, "C": 2}


def test_weekly_base_keeps_unplayed_games_as_zero(schedules_of, weekly_of):
    hs = schedules_of([game(away_score=None, home_score=None)])
    hw = weekly_of([player(week=1, passing_yards=None, rushing_yards=12.0)])
    rows = {r["team"]: r for r in R.team_weekly_base(hw, hs).collect()}
    assert rows["H"]["off_points"] == 0.0 and rows["H"]["off_rush_yards"] == 12.0
    assert rows["A"]["def_rush_yards_allowed"] == 12.0 and rows["A"]["off_rush_yards"] == 0.0


def test_def_rank_counts_games_without_position_as_zero(schedules_of, weekly_of):
    hs = schedules_of([game("g1", week=1), game("g2", week=2)])
    tge = G.team_games_enriched(G.team_games(hs))
    hw = weekly_of([player("00-1", position="QB", group="QB", team="H", opp="A", week=1, passing_yards=300.0),
                    player("00-2", position="RB", group="RB", team="H", opp="A", week=2, rushing_yards=50.0)])
    dr = {(r["team"], r["position_group"]): r for r in R.def_rank_by_pos(PL.player_games(hw, tge)).collect()}
    assert dr[("A", "QB")]["yards_per_game"] == 150.0
    assert dr[("A", "RB")]["yards_per_game"] == 25.0
    assert dr[("A", "QB")]["season_team_pos"] == "2020-A-QB"


def test_composite_key_is_null_when_a_part_is_null(spark):
    df = spark.createDataFrame([(2020, None, "RB")], "season int, opp_team string, position_group string")
    assert R.player_games_keys(df).first()["opp_season_team_pos"] is None


def test_rank_one_exists_in_every_partition(spark):
    from sideline.plans.catalog import marts
    m = marts(spark, "/root/testdata/sf0.01")
    ranks = m.team_weekly_ranks
    cols = ["off_pass_rank", "off_rush_rank", "off_points_rank",
            "def_pass_rank", "def_rush_rank", "def_points_rank"]
    per_week = ranks.groupBy("season", "week").agg(*[F.min(c).alias(c) for c in cols])
    assert per_week.where(" OR ".join(f"{c} <> 1" for c in cols)).count() == 0
    dr = m.def_rank_by_pos.groupBy("season", "position_group").agg(F.min("def_rank_pos").alias("r"),
                                                                    F.max("def_rank_pos").alias("hi"),
                                                                    F.count("*").alias("n"))
    assert dr.where("r <> 1 OR hi > n").count() == 0
