"""Player-game base, position marts, rolling windows, QB and coach maps."""

import pytest

from conftest import game, player
from sideline.operators import games as G
from sideline.operators import people as P
from sideline.operators import players as PL


@pytest.fixture
def tge(schedules_of):
    rows = [game(f"g{w}", week=w, weekday="Monday" if w == 2 else "Sunday",
                 game_type="WC" if w == 5 else "REG") for w in (1, 2, 5)]
    return G.team_games_enriched(G.team_games(schedules_of(rows)))


def test_code_mismatch_is_dropped_and_reported(weekly_of, tge):
    hw = weekly_of([player(week=1), player(player_id="00-2", team="ZZZ", week=1)])
    pg = PL.player_games(hw, tge)
    assert [r["player_id"] for r in pg.collect()] == ["00-1"]
    assert PL.join_loss(hw, tge).count() == 1


def test_filtered_sum_is_null_without_primetime(weekly_of, tge):
    hw = weekly_of([player(week=1, rushing_yards=50.0, rushing_tds=1)])
    rb = PL.position_stats(PL.player_games(hw, tge), "RB").first()
    assert rb["tds_primetime"] is None and rb["yards_primetime"] is None
    assert rb["total_tds"] == 1 and rb["avg_yards_per_game"] == 50.0


def test_name_fallback_and_group_fallback(weekly_of, tge):
    hw = weekly_of([player(player_name="", group=None, position="RB", week=1),
                    player(player_id="00-2", player_name=None, display="Two", week=1)])
    pg = {r["player_id"]: r for r in PL.player_games(hw, tge).collect()}
    assert pg["00-1"]["player_name"] == "Player One"
    assert pg["00-1"]["position_group"] == "RB"
    assert pg["00-2"]["player_name"] == "Two"


def test_float_to_int_rounds_half_even(weekly_of, tge):
    hw = weekly_of([player(week=1, interceptions=2.5), player(player_id="00-2", week=2, interceptions=3.5),
                    player(player_id="00-3", week=5, interceptions=3.7)])
    got = {r["player_id"]: r["interceptions"] for r in PL.player_games(hw, tge).collect()}
    assert got == {"00-1": 2, "00-2": 4, "00-3": 4}


def test_pick_alternatives(spark):
    df = spark.createDataFrame([(1, None)], "cmp int, pass_yards double")
    row = df.select(PL.pick(df, ["completions", "cmp"], "int").alias("c"),
                    PL.pick(df, ["passing_yards", "pass_yards"], "double").alias("y"),
                    PL.pick(df, ["targets"], "int").alias("t")).first()
    assert (row["c"], row["y"], row["t"]) == (1, 0.0, 0)


def test_rolling_window_is_three_games_played(weekly_of, tge):
    hw = weekly_of([player(week=w, rushing_yards=float(y), rushing_tds=1)
                    for w, y in ((1, 10), (2, 20), (5, 60))])
    roll = {r["week"]: r for r in PL.rolling3(PL.player_games(hw, tge), "RB").collect()}
    assert roll[1]["yards_last3"] == 10.0 and roll[1]["avg_yards_last3"] == 10.0
    assert roll[2]["yards_last3"] == 30.0
    assert roll[5]["yards_last3"] == 90.0 and roll[5]["avg_yards_last3"] == 30.0
    assert roll[5]["tds_last3"] == 3


def test_rb_split_merges_namesakes(weekly_of, tge):
    hw = weekly_of([player(player_id="00-1", player_name="Same", week=1, rushing_yards=5.0),
                    player(player_id="00-2", player_name="Same", week=2, rushing_yards=7.0),
                    player(player_id="00-3", player_name="Zero", week=1)])
    rows = PL.rb_home_away_splits(PL.player_games(hw, tge)).collect()
    assert [(r["player_name"], r["yards_home"]) for r in rows] == [("Same", 12.0)]


def test_primary_qb_tiebreak_and_zero_attempts(weekly_of):
    hw = weekly_of([
        player("00-9", position="QB", group="QB", attempts=30, passing_yards=200.0),
        player("00-3", position="QB", group="QB", attempts=30, passing_yards=200.0),
        player("00-5", position="QB", group="QB", attempts=30, passing_yards=150.0),
        player("00-7", position="QB", group="QB", team="A", opp="H", attempts=0),
        player("00-8", position="WR", group="WR", attempts=40),
    ])
    got = {r["team"]: r["qb_id"] for r in P.qb_primary_game(hw).collect()}
    assert got == {"H": "00-3"}


def test_coach_map_strips_dedupes_and_drops_null(schedules_of):
    hs = schedules_of([
        game("g1", home_coach="\tHead H ", away_coach=None),
        game("g2", game_type="PRE", week=2, home_coach="X", away_coach="Y"),
    ])
    rows = P.coach_map(hs, hs).collect()
    assert [(r["team"], r["head_coach"]) for r in rows] == [("H", "Head H")]


def test_coach_map_rejects_duplicate_feed_key(spark, schedules_of):
    hs = schedules_of([game("g1")])
    feed = schedules_of([game("g1"), game("g1", home_coach="Other")])
    with pytest.raises(Exception, match="duplicate key"):
        P.coach_map(hs, feed).collect()


def test_first_row_per_key_prefers_home_side(schedules_of):
    # H appears as home in g1 and as away in g0 the same week: the home row wins.
    hs = schedules_of([game("g1", home_team="H", home_coach="Home Coach"),
                       game("g0", home_team="Q", away_team="H", away_coach="Away Coach")])
    cm = {r["team"]: r["head_coach"] for r in P.coach_map(hs, hs).collect()}
    assert cm["H"] == "Home Coach"
