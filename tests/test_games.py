"""Team-game base, season record, enrichment and splits (S8-S12 edge rows)."""

from pyspark.sql import functions as F

from conftest import game
from sideline.operators import games as G
from sideline.operators import splits as S


def by_team(df):
    return {r["team"]: r for r in df.collect()}


def test_two_rows_per_played_game_and_unplayed_dropped(schedules_of):
    hs = schedules_of([game(), game(game_id="g2", away_score=None, home_score=None)])
    tg = G.team_games(hs)
    rows = tg.collect()
    assert len(rows) == 2
    assert {r["team"]: r["is_home"] for r in rows} == {"H": True, "A": False}
    assert {r["team"]: r["win_pts"] for r in rows} == {"H": 1.0, "A": 0.0}
    assert {r["team"]: r["opp"] for r in rows} == {"H": "A", "A": "H"}


def test_tie_counts_half_on_both_sides(schedules_of):
    tg = G.team_games(schedules_of([game(away_score=20.0, home_score=20.0)]))
    assert [r["win_pts"] for r in tg.collect()] == [0.5, 0.5]


def test_time_flags(schedules_of):
    hs = schedules_of([
        game("g1", weekday="Sunday", gametime=""),
        game("g2", weekday="Thursday", gametime="12:30"),
        game("g3", weekday="Sunday", gametime="15:00"),
        game("g4", weekday="Sunday", gametime="19:00"),
        game("g5", weekday="Saturday", gametime="25:99"),
        game("g6", weekday="Friday", gametime="20:20"),
        game("g7", weekday="Sunday", gametime="TBD"),
    ])
    tg = G.team_games(hs).where(F.col("is_home"))
    got = {r["game_id"]: (r["gametime"], r["is_primetime"], r["is_morning"], r["is_afternoon"], r["is_evening"])
           for r in tg.collect()}
    assert got["g1"] == (None, False, False, False, False)
    assert got["g2"] == (750, True, True, False, False)
    assert got["g3"] == (900, False, False, True, False)
    assert got["g4"] == (1140, True, False, False, True)
    assert got["g5"] == (None, False, False, False, False)
    assert got["g6"] == (1220, False, False, False, True)
    assert got["g7"] == (None, False, False, False, False)


def test_opponent_exactly_500_counts_as_500_plus(schedules_of):
    # B beats C, loses to H: B is exactly .500 for the season.
    hs = schedules_of([
        game("g1", week=1, away_team="B", away_score=10.0, home_team="H", home_score=20.0),
        game("g2", week=2, away_team="C", away_score=10.0, home_team="B", home_score=20.0),
    ])
    tge = G.team_games_enriched(G.team_games(hs))
    h = [r for r in tge.collect() if r["team"] == "H"][0]
    assert h["opp_is_500_plus"] is True
    c = [r for r in tge.collect() if r["team"] == "B" and r["opp"] == "C"][0]
    assert c["opp_is_500_plus"] is False


def test_record_invariants(spark):
    from sideline.plans.catalog import marts
    m = marts(spark, "/root/testdata/sf0.01")
    tg = m.team_games
    played = G.played(m.schedules).count()
    assert tg.count() == 2 * played
    assert tg.agg(F.sum("win_pts")).first()[0] == played
    for r in m.team_alltime_splits.collect():
        assert r["wins"] + r["losses"] + r["ties"] == r["games"]
        assert r["wins_home"] + r["wins_away"] == r["wins"]
        assert r["wins_playoff"] + r["wins_regular"] == r["wins"]


def test_win_pct_rounds_half_up_exactly(schedules_of):
    # 1 win + 1 tie in 8 games: 1.5 / 8 = 0.1875 -> 0.1875; 5 of 16 -> 0.3125.
    rows = [game(f"w{i}", week=i, away_team=f"X{i}", away_score=0.0, home_score=1.0) for i in range(1, 2)]
    rows += [game("t", week=2, away_team="Y", away_score=1.0, home_score=1.0)]
    rows += [game(f"l{i}", week=i + 3, away_team=f"Z{i}", away_score=5.0, home_score=1.0) for i in range(6)]
    tge = G.team_games_enriched(G.team_games(schedules_of(rows)))
    h = by_team(S.record_splits(tge, ["team"], S.TEAM_SPLITS))["H"]
    assert (h["games"], h["wins"], h["ties"], h["losses"]) == (8, 1, 1, 6)
    assert h["win_pct"] == 0.1875
    # 1/3 -> 0.3333, 2/3 -> 0.6667
    rows = [game("a", away_team="P", away_score=0.0, home_score=1.0),
            game("b", week=2, away_team="Q", away_score=5.0, home_score=1.0),
            game("c", week=3, away_team="R", away_score=5.0, home_score=1.0)]
    tge = G.team_games_enriched(G.team_games(schedules_of(rows)))
    assert by_team(S.record_splits(tge, ["team"], S.TEAM_SPLITS))["H"]["win_pct"] == 0.3333


def test_split_without_games_is_null_ratio(schedules_of):
    tge = G.team_games_enriched(G.team_games(schedules_of([game()])))
    h = by_team(S.record_splits(tge, ["team"], S.TEAM_WIDE))["H"]
    assert h["games_away"] == 0 and h["win_pct_away"] is None
    assert h["games_home"] == 1 and h["win_pct_home"] == 1.0


def test_latest_season_uses_whole_schedule(schedules_of):
    # The latest season has no played game yet: last-season marts are empty.
    hs = schedules_of([game(season=2020), game("g2", season=2021, away_score=None, home_score=None)])
    tge = G.team_games_enriched(G.team_games(hs))
    last = G.in_latest_season(S.record_splits(tge, ["season", "team"], S.TEAM_SPLITS), hs)
    assert last.count() == 0


def test_vs500_leaderboard_bounds_and_min_games(spark):
    from sideline.sources import fixtures as FX
    hs = FX.hist_schedules(spark, "/root/testdata/sf0.01")
    allrows = G.vs500_leaderboard(hs, min_games=0).collect()
    assert len(allrows) == 25
    some = G.vs500_leaderboard(hs, min_games=0, start=2000, end=2001).collect()
    assert all(r["games_all"] < 100 for r in some)
    for r in allrows:
        assert abs(r["diff_vs_overall_pp"] - (r["win_pct_vs_500_pct"] - r["win_pct_all_pct"])) <= 0.011


def test_person_split_invariants(spark):
    from sideline.plans.catalog import marts
    m = marts(spark, "/root/testdata/sf0.01")
    for df in (m.qb_alltime_splits, m.qb_season_splits, m.coach_alltime_splits, m.coach_season_splits):
        for r in df.collect():
            assert r["games_home"] + r["games_away"] == r["games"]
            assert r["wins"] + r["losses"] + r["ties"] == r["games"]
            assert r["wins_home"] + r["wins_away"] == r["wins"]
            assert 0.0 <= r["win_pct"] <= 1.0
