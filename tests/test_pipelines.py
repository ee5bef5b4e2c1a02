"""Historical load and in-season refresh pipelines; SQL access to the views."""

import tempfile

from pyspark.sql import functions as F

from conftest import SF001, game, player
from sideline.plans import pipelines as PP
from sideline.sources import fixtures as FX


def test_historical_load_counts_and_skips_missing(spark):
    out = tempfile.mkdtemp(prefix="sideline-test-load-", dir="/tmp")
    hs, hw = FX.hist_schedules(spark, SF001), FX.hist_weekly(spark, SF001)
    counts = {r["table_name"]: r["rows"] for r in
              PP.historical_load({"hist_schedules": hs, "hist_weekly": hw, "hist_rosters_weekly": None},
                                 out).collect()}
    assert counts == {"hist_schedules": hs.count(), "hist_weekly": hw.count(), "hist_rosters_weekly": None}


def test_in_season_refresh_explicit_weeks(schedules_of, weekly_of):
    hs = schedules_of([game("g1", week=1), game("g2", week=2), game("g3", week=3)])
    hw = weekly_of([player(week=w, rushing_yards=1.0) for w in (1, 2, 3)])
    feed_s = schedules_of([game("g1", week=1, home_score=30.0), game("g2x", week=2, away_score=None)])
    feed_w = (weekly_of([player(week=1, rushing_yards=5.0), player("00-2", week=9, rushing_yards=7.0)])
              .withColumn("season", F.col("season").cast("string"))
              .withColumnRenamed("recent_team", "team"))
    res = PP.in_season_refresh(hs, hw, feed_s, feed_w, season=2020, weeks=[1, 2])
    games = {r["game_id"]: r["home_score"] for r in res.schedules.collect()}
    assert games == {"g1": 30.0, "g3": 20.0}  # week 2 emptied: its re-delivered game is unplayed
    wk = sorted((r["week"], r["rushing_yards"]) for r in res.weekly.collect())
    assert wk == [(1, 5.0), (3, 1.0)]
    counts = {(r["table_name"], r["week"]): r["rows"] for r in res.counts.collect()}
    assert counts == {("hist_schedules", 1): 1, ("hist_schedules", 2): 0,
                      ("hist_weekly", 1): 1, ("hist_weekly", 2): 0}
    assert [r["week"] for r in res.rejected_weekly.collect()] == [9]


def test_views_answer_parameterised_sql(spark):
    from sideline.plans.catalog import marts
    m = marts(spark, SF001)
    names = m.register(prefix="t_")
    assert "t_v_rb_alltime_stats" in names and "t_v_team_weekly_ranks" in names
    listed = {t.name for t in spark.catalog.listTables() if t.name.startswith("t_")}
    assert set(names) <= listed
    got = spark.sql("SELECT COUNT(*) AS n FROM t_v_rb_alltime_stats WHERE games >= :g", args={"g": 1}).first()["n"]
    assert got == m.position_alltime("RB").where("games >= 1").count()


def test_coach_feed_gives_the_same_map_and_bases_can_be_checkpointed(spark):
    from sideline.operators import people as P
    from sideline.plans.catalog import facts
    from sideline.plans.marts import Marts
    hs, hw = facts(spark, SF001)
    via_feed = P.coach_map(hs, FX.coach_feed(spark, SF001))
    assert sorted(map(tuple, via_feed.collect())) == sorted(map(tuple, P.coach_map(hs, hs).collect()))
    m = Marts(hs, hw).persist_bases(checkpoint=True)
    assert m.player_games.count() == Marts(hs, hw).player_games.count()
    assert "ExistingRDD" in m.player_games._jdf.queryExecution().optimizedPlan().toString() or \
        "LogicalRDD" in m.player_games._jdf.queryExecution().optimizedPlan().toString()


def test_view_columns_listing(spark):
    from sideline.plans.catalog import marts
    cols = marts(spark, SF001).columns_frame()
    got = {(r["view_name"], r["column_name"]) for r in cols.collect()}
    assert ("v_team_alltime_splits", "win_pct_vs_500") in got
    assert ("v_player_games", "scrimmage_yards") in got
    assert cols.where("view_name = 'v_qb_rolling3'").count() == 8


def test_publish_marts_writes_tables(spark):
    from sideline.plans.catalog import facts
    from sideline.plans.marts import Marts
    from sideline.plans.publish import publish_marts
    out = tempfile.mkdtemp(prefix="sideline-test-publish-", dir="/tmp")
    m = Marts(*facts(spark, SF001))
    names = ["v_team_alltime_splits", "v_rb_rolling3", "v_def_rank_by_pos"]
    counts = {r["table_name"]: r["rows"] for r in publish_marts(m, out, names, database="mart").collect()}
    fresh = Marts(*facts(spark, SF001)).views()
    assert counts == {n: fresh[n].count() for n in names}
    assert spark.read.parquet(f"{out}/v_rb_rolling3").where("season = 1996").count() == \
        fresh["v_rb_rolling3"].where("season = 1996").count()
    # SQL written against the view schema runs unchanged.
    got = spark.sql("SELECT team, win_pct FROM mart.v_team_alltime_splits ORDER BY win_pct DESC LIMIT 3")
    assert got.count() == 3
    assert spark.sql("SELECT COUNT(*) FROM mart.v_rb_rolling3").first()[0] == counts["v_rb_rolling3"]


def test_command_line(spark, capsys):
    from sideline.__main__ import main
    out = tempfile.mkdtemp(prefix="sideline-test-cli-", dir="/tmp")
    assert main(["peek", "--tables", SF001, "--report", "top_teams_alltime", "--rows", "3"]) == 0
    assert "top_teams_alltime" in capsys.readouterr().out
    assert main(["load", "--tables", SF001, "--out", out]) == 0
    assert spark.read.parquet(f"{out}/hist_weekly").count() == FX.hist_weekly(spark, SF001).count()


def test_postgres_style_sql_runs_on_registered_views(spark):
    from sideline.plans.catalog import marts
    m = marts(spark, SF001)
    m.register()
    last = spark.sql("""
        SELECT s.season::int AS season, COUNT(*) AS teams,
               SUM(s.wins) FILTER (WHERE s.win_pct >= 0.5) AS wins_of_winning_teams
        FROM v_team_season_splits s
        WHERE s.season = (SELECT MAX(season) FROM hist_schedules)
        GROUP BY 1
    """).first()
    assert last["teams"] == m.team_last_season_splits.count()
    keys = spark.sql("""
        SELECT k.season::string || '-' || k.opp_team || '-' || k.position_group AS key, d.def_rank_pos
        FROM v_player_games_keys k LEFT JOIN v_def_rank_by_pos d ON d.season_team_pos = k.opp_season_team_pos
        ORDER BY d.def_rank_pos NULLS LAST, key LIMIT 5
    """).collect()
    assert len(keys) == 5 and all(r["key"] for r in keys)


def test_marts_from_landed_tables(spark):
    from sideline.plans import warehouse as WH
    from sideline.plans.catalog import marts
    from sideline.plans.marts import Marts
    out = WH.load_facts(spark, SF001)
    renamed = tempfile.mkdtemp(prefix="sideline-test-landed-", dir="/tmp")
    (spark.read.parquet(f"{out}/hist_weekly").withColumnRenamed("recent_team", "team")
     .write.parquet(f"{renamed}/weekly"))
    m = Marts.from_tables(spark, f"{out}/hist_schedules", f"{renamed}/weekly")
    want = marts(spark, SF001)
    assert sorted(map(tuple, m.team_alltime_splits.collect())) == sorted(map(tuple, want.team_alltime_splits.collect()))
    cols = ["player_id", "games", "total_yards"]
    assert sorted(map(tuple, m.position_alltime("RB").select(cols).collect())) == \
        sorted(map(tuple, want.position_alltime("RB").select(cols).collect()))


def test_division_mapping_from_csv(spark):
    import os
    import pytest
    d = tempfile.mkdtemp(prefix="sideline-test-div-", dir="/tmp")
    assert PP.load_division_mapping(spark, os.path.join(d, "missing.csv")) is None
    p = os.path.join(d, "div.csv")
    with open(p, "w") as f:
        f.write("season,team,conference,division\n2024,KC,AFC,West\n2024,BUF,AFC,East\n")
    first = PP.load_division_mapping(spark, p)
    first = spark.createDataFrame(first.collect(), first.schema)  # the stored dimension
    with open(p, "w") as f:
        f.write("season,team,conference,division\n2024,KC,AFC,North\n2025,KC,AFC,West\n")
    second = PP.load_division_mapping(spark, p, first)
    assert sorted(map(tuple, second.collect())) == [
        (2024, "BUF", "AFC", "East"), (2024, "KC", "AFC", "North"), (2025, "KC", "AFC", "West")]
    with open(p, "a") as f:
        f.write("2025,KC,AFC,South\n")
    with pytest.raises(Exception, match="duplicate key"):
        PP.load_division_mapping(spark, p, second).collect()


def test_refresh_coach_dimension(schedules_of):
    hs = schedules_of([game("g1"), game("g2", week=2, home_coach=None, away_coach="\tAway ")])
    dim = PP.refresh_coach_dimension(hs, hs)
    assert sorted(map(tuple, dim.collect())) == [
        (2020, 1, "A", "Coach A"), (2020, 1, "H", "Coach H"), (2020, 2, "A", "Away")]
    again = PP.refresh_coach_dimension(hs, hs, dim)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, dim.collect()))


def test_command_line_refresh(spark):
    import os
    from pyspark.sql import functions as F
    from sideline.__main__ import main
    from sideline.streaming import refresh as RS
    d = tempfile.mkdtemp(prefix="sideline-test-cli-refresh-", dir="/tmp")
    hw = FX.hist_weekly(spark, SF001)
    table, landing = os.path.join(d, "table"), os.path.join(d, "landing")
    RS.init_table(hw, table)
    latest = hw.agg(F.max("season")).first()[0]
    (hw.where((F.col("season") == latest) & (F.col("week") == 2))
     .withColumn("rushing_yards", F.lit(999.0)).write.parquet(landing))
    assert main(["refresh", "--landing", landing, "--table", table,
                 "--checkpoint", os.path.join(d, "ckpt")]) == 0
    got = RS.read_table(spark, table)
    assert got.where((F.col("season") == latest) & (F.col("week") == 2)
                     & (F.col("rushing_yards") != 999.0)).count() == 0
    assert got.count() == hw.count()
