"""Stored tables from load over refresh: own columns, split weeks, layouts, landed files."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import game, player
from sideline.__main__ import main
from sideline.operators import maintain as MT
from sideline.operators.profile import profile
from sideline.plans import pipelines as PP
from sideline.sources import io as IO
from sideline.streaming import refresh as RS


def scratch():
    return tempfile.mkdtemp(prefix="sideline-test-tables-", dir="/tmp")


@pytest.fixture
def season(schedules_of, weekly_of):
    """Two scored weeks of a season; both tables have a column beyond the fixed schemas."""
    games = schedules_of([game(f"g{w}", week=w) for w in (1, 2)]).withColumn("stadium", F.lit("dome"))
    lines = weekly_of([player(f"00-{p}", week=w, rushing_yards=1.0) for w in (1, 2) for p in range(4)]).withColumn("fantasy", F.lit(2.5))
    return games, lines


def test_load_then_update_then_stream(spark, season, tmp_path):
    """One layout throughout; every column of the stored tables survives both refreshes."""
    games, lines = season
    out = str(tmp_path / "out")
    PP.historical_load({"hist_schedules": games, "hist_weekly": lines}, out).collect()
    feed = lines.where("week = 2").withColumn("rushing_yards", F.lit(7.0)).withColumnRenamed("recent_team", "team")
    post = feed.limit(1).withColumn("season_type", F.lit("POST"))
    feed.unionByName(post).write.parquet(str(tmp_path / "feed"))
    games.withColumn("home_score", F.lit(33.0)).write.parquet(str(tmp_path / "games"))
    for _ in range(2):
        assert main(["update", "--out", out, "--schedules", str(tmp_path / "games"), "--weekly", str(tmp_path / "feed"),
                     "--season", "2020", "--weeks", "2"]) == 0
    weekly = spark.read.parquet(f"{out}/hist_weekly")
    assert {(r.week, r.rushing_yards, r.fantasy, r["count"]) for r in weekly.groupBy("week", "rushing_yards", "fantasy").count().collect()} == {(1, 1.0, 2.5, 4), (2, 7.0, 2.5, 4)}
    stored = spark.read.parquet(f"{out}/hist_schedules")
    assert {(r.week, r.home_score, r.stadium) for r in stored.collect()} == {(1, 20.0, "dome"), (2, 33.0, "dome")}
    RS.refresh_batch(lines.where("week = 1").withColumn("rushing_yards", F.lit(9.0)), f"{out}/hist_weekly")
    again = spark.read.parquet(f"{out}/hist_weekly")
    assert {(r.week, r.rushing_yards, r.fantasy) for r in again.collect()} == {(1, 9.0, 2.5), (2, 7.0, 2.5)} and again.count() == 8


def test_a_week_in_two_batches_keeps_all_rows(spark, season):
    _, lines = season
    table, rejects = scratch() + "/weekly", scratch()
    RS.init_table(lines, table)
    new = lines.where("week = 2").withColumn("rushing_yards", F.lit(5.0))
    for epoch, half in enumerate((new.where("player_id < '00-2'"), new.where("player_id >= '00-2'"), new.where("player_id >= '00-2'"))):
        RS.refresh_batch(half, table, rejects, epoch)
    got = spark.read.parquet(table)
    assert got.where("week = 2 and rushing_yards = 5.0 and fantasy = 2.5").count() == 4 and got.count() == 8


def test_other_season_types_are_rejected_rows(spark, season):
    games, lines = season
    table, rejects = scratch() + "/weekly", scratch()
    RS.init_table(lines, table)
    odd = lines.limit(1).withColumn("season_type", F.lit("POST")).union(lines.limit(1).withColumn("season_type", F.lit(None).cast("string")))
    assert RS.refresh_batch(odd, table, rejects) == []
    assert spark.read.parquet(rejects).count() == 2 and spark.read.parquet(table).count() == 8
    res = PP.in_season_refresh(games, lines, games, lines.union(odd))
    assert sorted(str(r.season_type) for r in res.rejected_weekly.collect()) == ["None", "POST"]
    assert res.weekly.where("fantasy is null").count() == 0 and res.schedules.where("stadium is null").count() == 0


def test_another_layout_is_refused(spark, season):
    _, lines = season
    table = scratch() + "/weekly"
    IO.write_table(lines, table, "overwrite", ("season",))
    with pytest.raises(ValueError, match="partitioned by"):
        RS.refresh_batch(lines, table)
    assert spark.read.parquet(table).count() == 8


def test_landed_files_present_missing_and_empty(spark, season):
    games, lines = season
    landed, out = scratch(), scratch()
    games.write.parquet(f"{landed}/schedules.parquet")
    lines.write.parquet(f"{landed}/weekly.parquet")
    spark.createDataFrame([], "season int, team string").write.parquet(f"{landed}/rosters_seasonal.parquet")
    got = {r.table_name: r.rows for r in PP.load_landed(spark, landed, out).collect()}
    assert got == {"hist_schedules": 2, "hist_weekly": 8, "hist_rosters_seasonal": None, "hist_rosters_weekly": None}
    nothing = {r.table_name: r.rows for r in PP.load_landed(spark, scratch(), scratch()).collect()}
    assert set(nothing.values()) == {None} and len(nothing) == 4
    assert main(["load", "--landed", landed, "--out", scratch()]) == 0


def test_play_by_play(spark):
    landed, out = scratch(), scratch()
    spark.createDataFrame([(1, "run")], "play int, kind string").write.parquet(f"{landed}/pbp_2020.parquet")
    spark.createDataFrame([(1, 0.5), (2, 0.25)], "play int, epa double").write.parquet(f"{landed}/pbp_2022.parquet")
    assert {r.season: r.rows for r in PP.load_play_by_play(spark, landed, out, range(2020, 2024)).collect()} == {2020: 1, 2022: 2}
    assert os.path.isdir(f"{out}/play_by_play/season=2022")
    assert PP.load_play_by_play(spark, landed, out, [1999]).collect() == []


@pytest.mark.parametrize("rows", [[], [(1, "x")]])
@pytest.mark.parametrize("action", ["count", "collect", "write"])
def test_upsert_guard_holds_for_every_target_and_action(spark, rows, action):
    target = spark.createDataFrame(rows, "k int, v string")
    out = MT.upsert(target, spark.createDataFrame([(2, "a"), (2, "b")], "k int, v string"), ["k"])
    with pytest.raises(Exception, match="duplicate key"):
        out.write.parquet(scratch() + "/x") if action == "write" else getattr(out, action)()


def test_profile_of_large_ids_and_repeated_values(spark):
    """Sums beyond a bigint, and five examples however often the smallest values repeat."""
    df = spark.createDataFrame([(9_000_000_000_000_000_000, 1)] * 60 + [(9_000_000_000_000_000_000, v) for v in range(2, 9)], "id bigint, v int").repartition(3)
    for exact in (True, False):
        rows = {r.column_name: r for r in profile(df, exact=exact).collect()}
        assert rows["v"].examples == "1, 2, 3, 4, 5" and rows["id"].avg == 9e18


def test_append_nonempty_reads_once(spark):
    table = scratch() + "/t"
    assert not IO.append_nonempty(spark.createDataFrame([], "a int"), table)
    assert IO.append_nonempty(spark.createDataFrame([(1,)], "a int"), table)
    assert spark.read.parquet(table).count() == 1


def test_reports_are_exported(spark, tmp_path):
    from conftest import SF001
    assert main(["report", "--tables", SF001, "--out", str(tmp_path)]) == 0
    out = spark.read.option("header", True).csv(str(tmp_path / "profile_schedules"))
    assert out.count() == 13 and "distinct_count" in out.columns
    assert spark.read.option("header", True).csv(str(tmp_path / "schema_drift")).count() > 0


def test_coach_map_names_missing_columns(schedules_of):
    from sideline.operators.people import coach_map
    games = schedules_of([game("g1")])
    with pytest.raises(ValueError, match="away_coach"):
        coach_map(games, games.drop("away_coach"))
