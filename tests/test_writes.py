"""Writers that enforce keys, keep what they refuse, and touch only what they must."""

import glob
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import game, player
from sideline.__main__ import main
from sideline.operators import maintain as MT
from sideline.operators.people import coach_map
from sideline.plans import pipelines as PP
from sideline.schemas import DIM_TEAM_HEAD_COACH, DIM_TEAM_HEAD_COACH_KEYS
from sideline.sources import io as IO
from sideline.streaming import refresh as RS


def scratch():
    return tempfile.mkdtemp(prefix="sideline-test-writes-", dir="/tmp")


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=str)


def files(path):
    return set(glob.glob(f"{path}/**/*.parquet", recursive=True))


@pytest.fixture
def loaded(schedules_of, weekly_of):
    """Two seasons of two scored weeks, loaded; (games, lines, folder)."""
    games = schedules_of([game(f"g{s}_{w}", season=s, week=w) for s in (2019, 2020) for w in (1, 2)])
    lines = weekly_of([player(f"00-{p}", season=s, week=w, rushing_yards=1.0) for s in (2019, 2020) for w in (1, 2) for p in range(3)])
    out = scratch()
    PP.historical_load({"hist_schedules": games, "hist_weekly": lines}, out).collect()
    return games, lines, out


@pytest.mark.parametrize(("bad", "why"), [("again", "duplicate key"), ("null", "NULL in")])
def test_load_refuses_and_keeps_the_table(spark, loaded, bad, why):
    games, lines, out = loaded
    more = lines.limit(1) if bad == "again" else lines.limit(1).withColumn("player_id", F.lit(None).cast("string"))
    before = rows(spark.read.parquet(f"{out}/hist_weekly"), *lines.columns)
    with pytest.raises(Exception, match=why):
        PP.historical_load({"hist_weekly": lines.withColumn("rushing_yards", F.lit(9.0)).union(more)}, out)
    assert rows(spark.read.parquet(f"{out}/hist_weekly"), *lines.columns) == before


def test_load_replaces_whole_tables(spark, loaded):
    """Partitions without new rows go; tables without partitions are replaced too, or stay if refused."""
    games, lines, out = loaded
    PP.historical_load({"hist_weekly": lines.where("season = 2020 and week = 2")}, out).collect()
    assert rows(spark.read.parquet(f"{out}/hist_weekly").distinct(), "season", "week")[0] == (2020, 2)
    assert spark.read.parquet(f"{out}/hist_weekly").count() == 3
    path = f"{out}/flat"
    IO.replace_table(spark.createDataFrame([(1, "a")], "k int, v string"), path, keys=("k",))
    with pytest.raises(Exception, match="duplicate key"):
        IO.replace_table(spark.createDataFrame([(2, "a"), (2, "b")], "k int, v string"), path, keys=("k",))
    assert rows(spark.read.parquet(path), "k", "v") == [(1, "a")]
    IO.replace_table(spark.createDataFrame([(3, "c")], "k int, v string"), path, keys=("k",))
    assert rows(spark.read.parquet(path), "k", "v") == [(3, "c")]


@pytest.mark.parametrize("table", ["games", "lines"])
def test_update_refuses_before_either_table_changes(spark, loaded, table):
    games, lines, out = loaded
    feed = {"games": games.withColumn("home_score", F.lit(50.0)), "lines": lines.withColumn("rushing_yards", F.lit(7.0))}
    feed[table] = feed[table].union(feed[table].where("season = 2020 and week = 1").limit(1))
    before = {n: rows(spark.read.parquet(f"{out}/{n}"), df.columns) for n, df in (("hist_schedules", games), ("hist_weekly", lines))}
    with pytest.raises(Exception, match="duplicate key"):
        PP.refresh_tables(spark, out, feed["games"], feed["lines"], 2020, [1])
    for n, df in (("hist_schedules", games), ("hist_weekly", lines)):
        assert rows(spark.read.parquet(f"{out}/{n}"), df.columns) == before[n]


@pytest.mark.parametrize("bad", ["again", "null"])
def test_stream_batch_is_refused_whole(spark, loaded, bad):
    _, lines, out = loaded
    table = f"{out}/hist_weekly"
    new = lines.where("season = 2020 and week = 1").withColumn("rushing_yards", F.lit(5.0))
    more = new.limit(1) if bad == "again" else new.limit(1).withColumn("player_id", F.lit(None).cast("string"))
    before = rows(spark.read.parquet(table), *lines.columns)
    with pytest.raises(Exception, match="duplicate key" if bad == "again" else "NULL in"):
        RS.refresh_batch(new.union(more), table)
    assert rows(spark.read.parquet(table), *lines.columns) == before
    RS.refresh_batch(new, table)
    assert spark.read.parquet(table).where("rushing_yards = 5.0").count() == 3


def test_update_keeps_rejects_and_reads_each_feed_once(spark, loaded):
    """Rows of other weeks, other season types and without a season are kept, once, however often the update runs."""
    games, lines, out = loaded
    seen = {"games": spark.sparkContext.accumulator(0), "lines": spark.sparkContext.accumulator(0)}

    def counted(df, name, column):
        acc = seen[name]
        count = F.udf(lambda x: acc.add(1) or x, df.schema[column].dataType)
        return df.withColumn(column, count(column))

    feed = lines.withColumn("season", F.col("season").cast("string"))
    post = feed.limit(1).withColumn("season_type", F.lit("POST"))
    lost = feed.limit(1).withColumn("season", F.lit("soon"))
    feed = feed.union(post).union(lost).coalesce(1)
    for run in (1, 2):
        counts = PP.refresh_tables(spark, out, counted(games.coalesce(1), "games", "stadium" if "stadium" in games.columns else "weekday"), counted(feed, "lines", "player_name"))
        assert rows(counts, "table_name", "season", "week", "rows") == [(n, 2020, w, k) for n, k in (("hist_schedules", 1), ("hist_weekly", 3)) for w in (1, 2)]
        assert (seen["games"].value, seen["lines"].value) == (run * 4, run * feed.count())
        kept = spark.read.parquet(f"{out}/rejected_weekly")
        assert kept.count() == 6 + 2 and rows(kept.select("batch").distinct(), "batch") == [("2020_1_2",)]
    assert spark.read.parquet(f"{out}/hist_weekly").count() == 12


def test_merges_touch_their_partitions_only(spark, loaded):
    games, _, out = loaded
    path = f"{out}/dim_team_head_coach"
    assert PP.merge_coaches(spark, out, games) == [(2019,), (2020,)]
    first, old = files(f"{path}/season=2019"), rows(spark.read.parquet(path), "season", "week", "team", "head_coach")
    feed = games.withColumn("home_coach", F.lit("New"))
    feed.write.parquet(f"{out}/feed")
    for _ in range(2):
        assert main(["coaches", "--out", out, "--feed", f"{out}/feed", "--seasons", "2020"]) == 0
        now = rows(spark.read.parquet(path), "season", "week", "team", "head_coach")
        assert now == sorted([(s, w, t, "New" if (s, t) == (2020, "H") else c) for s, w, t, c in old], key=str)
        assert files(f"{path}/season=2019") == first
    one = spark.createDataFrame([(2020, 1, "H", "x")], DIM_TEAM_HEAD_COACH)
    for batch, why in ((one.union(one), "duplicate key"), (one.withColumn("head_coach", F.lit(None).cast("string")), "NULL in")):
        with pytest.raises(Exception, match=why):
            IO.merge_into(batch, path, DIM_TEAM_HEAD_COACH, DIM_TEAM_HEAD_COACH_KEYS, ("head_coach",))
    assert rows(spark.read.parquet(path), "season", "week", "team", "head_coach") == now
    assert IO.merge_into(one.limit(0), path, DIM_TEAM_HEAD_COACH, DIM_TEAM_HEAD_COACH_KEYS) == []


def test_divisions_from_csv(spark):
    out = scratch()
    text = {"a": "2023,KC,AFC,West\n2024,KC,AFC,West\n", "b": "2024,KC,AFC,East\n2024,SF,NFC,West\n", "c": "2024,SF,NFC,West\n2024,SF,NFC,East\n"}
    for name, body in text.items():
        with open(f"{out}/{name}.csv", "w") as f:
            f.write("season,team,conference,division\n" + body)
    for name in "ab":
        assert main(["divisions", "--out", out, "--csv", f"{out}/{name}.csv"]) == 0
    with pytest.raises(Exception, match="duplicate key"):
        PP.merge_divisions(spark, out, f"{out}/c.csv")
    assert PP.merge_divisions(spark, out, f"{out}/missing.csv") == []
    got = rows(spark.read.parquet(f"{out}/dim_team_division"), "season", "team", "conference", "division")
    assert got == [(2023, "KC", "AFC", "West"), (2024, "KC", "AFC", "East"), (2024, "SF", "NFC", "West")]


def test_append_again_doubles_nothing(spark):
    path = f"{scratch()}/t"
    df = spark.createDataFrame([(1,), (2,)], "a int")
    assert [IO.append_batch(df, path, "x"), IO.append_batch(df.limit(1), path, "y"), IO.append_batch(df, path, "x")] == [2, 1, 2]
    assert rows(spark.read.parquet(path), "a", "batch") == [(1, "x"), (1, "y"), (2, "x")]
    assert IO.append_batch(df.limit(0), path, "x") == 0
    assert rows(spark.read.parquet(path), "a", "batch") == [(1, "y")]


def test_play_by_play_of_many_seasons_is_one_read(spark):
    """Columns differ, some seasons are missing; the number of jobs does not follow the seasons."""
    landed = scratch()
    for s in range(2000, 2025):
        if s != 2010:
            spark.createDataFrame([(s, 0.5)], "play int, " + ("epa double" if s % 2 else "air double")).write.parquet(f"{landed}/pbp_{s}.parquet")
    jobs = {}
    for name, seasons in (("few", range(2000, 2002)), ("all", range(2000, 2025))):
        out = scratch()
        spark.sparkContext.setJobGroup(f"pbp-{name}", name)
        counts = PP.load_play_by_play(spark, landed, out, seasons)
        jobs[name] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"pbp-{name}"))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert rows(counts, "season", "rows") == [(s, 1) for s in seasons if s != 2010]
    assert jobs["all"] == jobs["few"]
    plays = spark.read.parquet(f"{out}/play_by_play")
    assert {"epa", "air"} <= set(plays.columns) and plays.where("season = play").count() == 24
    assert main(["load", "--landed", landed, "--out", scratch(), "--play-by-play", "2000", "2003"]) == 0


def test_profile_of_a_refreshed_season_only(spark, loaded):
    """Named seasons are profiled anew, the others keep their files; a season that is gone loses its profile."""
    _, lines, out = loaded
    whole = {r.column_name: r for r in PP.refresh_profiles(spark, out).collect()}
    assert (whole["player_id"].non_null, whole["player_id"].distinct_count, whole["player_id"].examples) == (12, 3, "00-0, 00-1, 00-2")
    assert (whole["rushing_yards"].min, whole["rushing_yards"].avg, whole["week"].examples) == (1.0, 1.0, "1, 2")
    path = f"{out}/hist_weekly_profile"
    old = files(f"{path}/season=2019")
    PP.refresh_tables(spark, out, spark.read.parquet(f"{out}/hist_schedules"), lines.withColumn("rushing_yards", F.lit(4.0)), 2020, [1])
    assert main(["profile", "--out", out, "--seasons", "2020"]) == 0
    assert files(f"{path}/season=2019") == old
    now = {r.column_name: r for r in PP.refresh_profiles(spark, out, seasons=[2020, 2021]).collect()}
    assert (now["rushing_yards"].max, now["rushing_yards"].avg, now["rushing_yards"].distinct_count) == (4.0, 1.75, 2)
    IO.overwrite_slices(lines.limit(0), f"{out}/hist_weekly", [(2020, 1), (2020, 2)])
    left = {r.column_name: r for r in PP.refresh_profiles(spark, out, seasons=[2020]).collect()}
    assert left["player_id"].non_null == 6 and not os.path.exists(f"{path}/season=2020")


def test_enforce_passes_good_rows_on(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "b", 2), (2, "a", 3)], "k int, v string, x int")
    assert rows(MT.enforce(df, ["k", "v"]), "k", "v", "x") == rows(df, "k", "v", "x")
    assert rows(MT.enforce(df, []), "k") == rows(df, "k")
    for keys, must in ((["k"], []), (["k", "v"], ["x"]), ([], ["x"])):
        with pytest.raises(Exception, match="duplicate key|NULL in"):
            MT.enforce(df, keys, must).collect()
    assert MT.enforce(df.limit(0), ["k"], ["x"]).collect() == []


def test_coach_map_is_one_exchange_of_both_sides(spark, schedules_of):
    import re

    games = schedules_of([game("g1"), game("g2", week=2), game("g3", week=3, game_type=None)])
    feed = games.where("game_id <> 'g2'").union(games.where("game_id = 'g1'").withColumn("game_id", F.lit("other")))
    out = coach_map(games, feed)
    assert rows(out, "week", "team", "head_coach") == [(1, "A", "Coach A"), (1, "H", "Coach H")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(game_id", plan)) == 1 and "Join" not in plan
    for left, right, side in ((games.union(games.limit(1)), feed, "schedule"), (games, feed.union(feed.where("game_id = 'other'")), "feed")):
        with pytest.raises(Exception, match=f"{side} keys: duplicate key"):
            coach_map(left, right).collect()
