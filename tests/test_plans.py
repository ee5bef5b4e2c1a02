"""Plan-shape tests: the scale properties the design relies on stay in place."""

import os
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from sideline.plans.catalog import QUERIES
from sideline.sources import fixtures as FX


def executed_plan(spark, name):
    df = QUERIES[name](spark, SF001)
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["player_games", "rb_alltime_stats", "player_games_vs_def_rank",
                                  "qb_games", "coach_games", "team_alltime_splits"])
def test_joins_against_bounded_sides_are_broadcast(spark, name):
    plan = executed_plan(spark, name)
    assert "SortMergeJoin" not in plan
    assert "BroadcastHashJoin" in plan


@pytest.mark.parametrize("name", ["qb_primary_game", "coach_map", "profile_weekly"])
def test_top_per_group_is_limited_before_the_shuffle(spark, name):
    plan = executed_plan(spark, name)
    assert re.search(r"WindowGroupLimit .*Partial", plan)


@pytest.mark.parametrize("name", ["rb_last_season_stats", "qb_last_season_splits", "rb_hot_last3"])
def test_latest_season_prunes_partitions(spark, name):
    plan = executed_plan(spark, name)
    assert re.search(r"PartitionFilters: \[[^\]]*Subquery", plan)


@pytest.mark.parametrize("name", ["top_teams_alltime", "rb_leaders_alltime", "player_games_latest"])
def test_reports_are_take_ordered(spark, name):
    assert "TakeOrderedAndProject" in executed_plan(spark, name)


def test_load_scan_reads_only_used_columns(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    df = FX.hist_weekly(spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    schema = re.search(r"ReadSchema: struct<(l_[^>]*)>", plan).group(1)
    assert sorted(c.split(":")[0] for c in schema.split(",")) == sorted(
        ["l_suppkey", "l_quantity", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate"])


def test_weekly_player_side_is_not_shuffled_for_the_game_join(spark):
    plan = executed_plan(spark, "player_games")
    # The only exchange is the season-record aggregate of the bounded schedule side.
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert all("player_id" not in e and "recent_team" not in e for e in exchanges)


def test_no_python_in_any_plan(spark):
    """Every registered query stays in the JVM: no Python UDF or pandas operator nodes."""
    python_nodes = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                    "MapInPandas", "MapInArrow", "AggregateInPandas", "WindowInPandas")
    for name, fn in QUERIES.items():
        plan = fn(spark, SF001)._jdf.queryExecution().executedPlan().toString()
        assert not any(node in plan for node in python_nodes), name


def test_broadcast_switch_falls_back_to_planner(spark):
    from sideline.functions.joins import CONF_KEY
    from sideline.plans.catalog import facts
    from sideline.plans.marts import Marts
    hs, hw = facts(spark, SF001)
    with_hint = Marts(hs, hw).player_games
    spark.conf.set(CONF_KEY, "false")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        without = Marts(hs, hw).player_games
        rows = sorted(map(tuple, without.collect()))
        plan = without._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    finally:
        spark.conf.unset(CONF_KEY)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert rows == sorted(map(tuple, with_hint.collect()))


def test_broadcast_hint_needs_a_small_source(spark, monkeypatch):
    """The hint is given by stored bytes, where they are unknown by a bounded count; rows are the same without it."""
    from sideline.functions import joins
    from sideline.functions.joins import BYTES_KEY, bounded, source_bytes
    from sideline.plans.catalog import facts
    from sideline.plans.marts import Marts
    hs, hw = facts(spark, SF001)
    files = [f for f in hs.inputFiles()]
    assert source_bytes(hs) == sum(os.path.getsize(f.removeprefix("file://")) for f in files)
    assert source_bytes(hs.join(hw, "season").groupBy("season").count()) == source_bytes(hs) + source_bytes(hw)
    hinted = lambda df: "ResolvedHint (strategy=broadcast)" in df._jdf.queryExecution().analyzed().toString()
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    assert source_bytes(rows) >= joins.UNKNOWN_BYTES and hinted(hw.join(bounded(rows), F.lit(1) == F.col("k")))
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 2)
    assert not hinted(hw.join(bounded(rows), F.lit(1) == F.col("k")))
    names = ["player_games", "qb_games", "coach_games", "def_rank_by_pos", "player_games_vs_def_rank"]
    small = {n: getattr(Marts(hs, hw), n) for n in names}
    spark.conf.set(BYTES_KEY, "10")
    try:
        large = {n: getattr(Marts(hs, hw), n) for n in names}
    finally:
        spark.conf.unset(BYTES_KEY)
    for n in names:
        assert hinted(small[n]) and not hinted(large[n]), n
        assert sorted(map(str, small[n].collect())) == sorted(map(str, large[n].collect())), n


def test_the_player_table_never_proves_a_broadcast(spark):
    """With a limit between the schedule's and the weekly table's size, hints stay, since only the schedule counts."""
    from sideline.functions.joins import BYTES_KEY, source_bytes
    from sideline.plans.catalog import facts
    from sideline.plans.marts import Marts
    hs, hw = facts(spark, SF001)
    spark.conf.set(BYTES_KEY, str(4 * source_bytes(hs)))
    try:
        assert source_bytes(hw) > 4 * source_bytes(hs)
        for name in ("player_games", "qb_games", "def_rank_by_pos", "player_games_vs_def_rank"):
            plan = getattr(Marts(hs, hw), name)._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan, name
    finally:
        spark.conf.unset(BYTES_KEY)


def test_hints_stay_when_the_bases_are_checkpointed(spark):
    from sideline.plans.catalog import facts
    from sideline.plans.marts import Marts
    m = Marts(*facts(spark, SF001)).persist_bases(checkpoint=True)
    plan = m.player_games_vs_def_rank._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
