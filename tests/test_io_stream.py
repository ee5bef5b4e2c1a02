"""Readers, writers and the streaming slice refresh."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF001
from sideline.operators import maintain as MT
from sideline.sources import fixtures as FX
from sideline.sources import io as IO
from sideline.streaming import refresh as RS


def scratch():
    return tempfile.mkdtemp(prefix="sideline-test-", dir="/tmp")


def test_load_parquet_skips_missing_and_empty(spark):
    d = scratch()
    assert IO.load_parquet(spark, os.path.join(d, "nope")) is None
    spark.createDataFrame([], "a int").write.parquet(os.path.join(d, "empty"))
    assert IO.load_parquet(spark, os.path.join(d, "empty")) is None
    spark.createDataFrame([(1,)], "a int").write.parquet(os.path.join(d, "one"))
    assert IO.load_parquet(spark, os.path.join(d, "one")).count() == 1


def test_partitioned_write_prunes_seasons(spark):
    d = scratch()
    hw = FX.hist_weekly(spark, SF001)
    IO.write_table(hw, os.path.join(d, "weekly"), partition_by=("season",))
    sl = IO.read_seasons(spark, os.path.join(d, "weekly"), [1996], [1, 2])
    plan = sl._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(season" in plan and "1996" in plan
    assert sl.count() == hw.where("season = 1996 and week in (1, 2)").count()


def test_typed_csv(spark):
    d = scratch()
    p = os.path.join(d, "div.csv")
    with open(p, "w") as f:
        f.write("season,team,conference,division\n2024,KC,AFC,West\n")
    df = IO.read_csv_typed(spark, p)
    assert df.dtypes[0] == ("season", "int") and tuple(df.first()) == (2024, "KC", "AFC", "West")
    assert IO.read_csv_typed(spark, os.path.join(d, "missing.csv")) is None


def test_overwrite_slices_rewrites_only_listed_partitions(spark):
    d = scratch()
    base = spark.createDataFrame([(2020, w, f"old{w}") for w in (1, 2, 3, 4)], "season int, week int, v string")
    IO.write_table(base, d, partition_by=("season", "week"))
    new = spark.createDataFrame([(2020, 1, "new1"), (2020, 1, "new1b")], "season int, week int, v string")
    for _ in range(2):  # idempotent
        emptied = IO.overwrite_slices(new, d, [(2020, 1), (2020, 2)])
        assert emptied == [(2020, 2)]
        got = sorted(tuple(r) for r in spark.read.parquet(d).select("season", "week", "v").collect())
        assert got == [(2020, 1, "new1"), (2020, 1, "new1b"), (2020, 3, "old3"), (2020, 4, "old4")]


def test_streaming_refresh_matches_batch_refresh(spark):
    d = scratch()
    hw = FX.hist_weekly(spark, SF001)
    table, landing, ckpt = (os.path.join(d, x) for x in ("table", "landing", "ckpt"))
    RS.init_table(hw, table)
    latest = hw.agg(F.max("season")).first()[0]
    incoming = (hw.where((F.col("season") == latest) & F.col("week").isin(1, 2))
                .withColumn("rushing_yards", F.col("rushing_yards") + 1)
                .withColumnRenamed("recent_team", "team"))
    bad = incoming.limit(1).withColumn("week", F.lit(None).cast("int"))
    incoming.unionByName(bad).write.parquet(landing)
    rejects = os.path.join(d, "rejects")
    q = RS.start_weekly_refresh(spark, landing, table, ckpt, incoming.schema, rejects_dir=rejects)
    q.awaitTermination(120)
    assert spark.read.parquet(rejects).count() == 1
    want = MT.refresh_slices(hw, incoming.withColumnRenamed("team", "recent_team"),
                             [(latest, 1), (latest, 2)])
    cols = hw.columns
    got = RS.read_table(spark, table)
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))
    # Replaying the same batch (fresh stream checkpoint) leaves the same table.
    q2 = RS.start_weekly_refresh(spark, landing, table, os.path.join(d, "ckpt2"), incoming.schema)
    q2.awaitTermination(120)
    again = RS.read_table(spark, table)
    assert sorted(map(tuple, again.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))


def test_replace_append_and_csv_exports(spark):
    d = scratch()
    t = os.path.join(d, "t")
    IO.write_table(spark.createDataFrame([(1,), (2,)], "a int"), t)
    IO.write_table(spark.createDataFrame([(3,)], "a int"), t)  # replace
    assert [r[0] for r in spark.read.parquet(t).collect()] == [3]
    assert IO.append_nonempty(spark.createDataFrame([], "a int"), t) is False
    assert IO.append_nonempty(spark.createDataFrame([(4,)], "a int"), t) is True
    assert sorted(r[0] for r in spark.read.parquet(t).collect()) == [3, 4]
    from sideline.operators import align as AL
    from sideline.operators import profile as PR
    prof = PR.profile(spark.createDataFrame([(1, "x")], "n int, s string"))
    IO.write_csv(prof, os.path.join(d, "profile"))
    back = spark.read.option("header", True).csv(os.path.join(d, "profile"))
    assert sorted(r["column_name"] for r in back.collect()) == ["n", "s"]
    drift = AL.schema_drift(spark.createDataFrame([(1, 2)], "team int, extra int"), ["recent_team"])
    IO.write_csv(drift, os.path.join(d, "drift"))
    assert [r["dropped_column"] for r in spark.read.option("header", True).csv(os.path.join(d, "drift")).collect()] == ["extra"]


def test_overwrite_slices_refuses_rows_outside_the_list(spark):
    import pytest
    d = scratch()
    new = spark.createDataFrame([(2020, 5, "x")], "season int, week int, v string")
    with pytest.raises(ValueError, match="outside the listed slices"):
        IO.overwrite_slices(new, d, [(2020, 1)])


def test_load_is_reused_within_a_session(spark):
    from sideline.plans import warehouse as WH
    first = WH.load_facts(spark, SF001)
    assert WH.is_loaded(spark, SF001)
    assert WH.load_facts(spark, SF001) == first


def test_concurrent_loads_and_sessions_share_one(spark, tmp_path):
    """Loads lie side by side, readers take the first marked one, and an unmarked (unfinished) one is never read."""
    from sideline.plans import warehouse as WH
    spark.conf.set("sideline.warehouseDir", str(tmp_path / "warehouse"))
    try:
        assert not WH.is_loaded(spark, SF001)
        os.makedirs(os.path.join(WH.warehouse_dir(spark, SF001), "0-unfinished"))
        assert not WH.is_loaded(spark, SF001)
        first = WH.load_facts(spark, SF001)
        WH._write_facts(spark, SF001)
        again = WH.load_facts(spark, SF001)
        names = os.listdir(WH.warehouse_dir(spark, SF001))
        assert sum(n.startswith("_LOADED-") for n in names) == 2 and again in {f"{WH.warehouse_dir(spark, SF001)}/{n}" for n in names}
        assert WH.load_facts(spark.newSession(), SF001) != first  # another session, another setting
        hs, hw = WH.facts(spark, SF001)
        assert hs.count() == FX.hist_schedules(spark, SF001).count() and hw.count() == FX.hist_weekly(spark, SF001).count()
    finally:
        spark.conf.unset("sideline.warehouseDir")
