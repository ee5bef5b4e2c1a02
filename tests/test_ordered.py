"""Row numbers over ranges, newest partitions first, profiles by bitmaps."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from sideline.operators import profile as PR
from sideline.plans import leaders as L
from sideline.plans.catalog import QUERIES, marts


def test_numbered_over_many_ranges(spark):
    rnd = random.Random(2)
    values = [(rnd.choice([None, *range(50)]), k) for k in range(2000)]
    df = spark.createDataFrame(values, "a int, k int").repartition(7)
    out = L.numbered(df, F.col("a").desc_nulls_last(), F.col("k").asc())
    assert [tuple(r) for r in out.collect()] == [(*v, i) for i, v in enumerate(sorted(values, key=lambda v: (v[0] is None, -(v[0] or 0), v[1])), 1)]
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
    assert L.numbered(df.limit(0), F.col("k").asc()).collect() == []
    assert df.columns == ["a", "k"]


@pytest.mark.parametrize("name", ["vs500_ordered", "team_last_season_wide_ordered", "games_by_season_ordered"])
def test_ordered_reports_have_no_window_over_all_rows(spark, name):
    out = QUERIES[name](spark, SF001)
    assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()
    positions = [r.position for r in out.collect()]
    assert positions == list(range(1, len(positions) + 1))


def test_latest_player_games_read_the_newest_weeks_only(spark):
    m = marts(spark, SF001)
    last = m.weekly.agg(F.max(F.struct("season", "week")).alias("x")).first().x
    for k in (1, 20, 10**6):
        tried = []
        rows = L.newest_first(m.weekly, lambda some: tried.append(some) or some.count() >= k)
        taken = rows.select("season", "week").distinct().collect()
        assert (last.season, last.week) in {(r.season, r.week) for r in taken}
        assert rows.count() >= min(k, m.weekly.count())
        if k == 1:
            plan = rows._jdf.queryExecution().executedPlan().toString()
            assert len(taken) == 1 and re.search(rf"PartitionFilters: \[[^\]]*{last.season}", plan)
    assert L.newest_first(m.weekly.limit(0), lambda some: True).count() == 0


def test_profile_against_plain_counting(spark):
    """Numbers inside and outside the bitmaps, fractions, signs, nothing at all; texts with commas and empty ones."""
    rnd = random.Random(9)
    rows = [(rnd.choice([None, 0, 1, 7, 32767, 32768, -3, 2**40]), rnd.choice([None, 0.0, 0.5, 3.0, -1.0, 40000.0, float("nan"), 1e300]), None,
             rnd.choice(["", "a, b", "é", None, "b" * 70]), rnd.randrange(40)) for _ in range(500)]
    df = spark.createDataFrame(rows, "i bigint, d double, n int, s string, c smallint").repartition(5)
    for got in PR.profile(df).collect():
        column = [r["idnsc".index(got.column_name)] for r in rows]
        values = [v for v in column if v is not None]
        different = sorted({str(v): v for v in values}.values(), key=lambda v: (isinstance(v, float) and math.isnan(v), v))
        assert (got.non_null, got.nulls, got.distinct_count) == (len(values), len(column) - len(values), len(different))
        written = df.select(F.col(got.column_name).cast("string").alias("v"), F.col(got.column_name).alias("k")).where("v is not null").distinct().orderBy("k").limit(5).collect()
        assert got.examples == ", ".join(r.v[:60] for r in written)


def test_numbers_in_bitmaps_are_not_exchanged(spark):
    """What is exchanged of a table of small whole numbers is one row a task."""
    df = spark.range(0, 200_000, 1, 8).select((F.col("id") % 30_000).alias("a"), (F.col("id") % 11).cast("double").alias("b"))
    out = PR.profile(df)
    rows = {r.column_name: r for r in out.collect()}
    assert (rows["a"].distinct_count, rows["a"].examples, rows["b"].distinct_count, rows["b"].examples) == (30_000, "0, 1, 2, 3, 4", 11, "0.0, 1.0, 2.0, 3.0, 4.0")
    plan = out._jdf.queryExecution().executedPlan()
    assert "bitmap_construct_agg" in plan.toString()
