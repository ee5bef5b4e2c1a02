"""Column profiles and coverage reports."""

from conftest import game, player
from sideline.operators import profile as PR


def test_profile_small_table(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (2, "a"), (None, "c")], "n int, s string")
    got = {r["column_name"]: r for r in PR.profile(df).collect()}
    n, s = got["n"], got["s"]
    assert (n["type"], n["non_null"], n["nulls"], n["null_pct"], n["distinct_count"]) == ("int", 3, 1, 25.0, 2)
    assert (n["min"], n["max"], n["avg"], n["examples"]) == (1.0, 2.0, 1.667, "1, 2")
    assert (s["type"], s["distinct_count"], s["min"], s["avg"], s["examples"]) == ("string", 3, None, None, "a, b, c")


def test_profile_approximate_mode(spark):
    df = spark.createDataFrame([(i % 7,) for i in range(100)], "n int")
    assert PR.profile(df, exact=False).first()["distinct_count"] == 7


def test_samples_are_truncated_and_limited(spark):
    df = spark.createDataFrame([("x" * 80,), ("a",), ("b",), ("c",), ("d",), ("e",)], "s string")
    ex = PR.profile(df).first()["examples"]
    assert ex == "a, b, c, d, e"
    df2 = spark.createDataFrame([("y" * 80,)], "s string")
    assert PR.profile(df2).first()["examples"] == "y" * 60


def test_coverage_reports(schedules_of, weekly_of):
    hs = schedules_of([game("g1", season=2019), game("g2", season=2020, week=3),
                       game("g3", season=2020, week=9, game_type="WC"),
                       game("g4", season=2020, week=4, away_score=None)])
    assert tuple(PR.season_range(hs).first()) == (2019, 2020)
    assert sorted(tuple(r) for r in PR.games_by_season(hs).collect()) == [(2019, 1), (2020, 2)]
    assert [tuple(r) for r in PR.completed_weeks(hs).collect()] == [(2020, 3)]
    assert sorted(r["team"] for r in PR.team_codes(hs).collect()) == ["A", "H"]
    hw = weekly_of([player(position=None), player("00-2"), player("00-3")])
    assert [tuple(r) for r in PR.position_counts(hw).collect()] == [("RB", 2), ("(null)", 1)]


def test_profile_dates(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.date(2020, 9, 13),), (dt.date(2019, 1, 2),), (None,)], "d date")
    r = PR.profile(df).first()
    assert (r["min_date"], r["max_date"], r["min"], r["nulls"]) == (dt.date(2019, 1, 2), dt.date(2020, 9, 13), None, 1)
    assert r["examples"] == "2019-01-02, 2020-09-13"


def test_approximate_profile_keeps_examples_without_full_distinct(spark):
    import re
    df = spark.createDataFrame([(i % 13, f"s{i % 9}") for i in range(400)], "n int, s string").repartition(4)
    exact = {r["column_name"]: r["examples"] for r in PR.profile(df).collect()}
    approx_df = PR.profile(df, exact=False)
    approx = {r["column_name"]: r["examples"] for r in approx_df.collect()}
    assert approx == exact
    plan = approx_df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"WindowGroupLimit .*Partial", plan)


def test_slices_keep_few_rows_a_task_in_the_examples_order(spark):
    """The five smallest values of each slice go through a task's few rows, whatever the types; equal to a plain ranking of all of them."""
    import datetime as dt
    from decimal import Decimal

    from pyspark.sql import functions as F
    rows = []
    for i in range(600):
        nan = float("nan")
        rows.append((i % 3 if i % 10 else None, (i * 37) % 101 - 20, [float(i % 50), -0.0, 0.0, nan, float("-inf")][i % 5], [None, f"é{i % 97}", "", f"a{i}", f"a{i % 7}"][i % 5],
                     dt.date(2020, 1, 1) + dt.timedelta(days=(i * 7) % 90), -(2 ** 53) - i % 30, Decimal(i % 40) / 8, i % 2 == 0, None))
    df = spark.createDataFrame(rows, "season int, n int, d double, s string, day date, big long, m decimal(10,3), b boolean, none string").repartition(3)
    few = PR._few_smallest(df, ("season",))
    assert few.count() <= 3 * 4 * 30
    names = [f.name for f in df.schema.fields if f.name != "season"]
    got = {(r["season"], r["column_name"]): [(str(x.k), x.v) for x in r["smallest"] or ()] for r in PR.slice_profiles(df).collect()}
    for f in df.schema.fields:
        if f.name != "season":
            k = F.col(f.name).cast("double") if PR._is_numeric(f.dataType) else F.lit(None).cast("double")
            want = df.where(F.col(f.name).isNotNull()).groupBy("season").agg(F.slice(F.array_sort(F.collect_set(F.struct(k.alias("k"), F.col(f.name).cast("string").alias("v")))), 1, 5).alias("x"))
            want = {r["season"]: [(str(y.k), y.v) for y in r["x"]] for r in want.collect()}
            assert {s: got[s, f.name] for s in (0, 1, 2, None)} == {s: want.get(s, []) for s in (0, 1, 2, None)}, f.name
    assert {c for _, c in got} == set(names)
    plan = PR.slice_profiles(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan  # no sort of all values
