"""Slice refresh, upsert, key checks and counts."""

import pytest

from sideline.operators import maintain as MT


def table(spark, rows):
    return spark.createDataFrame(rows, "season int, week int, k string, v double")


def test_refresh_deletes_every_listed_week_and_is_idempotent(spark):
    target = table(spark, [(2020, w, "a", 1.0) for w in (1, 2, 3, 4, 5)])
    incoming = table(spark, [(2020, 1, "a", 9.0), (2020, 2, "a", 9.0), (2020, 9, "a", 9.0)])
    slices = [(2020, 1), (2020, 2), (2020, 3)]
    once = MT.refresh_slices(target, incoming, slices)
    twice = MT.refresh_slices(once, incoming, slices)
    got = sorted((r["week"], r["v"]) for r in once.collect())
    assert got == [(1, 9.0), (2, 9.0), (4, 1.0), (5, 1.0)]
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))
    counts = {r["week"]: r["rows"] for r in MT.slice_counts(once, slices).collect()}
    assert counts == {1: 1, 2: 1, 3: 0}


def test_upsert_replaces_and_is_idempotent(spark):
    target = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    incoming = spark.createDataFrame([(2, "Y"), (3, "Z")], "k int, v string")
    once = MT.upsert(target, incoming, ["k"])
    assert sorted(map(tuple, once.collect())) == [(1, "x"), (2, "Y"), (3, "Z")]
    assert sorted(map(tuple, MT.upsert(once, incoming, ["k"]).collect())) == sorted(map(tuple, once.collect()))


def test_upsert_rejects_duplicate_incoming_key(spark):
    target = spark.createDataFrame([(1, "x")], "k int, v string")
    incoming = spark.createDataFrame([(2, "a"), (2, "b")], "k int, v string")
    with pytest.raises(Exception, match="duplicate key"):
        MT.upsert(target, incoming, ["k"]).collect()


def test_key_checks_and_counts(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, None)], "k int, v string")
    r = MT.check_keys([("t.k", df, ["k"], ["v"])]).first()
    assert (r["check_name"], r["rows"], r["duplicate_keys"], r["null_keys"]) == ("t.k", 4, 1, 2)
    rc = {x["table_name"]: x["rows"] for x in MT.row_counts({"a": df, "b": df.limit(1)}).collect()}
    assert rc == {"a": 4, "b": 1}


def test_row_counts_report_missing_tables(spark):
    df = spark.createDataFrame([(1,)], "a int")
    got = {r["table_name"]: r["rows"] for r in MT.row_counts({"t": df, "hist_rosters_weekly": None}).collect()}
    assert got == {"t": 1, "hist_rosters_weekly": None}
