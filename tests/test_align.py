"""Schema alignment of incoming feeds."""

import pytest
from pyspark.sql import types as T

from sideline.operators import align as AL


def test_harmonize_renames_coerces_and_prunes(spark):
    feed = spark.createDataFrame(
        [("x", "3.0", "KC", 1, 7), ("2024", "2", "KC", None, 1), ("bad", "1.5", None, 2, 0)],
        "season string, week string, team string, passing_interceptions int, extra_col int")
    out = AL.harmonize(feed, ["season", "week", "recent_team", "interceptions", "player_id"])
    assert out.columns == ["season", "week", "recent_team", "interceptions"]
    assert dict(out.dtypes)["season"] == "bigint"
    rows = [tuple(r) for r in out.collect()]
    assert rows == [(None, 3, "KC", 1), (2024, 2, "KC", None), (None, None, None, 2)]


def test_schema_drift_lists_dropped_columns_sorted(spark):
    feed = spark.createDataFrame([(1, None, 3, 4)], "team int, zeta int, alpha int, sacks_suffered int")
    rows = [tuple(r) for r in AL.schema_drift(feed, ["recent_team"]).collect()]
    assert rows == [("alpha", 1), ("sacks", 1), ("zeta", 0)]


def test_require_and_conform(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError, match=r"\['b'\]"):
        AL.require_columns(df, ["a", "b"])
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType())])
    out = AL.conform(df, schema)
    assert out.schema == schema and tuple(out.first()) == (1, None)
