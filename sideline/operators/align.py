"""Schema alignment of incoming feeds against an existing table.

All decisions here are about column *names* and are made on the driver from
``df.columns`` (no job); the data work (renames, coercion, pruning) stays in
one projection that Catalyst pushes into the scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sideline.functions.exprs import lenient_int

# Feed names -> table names (fixed values: the newer feed renamed these).
WEEKLY_RENAMES = {
    "team": "recent_team",
    "passing_interceptions": "interceptions",
    "sacks_suffered": "sacks",
    "sack_yards_lost": "sack_yards",
}
INT_KEYS = ("season", "week")


def rename_present(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename the columns of ``mapping`` that exist; others are left alone."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def dropped_columns(columns: Iterable[str], target: Iterable[str]) -> list[str]:
    """Sorted incoming columns that the target does not have."""
    keep = set(target)
    return sorted(c for c in columns if c not in keep)


def harmonize(df: DataFrame, target_columns: Sequence[str],
              renames: Mapping[str, str] = WEEKLY_RENAMES,
              int_keys: Sequence[str] = INT_KEYS) -> DataFrame:
    """Rename feed columns, coerce the key columns, keep only target columns.

    Key columns become nullable bigints: bad text -> NULL, ``'3.0'`` -> 3.
    Column order is the incoming order.  NULLs stay NULL (never the text
    ``'None'``).
    """
    df = rename_present(df, renames)
    target = set(target_columns)
    cols = []
    for c in df.columns:
        if c not in target:
            continue
        cols.append(lenient_int(c).alias(c) if c in int_keys else F.col(c))
    return df.select(*cols)


def require_columns(df: DataFrame, needed: Iterable[str], what: str = "input") -> DataFrame:
    """Fail early, with the missing names, if ``df`` lacks a needed column."""
    missing = sorted(set(needed) - set(df.columns))
    if missing:
        raise ValueError(f"{what} is missing columns: {missing}")
    return df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to a fixed schema; absent columns become typed NULLs."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields])


def schema_drift(incoming: DataFrame, target_columns: Sequence[str],
                 renames: Mapping[str, str] = WEEKLY_RENAMES) -> DataFrame:
    """Incoming columns (after renames) the target lacks, with their non-NULL counts.

    One row per dropped column, sorted by name: ``dropped_column`` and
    ``non_null`` (how many incoming values the load would discard).  One
    aggregate over the feed.
    """
    df = rename_present(incoming, renames)
    dropped = dropped_columns(df.columns, target_columns)
    spark = incoming.sparkSession
    if not dropped:
        return spark.createDataFrame([], "dropped_column string, non_null bigint")
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in dropped])
    return counts.unpivot([], dropped, "dropped_column", "non_null")
