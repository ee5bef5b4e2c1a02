"""Table maintenance: slice refresh, keyed upsert, key checks, row counts.

Nothing here mutates data.  Each operator returns the new table as a lazy
DataFrame; the caller writes it, either to a fresh path or, for slice
refreshes of a (season, week)-partitioned table, by rewriting only the
listed partitions (``sources.io.overwrite_slices``).  Both are idempotent:
a failed or repeated run leaves the same table, and a lost executor only
re-runs its tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sideline.functions.joins import bounded, short

SLICE_KEYS = ["season", "week"]


def _guard(keys: Sequence[str], what: str) -> Column:
    key_text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])
    return (F.when(F.col("_n_key") > 1,
                   F.raise_error(F.concat(F.lit(f"{what}: duplicate key "), key_text)))
            .otherwise(F.lit(True)))


def assert_unique(df: DataFrame, keys: Sequence[str], what: str = "keys") -> DataFrame:
    """``df`` itself, with a run-time failure if a key occurs more than once.

    A grouped count (partial aggregation first, so a hot key is combined
    map-side, never gathered in one task) with a ``raise_error`` guard; one
    row per key carries the other columns (``first`` of a one-row group is
    the row itself).  Lazy: no extra action, no collect.
    """
    others = [c for c in df.columns if c not in set(keys)]
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n_key"),
                                    *[F.first(c).alias(c) for c in others])
    return grouped.where(_guard(keys, what)).select(*df.columns)


def enforce(df: DataFrame, keys: Sequence[str], not_null: Iterable[str] = (), what: str = "table") -> DataFrame:
    """``df`` itself, failing while it is evaluated where a key repeats or a key or NOT NULL column is NULL.

    The guard is part of the plan of whatever writes the rows, so they are
    read once and a refused write leaves nothing behind.  The numbering of
    equal keys streams over rows sorted by key and holds none of them; a key
    is a row's own, so no key gathers more rows than the first repeat of it.
    """
    must = list(dict.fromkeys([*keys, *not_null]))
    shown = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys or must])
    missing = F.lit(False)
    for c in must:
        missing = missing | F.col(c).isNull()
    guard = F.when(missing, F.raise_error(F.concat(F.lit(f"{what}: NULL in {', '.join(must)} of key "), shown)))
    if not keys:
        return df.where(guard.otherwise(F.lit(True))) if must else df
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    guard = guard.when(F.col("_nth_of_key") > 1, F.raise_error(F.concat(F.lit(f"{what}: duplicate key "), shown))).otherwise(F.lit(True))
    return df.withColumn("_nth_of_key", nth).where(guard).drop("_nth_of_key")


def upsert(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``INSERT ... ON CONFLICT (keys) DO UPDATE`` as one grouped aggregate.

    Rows of ``target`` whose key arrives in ``incoming`` are replaced; the
    others stay; upserting twice gives the same table as once.  Both frames
    are tagged, united and grouped by key, and the newer row of each key is
    kept: either side is read once, nothing is broadcast, and the guard sits
    on the rows that leave, so no plan can drop it.  A key repeated in
    ``incoming`` fails the job like the database would, and so does one
    repeated in ``target``, whose primary key it is (NULLs count as equal).
    """
    columns = target.columns
    types = dict(zip(columns, (f.dataType for f in target.schema.fields)))
    arriving = incoming.select(*[F.col(c).cast(types[c]).alias(c) for c in columns])

    def tagged(df: DataFrame, new: int) -> DataFrame:
        return df.select(*keys, F.struct(*columns).alias("_row"), F.lit(new).alias("_new"))

    per_key = tagged(target, 0).union(tagged(arriving, 1)).groupBy(*keys).agg(
        F.max_by("_row", "_new").alias("_row"),
        F.count_if(F.col("_new") == 1).alias("_n_key"), F.count_if(F.col("_new") == 0).alias("_n_had"))
    once = per_key.where(_guard(keys, "upsert: incoming batch"))
    return (once.withColumn("_n_key", F.col("_n_had")).where(_guard(keys, "upsert: target"))
            .select(*[F.col(f"_row.`{c}`").alias(c) for c in columns]))


def _slice_frame(spark: SparkSession, slices) -> DataFrame:
    if isinstance(slices, DataFrame):
        return slices.select(F.col("season").cast("int").alias("season"),
                             F.col("week").cast("int").alias("week")).distinct()
    rows = sorted({(int(s), int(w)) for s, w in slices})
    return spark.createDataFrame(rows, "season int, week int")


def refresh_slices(target: DataFrame, incoming: DataFrame, slices, few: bool = False) -> DataFrame:
    """Delete every listed (season, week) slice from ``target``, then add ``incoming``.

    ``slices`` is a DataFrame with (season, week) or an iterable of pairs.
    Every listed week is emptied even if no new rows arrive for it (a
    partition overwrite would leave such a week in place).  Incoming rows
    outside the listed slices are not added, so the refresh is idempotent.
    A slice list from the driver, one that the caller knows to be ``few`` rows,
    or one made of small tables is broadcast, and both big sides stream through
    without a shuffle; any other is joined as the planner sees fit.
    """
    sl = _slice_frame(target.sparkSession, slices)
    sl = short(sl) if few or not isinstance(slices, DataFrame) else bounded(sl)
    keep = target.join(sl, SLICE_KEYS, "left_anti")
    new = incoming.join(sl, SLICE_KEYS, "left_semi")
    return keep.unionByName(new.select(*[c for c in target.columns if c in new.columns]),
                            allowMissingColumns=True)


def slice_counts(df: DataFrame, slices) -> DataFrame:
    """Rows per listed slice (0 for a listed slice without rows)."""
    sl = _slice_frame(df.sparkSession, slices)
    counts = df.groupBy(*SLICE_KEYS).agg(F.count(F.lit(1)).alias("rows"))
    return (sl.join(counts, SLICE_KEYS, "left")
            .select(*SLICE_KEYS, F.coalesce(F.col("rows"), F.lit(0)).alias("rows")))


def row_counts(frames: Mapping[str, DataFrame | None], spark: SparkSession | None = None) -> DataFrame:
    """(table_name, rows) for each named frame; one job, one aggregate per frame.

    A frame given as None (a table that is missing) is reported with NULL
    rows; if all are, ``spark`` (or the active session) makes the report.
    """
    if not frames:
        raise ValueError("row_counts needs at least one name")
    present = [df for df in frames.values() if df is not None]
    spark = present[0].sparkSession if present else spark or SparkSession.getActiveSession()
    parts = []
    for name, df in frames.items():
        if df is None:
            parts.append(spark.createDataFrame([(name, None)], "table_name string, rows bigint"))
        else:
            parts.append(df.agg(F.count(F.lit(1)).alias("rows"))
                         .select(F.lit(name).alias("table_name"), "rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def key_violations(df: DataFrame, keys: Sequence[str], name: str,
                   not_null: Iterable[str] = ()) -> DataFrame:
    """One row: (check_name, rows, duplicate_keys, null_keys) for a primary-key check.

    ``duplicate_keys`` counts keys that occur more than once; ``null_keys``
    counts rows with a NULL in a key or a NOT NULL column.
    """
    must: list[Column] = [F.col(c).isNull() for c in list(keys) + list(not_null)]
    any_null = must[0]
    for m in must[1:]:
        any_null = any_null | m
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                    F.count_if(any_null).alias("nulls"))
    return per_key.agg(
        F.lit(name).alias("check_name"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows"),
        F.count_if(F.col("n") > 1).alias("duplicate_keys"),
        F.coalesce(F.sum("nulls"), F.lit(0)).cast("bigint").alias("null_keys"),
    )


def check_keys(checks: Sequence[tuple[str, DataFrame, Sequence[str], Sequence[str]]]) -> DataFrame:
    """Union of ``key_violations`` for (name, frame, keys, not_null) checks."""
    out = None
    for name, df, keys, not_null in checks:
        part = key_violations(df, keys, name, not_null)
        out = part if out is None else out.unionByName(part)
    return out
