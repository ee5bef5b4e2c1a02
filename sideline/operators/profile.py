"""Column profiles and coverage reports.

``profile`` describes every column of a table in two jobs' worth of work,
however many columns there are (the source ran three or four queries per
column):

1. one wide aggregate: non-NULL count, min, max and exact average of every
   column, unpivoted to one row per column; for columns of numbers also a
   bitmap of the whole values from 0 to 32767 (4 kB a column and task), from
   which their distinct count and smallest values follow: no such value is
   ever exchanged;
2. one long form ``(column, value)`` of the other non-NULL values (texts, and
   numbers that no bitmap holds), de-duplicated with a grouped aggregate
   (map-side partial aggregation first), from which the distinct count and the
   five smallest values per column are taken.  The five smallest use
   ``row_number() <= 5``, which Catalyst turns into a per-task
   ``WindowGroupLimit`` before the shuffle, so no task ever holds all values
   of a column.

``slice_profiles`` profiles each slice of a table (its seasons, say) by
mergeable measures, ``merge_profiles`` unites any number of slices: counts and
sums add up, distinct counts are HyperLogLog sketches.  Kept as a table, a
refreshed slice is profiled anew by itself (``plans.pipelines.refresh_profiles``).

``exact=False`` switches distinct counts to HyperLogLog
(``approx_count_distinct``) inside the wide aggregate; the examples stay
exact: each task keeps its five smallest *different* values per column
(``dense_rank() <= 5``, a ``WindowGroupLimit`` before the shuffle), so no pass
shuffles all distinct values.  For very wide or very large tables.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sideline.functions.exprs import ratio, to_decimal
from sideline.functions.joins import short
from sideline.operators.games import played

SAMPLE_VALUES = 5
SAMPLE_CHARS = 60
# Values of a bitmap (Spark's own size), and the sketches' size (2**12 registers: estimates within a few percent).
BITMAP_VALUES = 32_768
SKETCH_BITS = 12
# Slices whose smallest values a task holds at once.
MANY_SLICES = 1000
_SMALLEST = "array<struct<k:double,v:string>>"
_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)

# Sums of ids overflow a bigint; they are added up as decimals.
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _is_numeric(dt) -> bool:
    return isinstance(dt, _NUMERIC)


def _is_temporal(dt) -> bool:
    return isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType))


def profile(df: DataFrame, exact: bool = True) -> DataFrame:
    """One row per column: column_name, type, non_null, nulls, null_pct, distinct_count,
    min, max, avg (numbers), min_date, max_date (dates and timestamps, as dates), examples."""
    fields = df.schema.fields

    def measures(f) -> str:
        """One column's measures as SQL (one call a column: wide tables have many)."""
        c, num, temporal = _quoted(f.name), _is_numeric(f.dataType), _is_temporal(f.dataType)
        whole = f"CAST({c} AS DECIMAL(38,0))" if isinstance(f.dataType, _WHOLE) else c
        mean = f"CAST(round(try_divide(CAST(sum({whole}) AS DECIMAL(38,12)), CAST(count({c}) AS DECIMAL(20,0))), 3) AS DOUBLE)"
        parts = {
            "non_null": f"count({c})",
            "min": f"CAST(min({c}) AS DOUBLE)" if num else "CAST(NULL AS DOUBLE)",
            "max": f"CAST(max({c}) AS DOUBLE)" if num else "CAST(NULL AS DOUBLE)",
            "avg": mean if num else "CAST(NULL AS DOUBLE)",
            "min_date": f"CAST(min({c}) AS DATE)" if temporal else "CAST(NULL AS DATE)",
            "max_date": f"CAST(max({c}) AS DATE)" if temporal else "CAST(NULL AS DATE)",
            "approx": f"approx_count_distinct({c})" if not exact else "CAST(NULL AS BIGINT)",
            "bits": f"bitmap_construct_agg(CASE WHEN {_in_bitmap(c)} THEN CAST({c} AS BIGINT) END)" if exact and num else "X''",
        }
        return f"named_struct({', '.join(f'{_text(k)}, {v}' for k, v in parts.items())}) AS {c}"

    wide = df.agg(F.count(F.lit(1)).alias("_total"), *[F.expr(measures(f)) for f in fields])
    per_col = (wide.unpivot(["_total"], [f.name for f in fields], "column_name", "s")
               .select("column_name", "_total", "s.*"))

    def long_form(of: DataFrame, some: list, value) -> DataFrame:
        """(column_name, v, k): the non-NULL values of some columns, as texts and, if numbers, as such."""
        pairs = [f"named_struct('column_name', {_text(f.name)}, 'v', CAST({value(f)} AS STRING), 'k', CAST({value(f) if _is_numeric(f.dataType) else 'NULL'} AS DOUBLE))" for f in some]
        return of.select(F.expr(f"explode(array({', '.join(pairs)})) AS x")).select("x.*").where(F.col("v").isNotNull())

    if exact:
        # Texts, and of the numbers only the rows that have one beyond the bitmaps.
        texts, numbers = [f for f in fields if not _is_numeric(f.dataType)], [f for f in fields if _is_numeric(f.dataType)]
        any_beyond = " OR ".join(f"coalesce(NOT ({_in_bitmap(_quoted(f.name))}), FALSE)" for f in numbers)
        branches = [long_form(df, texts, lambda f: _quoted(f.name))] if texts else []
        branches += [long_form(df.where(any_beyond), numbers, lambda f: f"CASE WHEN NOT ({_in_bitmap(_quoted(f.name))}) THEN {_quoted(f.name)} END")] if numbers else []
        values = branches[0] if len(branches) == 1 else branches[0].union(branches[1])
    else:
        values = long_form(df, fields, lambda f: _quoted(f.name))
    first = Window.partitionBy("column_name").orderBy(F.col("k").asc_nulls_first(), F.col("v").asc())
    if exact:
        distinct_vals = values.distinct()
        pool = distinct_vals
    else:
        # Each task's five smallest different values of a column hold the
        # column's five smallest, however often values repeat.
        per_task = Window.partitionBy("column_name", "_task").orderBy(
            F.col("k").asc_nulls_first(), F.col("v").asc())
        pool = (values.withColumn("_task", F.spark_partition_id())
                .withColumn("rn", F.dense_rank().over(per_task))
                .where(F.col("rn") <= SAMPLE_VALUES)
                .select("column_name", "v", "k").distinct())
    samples = (pool.withColumn("rn", F.row_number().over(first))
               .where(F.col("rn") <= SAMPLE_VALUES)
               .groupBy("column_name")
               .agg(F.collect_list(F.struct("k", "v")).alias("smallest")))
    out = per_col.join(short(samples), "column_name", "left")
    if exact:
        counts = distinct_vals.groupBy("column_name").agg(F.count(F.lit(1)).alias("distinct_count"))
        out = out.join(short(counts), "column_name", "left")
        distinct = F.coalesce(F.col("distinct_count"), F.lit(0)) + F.coalesce(F.bitmap_count("bits"), F.lit(0))
    else:
        distinct = F.col("approx")
    type_col = F.expr(f"map({', '.join(f'{_text(f.name)}, {_text(f.dataType.simpleString())}' for f in fields)})")
    smallest = F.coalesce("smallest", F.array().cast(_SMALLEST))
    if exact:
        # Bits are whole numbers, written as values of the column's type are.
        kind = type_col[F.col("column_name")]

        def written(b: Column) -> Column:
            text = b.cast("string")
            for t in sorted({f.dataType.simpleString() for f in fields if _is_numeric(f.dataType)}):
                text = F.when(kind == t, b.cast(t).cast("string")).otherwise(text)
            return F.struct(b.cast("double").alias("k"), text.alias("v"))

        smallest = F.concat(F.transform(_smallest_bits(F.col("bits")), written), smallest)
    nulls = F.col("_total") - F.col("non_null")
    return out.select(
        "column_name",
        type_col[F.col("column_name")].alias("type"),
        "non_null",
        nulls.alias("nulls"),
        ratio(nulls * 100, F.col("_total"), 2).alias("null_pct"),
        distinct.cast("bigint").alias("distinct_count"),
        "min", "max", "avg", "min_date", "max_date",
        _examples(smallest).alias("examples"),
    )


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _in_bitmap(c: str) -> str:
    """SQL: whether a number is a whole one that a bitmap has a place for."""
    return f"{c} >= 0 AND {c} < {BITMAP_VALUES} AND {c} = floor({c})"


def _smallest_bits(bits: Column) -> Column:
    """The smallest places set in a bitmap, ``SAMPLE_VALUES`` of them, ascending."""
    byte = lambda i: F.conv(F.hex(F.substr(bits, i, F.lit(1))), 16, 10).cast("int")
    used = F.slice(F.filter(F.sequence(F.lit(1), F.lit(BITMAP_VALUES // 8)), lambda i: byte(i) != 0), 1, SAMPLE_VALUES)
    places = F.flatten(F.transform(used, lambda i: F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(7)), lambda b: F.when(F.getbit(byte(i), b) == 1, (i - 1) * 8 + b)), lambda p: p.isNotNull())))
    return F.slice(places, 1, SAMPLE_VALUES)


def _examples(smallest: Column | str) -> Column:
    """The smallest different values of (number, text) pairs as one text; pairs without a number come first."""
    smallest = F.col(smallest) if isinstance(smallest, str) else smallest
    first = F.slice(F.array_sort(F.array_distinct(smallest)), 1, SAMPLE_VALUES)
    return F.array_join(F.transform(first, lambda s: F.substring(s["v"], 1, SAMPLE_CHARS)), ", ")


# ---- profiles of slices, and their union -------------------------------------------
def slice_profiles(df: DataFrame, by: Sequence[str] = ("season",)) -> DataFrame:
    """One row per slice and column: ``by``, column_name, type, total_rows, non_null, min, max, total, sketch, smallest.

    ``sketch`` is a HyperLogLog sketch of the values' texts; ``smallest`` holds
    the slice's five smallest different values, taken from each task's five.
    One aggregate by slice (partial before the exchange), one pass that keeps
    a few rows a task (``_few_smallest``); only those take the long form.
    The columns in ``by`` are profiled from the slices' keys when they are united.
    """
    fields = [f for f in df.schema.fields if f.name not in by]
    stats = []
    for f in fields:
        c, num = F.col(f.name), _is_numeric(f.dataType)
        nothing = F.lit(None).cast("double")
        stats.append(F.struct(
            F.lit(f.dataType.simpleString()).alias("type"),
            F.count(c).alias("non_null"),
            (F.min(c).cast("double") if num else nothing).alias("min"),
            (F.max(c).cast("double") if num else nothing).alias("max"),
            (to_decimal(F.sum(c.cast("decimal(38,0)") if isinstance(f.dataType, _WHOLE) else c)) if num else F.lit(None).cast("decimal(38,12)")).alias("total"),
            F.hll_sketch_agg(F.concat(F.lit("="), c.cast("string")), F.lit(SKETCH_BITS)).alias("sketch"),  # sketches skip empty texts
        ).alias(f.name))
    wide = df.groupBy(*by).agg(F.count(F.lit(1)).alias("total_rows"), *stats)
    names = [f.name for f in fields]
    stats_rows = wide.unpivot([*by, "total_rows"], names, "column_name", "s").select(*by, "column_name", "total_rows", "s.*")
    small = _few_smallest(df, by)
    values = small.select(*by, F.explode(F.array(*[
        F.struct(F.lit(f.name).alias("column_name"), small[f.name].cast("string").alias("v"),
                 (small[f.name].cast("double") if _is_numeric(f.dataType) else F.lit(None).cast("double")).alias("k"))
        for f in fields])).alias("x")).select(*by, "x.*").where(F.col("v").isNotNull())
    few = values.groupBy(*by, "column_name").agg(F.collect_set(F.struct("k", "v")).alias("smallest"))
    few = few.withColumn("smallest", F.slice(F.array_sort("smallest"), 1, SAMPLE_VALUES))
    same = [stats_rows[c].eqNullSafe(few[c]) for c in [*by, "column_name"]]
    return stats_rows.join(few, same, "left").select(*[stats_rows[c] for c in stats_rows.columns], "smallest")


def _few_smallest(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows with each task's few smallest different values of every column, slice by slice; columns that are no numbers as texts.

    A row's values do not belong together: each column's are listed by
    themselves, padded with NULL.
    """
    others = [f for f in df.schema.fields if f.name not in by]
    numbers = [f.name for f in others if _is_numeric(f.dataType)]
    typed = df.select(*by, *[F.col(_quoted(f.name)) if f.name in numbers else F.col(_quoted(f.name)).cast("string").alias(f.name) for f in others])
    return typed.mapInArrow(_keep_few(list(by), numbers), T.StructType([T.StructField(f.name, f.dataType) for f in typed.schema.fields]))


def _keep_few(by: list[str], numbers: list[str]):
    def merged(held: pa.Array | None, column: pa.Array, number: bool) -> pa.Array:
        """The smallest different values of both; values whose order Spark alone tells apart are all kept."""
        if held is not None and len(held) >= SAMPLE_VALUES and not number:
            column = column.filter(pc.less(column, held[-1]))
        column = column.drop_null()
        if held is not None:
            column = pa.concat_arrays([held, column]) if len(column) else held
        bits = {pa.float32(): pa.int32(), pa.float64(): pa.int64()}.get(column.type)
        column = (column.view(bits) if bits else column).unique()  # bits: -0.0 and 0.0 are two texts
        column = column.view(pa.float64() if bits == pa.int64() else pa.float32()) if bits else column
        if not number:
            return column.take(pc.array_sort_indices(column)[:SAMPLE_VALUES])
        if len(column) <= SAMPLE_VALUES:
            return column
        order = np.array([float(x) for x in column.to_pylist()]) if pa.types.is_decimal(column.type) else column.to_numpy(zero_copy_only=False).astype(float)
        limit = np.partition(order, SAMPLE_VALUES - 1)[SAMPLE_VALUES - 1]  # NaN is the largest, as in Spark
        near = column if np.isnan(limit) else column.take(pa.array(np.flatnonzero(order <= limit)))
        if len(near) <= 2 * SAMPLE_VALUES:
            return near
        # Many values with one double, or many NaN: by their texts, as the examples are.
        shown = sorted((np.isnan(float(x)), float(x), format(x, "f") if pa.types.is_decimal(near.type) else str(x), i) for i, x in enumerate(near.to_pylist()))
        return near.take(pa.array([i for *_, i in shown[:SAMPLE_VALUES]]))

    def few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, dict[str, pa.Array]] = {}
        schema = None

        def flush() -> pa.RecordBatch:
            columns: dict[str, list] = {name: [] for name in schema.names}
            for key, kept in held.items():
                n = max(map(len, kept.values()), default=0)
                for name, value in zip(by, key, strict=True):
                    columns[name].append(pa.array([value] * n, schema.field(name).type))
                for name, values in kept.items():
                    columns[name] += [values, pa.nulls(n - len(values), values.type)]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.concat_arrays(columns[f.name]) if columns[f.name] else pa.array([], f.type) for f in schema], schema=schema)

        for batch in batches:
            schema = pa.schema([(f.name, f.type) for f in batch.schema])
            keys = pa.Table.from_batches([batch.select(by)])
            slices = keys.group_by(by, use_threads=False).aggregate([([], "count_all")])
            if slices.num_rows > 1:
                batch = batch.take(pc.sort_indices(keys, [(name, "ascending") for name in by]))
                keys = pa.Table.from_batches([batch.select(by)])
                slices = keys.group_by(by, use_threads=False).aggregate([([], "count_all")])
            first = 0
            for row in slices.to_pylist():
                kept = held.setdefault(tuple(row[name] for name in by), {})
                for name in schema.names:
                    if name not in by:
                        kept[name] = merged(kept.get(name), batch.column(name).slice(first, row["count_all"]), name in numbers)
                first += row["count_all"]
            if len(held) >= MANY_SLICES:
                yield flush()
        if held:
            yield flush()

    return few


def merge_profiles(slices: DataFrame) -> DataFrame:
    """The profile of all slices together; ``distinct_count`` is an estimate of their united sketches."""
    united = slices.groupBy("column_name", "type").agg(
        F.sum("total_rows").alias("_total"), F.sum("non_null").alias("non_null"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.sum("total").alias("total"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_count"),
        F.flatten(F.collect_list("smallest")).alias("smallest"))
    nulls = F.col("_total") - F.col("non_null")
    return united.select(
        "column_name", "type", "non_null", nulls.alias("nulls"), ratio(nulls * 100, F.col("_total"), 2).alias("null_pct"), "distinct_count", "min", "max",
        F.when(F.col("min").isNotNull(), ratio(F.col("total"), F.col("non_null"), 3)).alias("avg"),
        _examples("smallest").alias("examples"))


def season_range(df: DataFrame) -> DataFrame:
    """Earliest and latest season (one row)."""
    return df.agg(F.min(F.col("season").cast("int")).alias("min_season"),
                  F.max(F.col("season").cast("int")).alias("max_season"))


def games_by_season(schedules: DataFrame) -> DataFrame:
    """Scored games per season."""
    return (played(schedules).groupBy(F.col("season").cast("int").alias("season"))
            .agg(F.count(F.lit(1)).alias("games_scored")))


def weekly_rows_by_season(weekly: DataFrame) -> DataFrame:
    return (weekly.groupBy(F.col("season").cast("int").alias("season"))
            .agg(F.count(F.lit(1)).alias("rows")))


def position_counts(weekly: DataFrame, k: int = 10) -> DataFrame:
    """Rows per position (NULL shown as ``(null)``), the ``k`` most common."""
    return (weekly.groupBy(F.coalesce(F.col("position"), F.lit("(null)")).alias("position"))
            .agg(F.count(F.lit(1)).alias("rows"))
            .orderBy(F.col("rows").desc(), F.col("position").asc())
            .limit(k))


def team_codes(schedules: DataFrame) -> DataFrame:
    """Every team code seen as home or away team."""
    return (schedules.select(F.explode(F.array("home_team", "away_team")).alias("team"))
            .where(F.col("team").isNotNull()).distinct())


def completed_weeks(schedules: DataFrame, season: int | None = None,
                    game_type: str = "REG") -> DataFrame:
    """(season, week) with at least one scored game of ``game_type``.

    ``season=None`` means the latest season of the schedule.
    """
    s = played(schedules).where(F.col("game_type") == game_type)
    if season is None:
        s = s.where(F.col("season") == schedules.agg(F.max("season")).scalar())
    else:
        s = s.where(F.col("season") == season)
    return s.select(F.col("season").cast("int").alias("season"),
                    F.col("week").cast("int").alias("week")).distinct()
