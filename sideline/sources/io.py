"""Readers and writers for landed files.

Readers are lazy; season and week filters are plain predicates that Catalyst
turns into partition pruning (for data written ``partitionBy('season')``)
or parquet row-group pushdown.  Writers never read and overwrite the same
path in one job: a refresh writes its result to a new path.

Writers that are given keys refuse a repeated or NULL key (and NULL in a NOT
NULL column) in the same pass as the write: a partitioned table is replaced by
dynamic partition overwrite, which shows nothing of a job that fails, a table
without partitions is staged first.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sideline.operators.maintain import enforce
from sideline.session import ensure_checkpoint_dir

DIVISION_SCHEMA = T.StructType([
    T.StructField("season", T.IntegerType()),
    T.StructField("team", T.StringType()),
    T.StructField("conference", T.StringType()),
    T.StructField("division", T.StringType()),
])


def _exists(spark: SparkSession, path: str) -> bool:
    """Path check through Hadoop's file system (works for local and cluster stores)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def load_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The whole parquet file or folder, or None if it is missing or has no rows."""
    if not _exists(spark, path):
        return None
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    return None if df.isEmpty() else df


def read_seasons(spark: SparkSession, path: str, seasons: Iterable[int] | None = None,
                 weeks: Iterable[int] | None = None) -> DataFrame:
    """A season (and optionally week) slice of a landed table."""
    df = spark.read.parquet(path)
    if seasons is not None:
        df = df.where(F.col("season").isin([int(s) for s in seasons]))
    if weeks is not None:
        df = df.where(F.col("week").isin([int(w) for w in weeks]))
    return df


def read_csv_typed(spark: SparkSession, path: str,
                   schema: T.StructType = DIVISION_SCHEMA) -> DataFrame | None:
    """CSV with a header and declared types, or None if the file is missing."""
    if not _exists(spark, path):
        return None
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: Sequence[str] = ()) -> str:
    """Write parquet (replace or append), optionally partitioned; returns the path."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def append_nonempty(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> bool:
    """Append ``df`` unless it has no rows; returns whether anything was written.

    ``df`` is evaluated once: appending nothing leaves the table as it is, and
    the written rows are counted on the way.
    """
    check_layout(df.sparkSession, path, partition_by)
    seen = Observation()
    write_table(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, "append", partition_by)
    return seen.get["rows"] > 0


def write_csv(df: DataFrame, path: str) -> str:
    """CSV with a header (profiles, drift lists), one folder of part files."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def partition_layout(spark: SparkSession, path: str) -> list[str] | None:
    """The partition columns of a stored table, outermost first; None if nothing is stored there."""
    jvm = spark.sparkContext._jvm
    here = jvm.org.apache.hadoop.fs.Path(path)
    fs = here.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(here):
        return None
    layout: list[str] = []
    while True:
        inside = [f for f in fs.listStatus(here) if not f.getPath().getName().startswith(("_", "."))]
        folders = [f.getPath() for f in inside if f.isDirectory() and "=" in f.getPath().getName()]
        if not folders:
            return layout if layout or inside else None
        layout.append(folders[0].getName().split("=")[0])
        here = folders[0]


def check_layout(spark: SparkSession, path: str, partition_by: Sequence[str]) -> None:
    """Refuse to write into a table of another layout (mixed layouts cannot be read back)."""
    stored = partition_layout(spark, path)
    if stored is not None and stored != list(partition_by):
        raise ValueError(f"{path} is partitioned by {stored or 'nothing'}, not by {list(partition_by)}")


def in_slices(slices: Iterable[tuple[int, int]]):
    """Literal predicate on (season, week), which prunes partitions."""
    weeks: dict[int, list[int]] = {}
    for season, week in sorted({(int(s), int(w)) for s, w in slices}):
        weeks.setdefault(season, []).append(week)
    cond = F.lit(False)
    for season, some in weeks.items():
        cond = cond | ((F.col("season") == season) & F.col("week").isin(some))
    return cond


def drop_partitions(spark: SparkSession, path: str, partition_by: Sequence[str], values: Iterable[tuple]) -> None:
    """Remove the named partitions of a table (at most the calendar's)."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for value in values:
        part = jvm.org.apache.hadoop.fs.Path(root, "/".join(f"{c}={v}" for c, v in zip(partition_by, value, strict=True)))
        if fs.exists(part):
            fs.delete(part, True)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> set[tuple]:
    """Rewrite the partitions that ``df`` has rows for; returns them, observed while they are written."""
    seen = Observation()
    (df.observe(seen, F.collect_set(F.struct(*partition_by)).alias("present")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path))
    return {tuple(r) for r in seen.get["present"] or ()}


@contextmanager
def staging(spark: SparkSession) -> Iterator[Callable[..., DataFrame]]:
    """A function that writes a frame to the shared checkpoint folder once and reads it back; all of it is removed at the end."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/staging-{uuid.uuid4().hex}"

    def stage(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
        write_table(df, f"{root}/{name}", "errorifexists", partition_by)
        return spark.read.schema(df.schema).parquet(f"{root}/{name}").select(*[F.col(f"`{c}`") for c in df.columns])

    try:
        yield stage
    finally:
        jvm = spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(root)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), keys: Sequence[str] = (), not_null: Sequence[str] = ()) -> str:
    """Replace a table by ``df``; where it is refused, the table stays as it was.

    A partitioned table is rewritten partition by partition when the job
    commits, then the partitions that got no new rows go.  The frame is
    evaluated once.
    """
    spark = df.sparkSession
    checked = enforce(df, keys, not_null, path.rstrip("/").rsplit("/", 1)[-1])
    layout = partition_layout(spark, path)
    if layout is None:
        return write_table(checked, path, "overwrite", partition_by)
    if not partition_by or layout != list(partition_by):
        with staging(spark) as stage:
            return write_table(stage(checked, "table"), path, "overwrite", partition_by)
    had = {tuple(r) for r in spark.read.parquet(path).select(*partition_by).distinct().collect()}
    present = overwrite_partitions(checked, path, partition_by)
    drop_partitions(spark, path, partition_by, had - present)
    return path


def overwrite_slices(df: DataFrame, path: str, slices: Iterable[tuple[int, int]],
                     partition_by: Sequence[str] = ("season", "week"),
                     keys: Sequence[str] = (), not_null: Sequence[str] = ()) -> list[tuple[int, int]]:
    """Replace the listed (season, week) partitions of a table with ``df``'s rows.

    Partitions ``df`` has rows for are rewritten by Spark's dynamic
    partition overwrite (only those partitions: O(slice), not O(table));
    listed partitions without new rows are deleted, so every listed week
    ends up holding exactly the new rows.  ``df`` is evaluated once: rows
    outside the list, and keys that repeat or are NULL, fail that job, and
    the slices it wrote are observed on the way (at most the listed ones
    reach the driver).  Running it twice with the same input gives the same
    table.  Returns the emptied slices.
    """
    spark = df.sparkSession
    check_layout(spark, path, partition_by)
    listed = {(int(s), int(w)) for s, w in slices}
    outside = "rows outside the listed slices: "
    shown = F.concat_ws("-", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in partition_by])
    guard = F.when(F.coalesce(in_slices(listed), F.lit(False)), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit(outside), shown)))
    try:
        present = overwrite_partitions(enforce(df, keys, not_null, path.rstrip("/").rsplit("/", 1)[-1]).where(guard), path, partition_by)
    except Exception as refused:
        if outside in str(refused):
            raise ValueError(f"{outside}{str(refused).split(outside)[1].splitlines()[0][:60]}") from refused
        raise
    emptied = sorted(listed - {(int(s), int(w)) for s, w in present})
    drop_partitions(spark, path, partition_by, emptied)
    return emptied


def append_batch(df: DataFrame, path: str, batch: str, column: str = "batch") -> int:
    """Append ``df`` as the batch named ``batch``; appending the batch again replaces it, so a re-run doubles nothing.

    The batch is the table's partition (``column``), written by dynamic
    partition overwrite.  A batch without rows writes nothing, and takes away
    what an earlier run of it wrote.  Returns its rows, counted on the way.
    """
    spark = df.sparkSession
    check_layout(spark, path, (column,))
    seen = Observation()
    (df.withColumn(column, F.lit(str(batch))).observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path))
    rows = seen.get["rows"] or 0
    if not rows:
        drop_partitions(spark, path, (column,), [(str(batch),)])
    return rows


def merge_into(incoming: DataFrame, path: str, schema: T.StructType, keys: Sequence[str], not_null: Sequence[str] = (),
               partition_by: Sequence[str] = ("season",)) -> list[tuple]:
    """Upsert ``incoming`` into the stored table, touching only the partitions it has rows for.

    The batch is checked and staged in one pass; its partitions (bounded by
    the calendar) become a literal filter on the table, so only those are
    read, united with the batch, and rewritten when the job commits.  A row
    with a stored key replaces it.  A batch that repeats a key, or holds NULL
    in a key or NOT NULL column, is refused and the table stays as it was; so
    does a merge that is run again.  Returns the partitions it touched.
    """
    spark = incoming.sparkSession
    check_layout(spark, path, partition_by)
    have = set(incoming.columns)
    typed = incoming.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])
    with staging(spark) as stage:
        arriving = stage(enforce(typed, keys, not_null, path.rstrip("/").rsplit("/", 1)[-1]), "arriving")
        touched = sorted(tuple(r) for r in arriving.select(*partition_by).distinct().collect())
        if not touched:
            return []
        merged = arriving
        if partition_layout(spark, path) is not None:
            here = F.lit(False)
            for value in touched:
                one = F.lit(True)
                for c, v in zip(partition_by, value, strict=True):
                    one = one & (F.col(c) == F.lit(v))
                here = here | one
            stored = spark.read.schema(schema).parquet(path).where(here)
            stay = stored.join(arriving.select(*keys), list(keys), "left_anti").select(*schema.fieldNames())
            merged = stage(stay.union(arriving), "merged")
        overwrite_partitions(merged, path, partition_by)
    return touched
