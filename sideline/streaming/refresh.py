"""In-season refresh as a Structured Streaming job.

New weekly files land in a folder during the season.  A file-source stream
picks them up; every micro-batch is aligned to the stored table's own schema
(``align.harmonize`` + ``conform``) and merged into the (season, week) slices
it touches: a row of the batch replaces the stored row of its player and week,
the other rows of the week stay.  So a week may arrive in any number of
batches.

The table is parquet partitioned by (season, week).  A micro-batch rewrites
only the partitions it carries, with Spark's dynamic partition overwrite
(``sources.io.overwrite_slices``): the work is proportional to the touched
slices, not to the table.  Merging the same rows again is idempotent, so a
micro-batch replayed after a failure (the stream's progress lives in
``checkpoint_dir``, a shared folder on a cluster) leaves the same table:
effectively exactly once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sideline.operators.align import conform, harmonize
from sideline.operators.maintain import enforce
from sideline.schemas import HIST_WEEKLY, SLICE_LAYOUT, WEEKLY_KEYS
from sideline.sources.io import check_layout, in_slices, overwrite_slices, staging, write_table


def init_table(df: DataFrame, table_dir: str) -> str:
    """Write ``df`` as the (season, week)-partitioned table."""
    return write_table(df.hint("rebalance", *SLICE_LAYOUT), table_dir, "overwrite", SLICE_LAYOUT)


def read_table(spark: SparkSession, table_dir: str, schema: T.StructType = HIST_WEEKLY) -> DataFrame:
    """The table in its schema's column order (partition columns typed by the schema)."""
    return spark.read.schema(schema).parquet(table_dir).select(*schema.fieldNames())


def refresh_batch(batch: DataFrame, table_dir: str, rejects_dir: str | None = None, epoch_id: int = 0,
                  game_type: str = "REG", keys: Sequence[str] = WEEKLY_KEYS) -> list:
    """Align one batch of feed rows to the stored table and merge it, by ``keys``, into the slices it touches.

    Rows whose season or week did not parse cannot be placed, and rows of
    another season type (or none) are not taken; with ``rejects_dir`` both are
    written to ``rejects_dir/epoch=<id>`` (overwritten on replay) instead of
    being dropped silently.  A batch whose rows repeat a key, or lack a part of
    it, fails while it is staged: nothing of it becomes visible.  Returns the
    touched slices, at most the calendar.
    """
    spark = batch.sparkSession
    check_layout(spark, table_dir, SLICE_LAYOUT)
    stored = spark.read.parquet(table_dir)
    taken = F.col("season").isNotNull() & F.col("week").isNotNull() & F.col("season_type").eqNullSafe(game_type)
    with staging(spark) as stage:
        incoming = stage(conform(harmonize(batch, stored.columns), stored.schema), "incoming")
        good = stage(enforce(incoming.where(taken), keys, what="weekly batch"), "good")
        slices = [(r[0], r[1]) for r in good.select(*SLICE_LAYOUT).distinct().collect()]
        if slices:
            arriving = good.select(*[F.col(k).alias(f"_{k}") for k in keys])
            same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
            stay = stored.where(in_slices(slices)).join(arriving, same, "left_anti")
            overwrite_slices(stage(stay.unionByName(good), "merged"), table_dir, slices, SLICE_LAYOUT)
        if rejects_dir is not None:
            write_table(incoming.where(~taken), f"{rejects_dir.rstrip('/')}/epoch={epoch_id}", "overwrite")
    return slices


def start_weekly_refresh(spark: SparkSession, landing_dir: str, table_dir: str,
                         checkpoint_dir: str, feed_schema: T.StructType,
                         available_now: bool = True, rejects_dir: str | None = None) -> StreamingQuery:
    """Start the refresh stream; ``available_now`` processes what has landed, then stops."""
    def apply(batch: DataFrame, epoch_id: int) -> None:
        refresh_batch(batch, table_dir, rejects_dir=rejects_dir, epoch_id=epoch_id)

    writer = (spark.readStream.schema(feed_schema).parquet(landing_dir)
              .writeStream.foreachBatch(apply)
              .option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
