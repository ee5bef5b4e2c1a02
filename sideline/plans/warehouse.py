"""The load step: derive the two fact tables once, write them, read them back.

The source kept its facts as loaded tables and built every mart as a view
over them.  Here the facts are derived from the driver tables by Spark
(``sources.fixtures``) and written as parquet into the session's shared
checkpoint folder (``spark.checkpoint.dir``): the weekly fact partitioned by
(season, week) (season filters prune partitions, and the in-season refresh
rewrites single weeks), the schedule as one small table.
Every mart then reads these tables instead of re-deriving them from
``lineitem`` in each branch of its plan.

* Lineage is cut at the written tables, so a lost executor re-reads files
  instead of recomputing the ``lineitem`` aggregation.
* The folder name hashes the input paths, sizes and modification times, so
  changed input is loaded again.  It lies below ``sideline.warehouseDir`` if
  the session sets that, else below the folder ``spark.checkpoint.dir`` names
  (not the application's own part of it), so sessions share a load.
* Each load writes into a folder of its own and then creates one small marker
  file; readers take the first marked load.  Nothing is renamed, so stores
  without an atomic rename serve as well, a half-written load is never read,
  and concurrent loaders of the same input leave equal tables side by side.
"""

from __future__ import annotations

import hashlib
import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from sideline.schemas import HIST_SCHEDULES, HIST_WEEKLY, SLICE_LAYOUT
from sideline.session import ensure_checkpoint_dir
from sideline.sources import fixtures as FX

SOURCE_TABLES = ("lineitem", "supplier", "nation")
# Same layout as the in-season refresh (streaming.refresh), which rewrites
# single (season, week) partitions of this table.
WEEKLY_PARTITIONS = SLICE_LAYOUT
_MARKER = "_LOADED-"


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _fingerprint(spark: SparkSession, sf_dir: str) -> str:
    h = hashlib.sha1(os.path.abspath(sf_dir).encode())
    for t in SOURCE_TABLES:
        fs, p, _ = _hadoop(spark, f"{sf_dir.rstrip('/')}/{t}.parquet")
        st = fs.getFileStatus(p)
        size = fs.getContentSummary(p).getLength() if st.isDirectory() else st.getLen()
        h.update(f"{t}:{size}:{st.getModificationTime()}".encode())
    return h.hexdigest()[:16]


def warehouse_dir(spark: SparkSession, sf_dir: str) -> str:
    """Where the loads of this input are, whichever session made them."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    root = spark.conf.get("sideline.warehouseDir", None) or f"{shared.rstrip('/')}/sideline-warehouse"
    return f"{root.rstrip('/')}/{_fingerprint(spark, sf_dir)}"


def _loaded(spark: SparkSession, sf_dir: str) -> str | None:
    """The folder of the first finished load, if there is one."""
    out = warehouse_dir(spark, sf_dir)
    fs, root, _ = _hadoop(spark, out)
    if not fs.exists(root):
        return None
    names = sorted(f.getPath().getName() for f in fs.listStatus(root))
    done = [n[len(_MARKER):] for n in names if n.startswith(_MARKER)]
    return f"{out}/{done[0]}" if done else None


def stage_months(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    """Aggregate ``lineitem`` once per (supplier, month), write it to ``path``, read it back.

    The staged table is columnar and compressed (unlike an RDD checkpoint)
    and cuts the lineage; both facts derive from it.
    """
    FX.player_months(spark, sf_dir).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _write_facts(spark: SparkSession, sf_dir: str) -> None:
    out, load = warehouse_dir(spark, sf_dir), uuid.uuid4().hex
    path = f"{out}/{load}"
    # ``lineitem`` is aggregated once per (supplier, month) and staged as a
    # parquet table in the shared folder (columnar and compressed, unlike an
    # RDD checkpoint); both facts derive from it, then it is removed.
    staging = f"{path}/_supplier_months"
    months = stage_months(spark, sf_dir, staging)
    # Rebalanced on the partition columns before the partitioned write: AQE
    # splits big weeks into advisory-size files and merges small ones.
    (FX.hist_schedules(spark, sf_dir, months).hint("rebalance").write.parquet(f"{path}/hist_schedules"))
    (FX.hist_weekly(spark, sf_dir, months).hint("rebalance", *WEEKLY_PARTITIONS).write
     .partitionBy(*WEEKLY_PARTITIONS).parquet(f"{path}/hist_weekly"))
    fs, staged, jvm = _hadoop(spark, staging)
    fs.delete(staged, True)
    fs.create(jvm.org.apache.hadoop.fs.Path(out, f"{_MARKER}{load}")).close()


def is_loaded(spark: SparkSession, sf_dir: str) -> bool:
    return _loaded(spark, sf_dir) is not None


def load_facts(spark: SparkSession, sf_dir: str) -> str:
    """Make sure the fact tables for ``sf_dir`` exist; returns their folder."""
    if not is_loaded(spark, sf_dir):
        _write_facts(spark, sf_dir)
    return _loaded(spark, sf_dir)


def facts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(hist_schedules, hist_weekly) read from the loaded tables, columns in source order."""
    out = load_facts(spark, sf_dir)
    hs = spark.read.schema(HIST_SCHEDULES).parquet(f"{out}/hist_schedules")
    hw = (spark.read.schema(HIST_WEEKLY).parquet(f"{out}/hist_weekly")
          .select(*HIST_WEEKLY.fieldNames()))
    return hs, hw
