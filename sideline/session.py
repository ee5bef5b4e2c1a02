"""Session helpers.

The library never creates a session behind the caller's back; these helpers
are for tests, the bench and command-line use.  Settings the cluster already
has (from its launch configuration) always win:

* SQL defaults the marts rely on (AQE, skew join, UTC, ANSI) are applied
  only when the launch configuration does not set them;
* the UI and console progress bar are switched off only for local masters;
* ``spark.checkpoint.dir`` is taken from the session.  Only a local session
  without one (tests, the bench) gets a scratch folder; a cluster session
  without a shared folder is an error, never a machine-local fallback.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Runtime SQL settings the marts rely on.  AQE re-plans joins against measured
# sizes and coalesces the many small shuffle partitions of the team-level
# marts; skew join splits a hot join key.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}
# Launch settings for local runs only (no web UI, no progress bar).
LOCAL_LAUNCH = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def get_spark(master: str | None = None, app: str = "sideline",
              shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Build or fetch a session; explicit arguments win, then the cluster's, then ours."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            for key, value in LOCAL_LAUNCH.items():
                builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    launched = spark.sparkContext.getConf()
    for key, value in DEFAULTS.items():
        if key not in conf and not launched.contains(key):
            spark.conf.set(key, value)
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _scratch(prefix: str) -> str:
    return tempfile.mkdtemp(prefix=prefix, dir=os.environ.get("TMPDIR", "/tmp"))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; a scratch one only for a local session without one."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        current = _scratch("sideline-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current
