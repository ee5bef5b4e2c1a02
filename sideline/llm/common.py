"""Shared pieces of the training-data operators: tables, staging, components.

Nothing outside ``sideline.llm`` imports this subpackage.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sideline.session import ensure_checkpoint_dir

_held: dict[tuple, object] = {}


def keep_one(kind: str, key, make):
    """What a Python worker keeps between tasks: the last automaton, vocabulary or the like, and no others.

    Workers live as long as their executor, and a pipeline's stages follow
    each other in the same ones; caches of past stages must not pile up.
    """
    if (kind, key) not in _held:
        _held.clear()
        _held[kind, key] = make()
    return _held[kind, key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark (any file system Spark knows)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """``df`` written once as a table in the shared folder and read back.

    Cuts the lineage: whatever reads the result re-reads files when an
    executor is lost, and a frame with several readers is computed once.
    """
    path = new_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def width(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node each node of ``edges`` can reach.

    Rounds of hooking and contraction: every node points at its smallest
    neighbour, pointers are doubled until they reach local minima, then the
    edges are rewritten between those minima.  A round at least halves the
    nodes that still have edges, so the number of rounds is logarithmic.  All
    state is staged in the shared folder; nothing is collected but two counts
    a round.  Hubs are safe: the only aggregate is a ``min`` with partial
    aggregation, and the joins are plain equi-joins that AQE may split.

    Nulls never link; self-links and repeated links are allowed; an empty
    input gives an empty result.  Nodes without links are not in the result.
    """
    one = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    links = staged(one.union(one.select("v", "u")).distinct(), "links")
    steps: list[DataFrame] = []
    while links.limit(1).count():
        hop = staged(links.groupBy("u").agg(F.least("u", F.min("v")).alias("p")), "hop")
        while True:
            up = hop.select(F.col("u").alias("p"), F.col("p").alias("pp"))
            nxt = staged(hop.join(up, "p", "left")
                         .select("u", F.coalesce("pp", "p").alias("p"), (F.col("pp") < F.col("p")).alias("moved")), "hop")
            moved = nxt.where("moved").limit(1).count()
            hop = nxt.select("u", "p")
            if not moved:
                break
        steps.append(hop)
        left = hop.select("u", F.col("p").alias("pu"))
        right = hop.select(F.col("u").alias("v"), F.col("p").alias("pv"))
        links = staged(links.join(left, "u").join(right, "v").where("pu <> pv")
                       .select(F.col("pu").alias("u"), F.col("pv").alias("v")).distinct(), "links")
    if not steps:
        return one.select(F.col("u").alias("node"), F.col("v").alias("component")).limit(0)
    out = steps[0].select(F.col("u").alias("node"), F.col("p").alias("component"))
    for hop in steps[1:]:
        up = hop.select(F.col("u").alias("component"), "p")
        out = out.join(up, "component", "left").select("node", F.coalesce("p", "component").alias("component"))
    return out


def ship(spark: SparkSession) -> SparkSession:
    """Make this package importable in the session's Python workers.

    Where the repository is on ``PYTHONPATH`` the workers have it already;
    elsewhere it is zipped once a session and sent by Spark.
    """
    sc = spark.sparkContext
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    on_path = {os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    if root not in on_path and getattr(sc, "_sideline_shipped", None) is None:
        folder = tempfile.mkdtemp(prefix="sideline-code-")  # read by the driver only: Spark sends its content
        target = os.path.join(folder, "sideline_code.zip")
        with zipfile.ZipFile(target, "w") as z:
            for base, _, names in os.walk(os.path.join(root, "sideline")):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(base, name)
                        z.write(path, os.path.relpath(path, root))
        sc.addPyFile(target)
        sc._sideline_shipped = target
    return spark
