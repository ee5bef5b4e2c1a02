"""Exact top-k by inner product over vectors bucketed by length.

Candidates are range-partitioned by length, longest first (ties by id, so
equal vectors spread), and cut into buckets of bounded size.  Queries are cut
into blocks.  A first pass over the longest vectors gives each query a score,
and an id for ties, that its k best must reach; then each block goes to those
ranges of buckets whose longest vectors can reach it.  For each query and
bucket, that score divided by the query's length and the bucket's largest
length is a local threshold of the cosine:

* above 1, the bucket is left out;
* high, its vectors are pruned by coordinates: a partner above that cosine
  has each of the query's largest coordinates within a narrow band;
* low, they are pruned by length alone, a prefix of the bucket.

What is left is verified by whole inner products of integers.  The bounds hold
for all vectors, so the result is exact.

Defined results: components are turned into integers by ``floor(scale * x)``;
vectors that are null or hold null or non-finite components take no part, and
neither do rows without ``vec_id``; each length of vectors is searched for
itself (an empty vector scores 0 with the empty ones);
candidates with the query's ``vec_id`` are its own row; a query row that is
repeated is answered as often; fewer than k candidates are all returned;
scores beyond a long are cut to it; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sideline.llm.batches import table_batch
from sideline.llm.common import staged, width
from sideline.llm.vectors import EXACT, binaries, integer_products, matrix, rows_of

#: Candidates in a bucket, queries in a block.
BUCKET, QUERIES = 2048, 256
#: Ranges of neighbouring buckets within one task's buckets, at most.
RANGES = 4096
#: Local cosine threshold from which coordinates prune better than length; coordinates looked at.
COORDINATE_COSINE, FOCUS = 0.3, 4


def _scaled(dims: int, scale: float):
    schema = pa.schema([("vec_id", pa.int64()), ("length", pa.float64()), ("v", pa.binary())])

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, ok = matrix(batch.column("embedding"), dims)
            ok &= batch.column("vec_id").is_valid().to_numpy(zero_copy_only=False)
            with np.errstate(over="ignore"):
                x = np.floor(scale * x[ok])
            x = np.clip(np.nan_to_num(x), -1e300, 1e300)
            big = np.maximum(np.abs(x).max(axis=1, initial=0), 1)
            length = np.sqrt(((x / big[:, None]) ** 2).sum(axis=1)) * big
            yield table_batch(schema, [batch.column("vec_id").filter(pa.array(ok)), pa.array(length), binaries(x)])

    return scaled


_BLOCK = "block long, most double, ids binary, lengths binary, vs binary"


def _blocks(size: int):
    schema = pa.schema([("block", pa.int64()), ("most", pa.float64()), ("ids", pa.binary()), ("lengths", pa.binary()), ("vs", pa.binary())])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []

        def cut(rows: pa.Table) -> pa.RecordBatch:
            ids, lengths = rows.column("vec_id").to_numpy(), rows.column("length").to_numpy()
            return table_batch(schema, [[task << 32 | made], [float(lengths.max())], [ids.tobytes()], [lengths.tobytes()], [b"".join(x.as_buffer() for x in rows.column("v"))]])

        for batch in batches:
            held.append(batch)
            rows = pa.Table.from_batches(held)
            while rows.num_rows >= size:
                yield cut(rows.slice(0, size))
                made += 1
                rows = rows.slice(size)
            held = rows.to_batches()
        if held:
            yield cut(pa.Table.from_batches(held))

    return blocks


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores (long), ties to smaller ids; ~ turns the order without overflow."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        on = np.flatnonzero(scores >= least)
        return on[np.lexsort((ids[on], ~scores[on]))[:k]]
    return np.lexsort((ids, ~scores))[:k]


def prune(q: np.ndarray, q_length: float, needed: float, v: np.ndarray, lengths: np.ndarray, focus: int = FOCUS) -> np.ndarray:
    """Positions of the bucket's vectors (longest first) that may score at least ``needed`` with ``q``."""
    if not np.isfinite(needed) or needed <= 0 or q_length == 0:
        return np.arange(len(v))
    slack = 1e-9
    local = needed / (q_length * lengths[0]) if lengths[0] > 0 else np.inf
    if local > 1 + slack:
        return np.empty(0, np.int64)
    # By length: |v| >= needed / |q|.
    last = int(np.searchsorted(-lengths, -(needed / q_length) * (1 - slack), "right"))
    if local < COORDINATE_COSINE:
        return np.arange(last)
    # By coordinates: each coordinate of a unit vector with cosine t or more to a unit query is near the query's.
    t = min(1.0, local)
    unit = q / q_length
    keep = np.arange(last)
    for f in np.argsort(-np.abs(unit), kind="stable")[:focus]:
        wide = np.sqrt(max(0.0, (1 - t * t) * (1 - unit[f] ** 2)))
        top = 1.0 if unit[f] >= t else unit[f] * t + wide
        low = -1.0 if unit[f] <= -t else unit[f] * t - wide
        part = v[keep, f] / np.maximum(lengths[keep], 1e-300)
        keep = keep[(part >= low - slack) & (part <= top + slack)]
    return keep


def _answer(dims: int, k: int, seeding: bool):
    schema = pa.schema([("block", pa.int64()), ("q", pa.int32()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())]
                       if not seeding else [("block", pa.int64()), ("most", pa.float64()), ("ids", pa.binary()), ("lengths", pa.binary()), ("vs", pa.binary()), ("needed", pa.binary()), ("needed_id", pa.binary()), ("reach", pa.float64())])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q_ids, q_lengths = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["lengths"])
                qs = np.frombuffer(row["vs"]).reshape(len(q_ids), dims)
                ids, lengths, vs = np.frombuffer(row["b_ids"], np.int64), np.frombuffer(row["b_lengths"]), np.frombuffer(row["b_vs"])
                vs = vs.reshape(len(ids), dims)
                if seeding:
                    scores = integer_products(qs, vs, dims).astype(np.float64)
                    scores[q_ids[:, None] == ids[None, :]] = -np.inf
                    # The k-th best of the bucket, by score and then by id: what comes behind it is in no answer.
                    at = np.lexsort((np.broadcast_to(ids, scores.shape), -scores), axis=1)[:, k - 1] if len(ids) >= k else np.zeros(len(qs), np.int64)
                    needed = scores[np.arange(len(qs)), at] if len(ids) >= k else np.full(len(qs), -np.inf)
                    needed = np.where(np.abs(needed) < EXACT, needed, -np.inf)
                    with np.errstate(divide="ignore", invalid="ignore"):
                        reach = np.where(needed > 0, needed / np.maximum(q_lengths, 1e-300), 0)
                    yield table_batch(schema, [[row[c]] for c in ("block", "most", "ids", "lengths", "vs")] + [[needed.tobytes()], [ids[at].tobytes()], [float(reach.min())]])
                    continue
                needed, needed_id = np.frombuffer(row["needed"]), np.frombuffer(row["needed_id"], np.int64)
                out: list[list[np.ndarray]] = [[], [], [], []]
                for i in range(len(qs)):
                    keep = prune(qs[i], q_lengths[i], needed[i], vs, lengths)
                    keep = keep[ids[keep] != q_ids[i]]
                    scores = integer_products(qs[i: i + 1], vs[keep], dims)[0]
                    on = (scores > needed[i]) | ((scores == needed[i]) & (ids[keep] <= needed_id[i]))
                    keep, scores = keep[on], scores[on]
                    at = best(scores, ids[keep], k)
                    for column, value in zip(out, (np.full(len(at), i), np.full(len(at), q_ids[i]), ids[keep[at]], scores[at]), strict=True):
                        column.append(value)
                cols = [np.concatenate(c) if c else np.empty(0, np.int64) for c in out]
                yield table_batch(schema, [pa.array(np.full(len(cols[0]), row["block"], np.int64)), pa.array(cols[0].astype(np.int32)), *(pa.array(c.astype(np.int64)) for c in cols[1:])])

    return answer


def top_inner(vectors: DataFrame, is_query, k: int = 20, scale: float = 64.0) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of ``vectors`` for each of its rows where ``is_query`` holds.

    Queries are answered from the vectors of their own length.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where("embedding is not null")
    lengths = sorted(r["n"] for r in rows.select(F.size("embedding").alias("n")).distinct().collect())
    out = rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    for dims in lengths:
        out = out.union(_one_length(rows.where(F.size("embedding") == dims), is_query, dims, k, scale))
    return out


def _one_length(rows: DataFrame, is_query, dims: int, k: int, scale: float) -> DataFrame:
    """``top_inner`` of vectors with ``dims`` components."""
    whole = staged(rows.mapInArrow(_scaled(dims, scale), "vec_id long, length double, v binary"), "vectors")
    if whole.isEmpty():
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    order = (F.desc("length"), "vec_id")
    buckets = staged(whole.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_blocks(BUCKET), _BLOCK), "buckets")
    queries = staged(whole.where(is_query).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_blocks(QUERIES), _BLOCK), "queries")
    renamed = buckets.select(F.col("block").alias("bucket"), F.col("most").alias("b_most"), F.col("ids").alias("b_ids"), F.col("lengths").alias("b_lengths"), F.col("vs").alias("b_vs"))
    # The longest vectors, one bucket's worth however the others are cut: one task of bounded size.
    longest = whole.orderBy(*order).limit(BUCKET).coalesce(1).sortWithinPartitions(*order).mapInArrow(_blocks(BUCKET), _BLOCK)
    first = longest.select(F.col("ids").alias("b_ids"), F.col("lengths").alias("b_lengths"), F.col("vs").alias("b_vs"), F.lit(1).alias("one"))
    seeded = staged(queries.withColumn("one", F.lit(1)).join(F.broadcast(first), "one").mapInArrow(
        _answer(dims, k, True), f"{_BLOCK}, needed binary, needed_id binary, reach double"), "seeded")
    # Buckets next to each other in the order of length are a range; a block goes to the ranges that it can reach, at most RANGES.
    parallel = width(rows.sparkSession)
    size = max(1, -(-buckets.count() // RANGES))
    ranged = renamed.withColumns({"range": F.shiftright("bucket", 32), "part": F.floor((F.col("bucket") % (1 << 32)) / size)})
    tops = F.array(*[F.struct(F.lit(r["range"]).alias("range"), F.lit(r["part"]).alias("part"), F.lit(r["top"]).alias("top"))
                     for r in ranged.groupBy("range", "part").agg(F.max("b_most").alias("top")).collect()])
    reached = F.filter(tops, lambda t: t["top"] * (1 + 1e-9) >= F.col("reach"))
    asked = seeded.withColumn("to", F.explode(reached)).withColumns({"range": F.col("to.range"), "part": F.col("to.part")}).drop("to")
    met = (asked.repartition(parallel, "range", "part").join(ranged.repartition(parallel, "range", "part").hint("merge"), ["range", "part"])
           .where(F.col("b_most") * (1 + 1e-9) >= F.col("reach")))
    found = met.select("block", "ids", "lengths", "vs", "needed", "needed_id", "b_ids", "b_lengths", "b_vs").mapInArrow(
        _answer(dims, k, False), "block long, q int, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("block", "q").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_exact_top_k(spark, sf_dir: str) -> DataFrame:
    """Contract query: the 20 best rows for each row of ``embeddings`` whose id is divisible by 20."""
    from sideline.llm.common import table

    return top_inner(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
