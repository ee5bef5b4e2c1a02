"""Token counts of documents from flat token files, by a scan for separators.

A flat token file is nothing but ids, one after the other, with an
end-of-document id behind each document: no index, no lengths.  Files are
taken in blocks of ids that know nothing of documents.  In each block the
separators are found by one vectorised comparison; a document that runs over
blocks is stitched together by a prefix scan over the blocks' summaries (ids
so far, documents so far, place of the last separator), in two levels: within
spans of blocks, and over the spans of a file.  So one file may be as large as
it likes.  Blocks themselves are never shuffled: their summaries are, and the
separator places of a block once, to meet what was before it.

Defined results: a null text is empty and has no tokens; two separators in a
row are an empty document; ids behind the last separator are an unfinished
document; a file without ids has none; a null ``doc_id`` is counted like any
other; repeated rows are counted each; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sideline.llm.batches import as_binary, buffer, table_batch
from sideline.llm.common import staged
from sideline.llm.tokens import encoder

#: The end-of-document id of the default vocabulary.
SEPARATOR = 50_256
#: Ids in one block, blocks in one span of the prefix scan.
BLOCK_IDS, SPAN_BLOCKS = 1 << 18, 1024


def _blocks(width: int, block_ids: int):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = block_ids * width
        for batch in batches:
            for file, content in zip(batch.column("path").to_pylist(), as_binary(batch.column("content")), strict=True):
                data = content.as_buffer()
                for k in range(0, len(data) // width * width, step):
                    part = data.slice(k, min(step, len(data) // width * width - k))
                    yield pa.RecordBatch.from_pydict({"file": pa.array([file]), "block": pa.array([k // step], pa.int64()), "payload": pa.array([part.to_pybytes()], pa.binary())})

    return blocks


def read_token_files(spark: SparkSession, path: str, width: int = 2, block_ids: int = BLOCK_IDS) -> DataFrame:
    """(file, block, payload) of flat files of ``width``-byte little-endian ids below ``path``; bytes of a cut-off last id are left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInArrow(_blocks(width, block_ids), "file string, block long, payload binary")


def _tokenise(separator: int, block_ids: int, vocabulary: str | None):
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("payload", pa.binary()), ("nth", pa.int64()), ("doc_id", pa.int64())])

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(vocabulary)
        end = np.array([separator], bpe.dtype).tobytes()
        file, size = f"{TaskContext.get().partitionId():08d}", block_ids * bpe.dtype.itemsize
        held, block, nth = bytearray(), 0, 0
        for batch in batches:
            ids = batch.column("doc_id")
            yield table_batch(schema, [[file] * len(ids), pa.nulls(len(ids), pa.int64()), pa.nulls(len(ids), pa.binary()), pa.array(np.arange(nth, nth + len(ids))), ids])
            nth += len(ids)
            for text in batch.column("text"):
                held += bpe.encode(text.as_py() or "") + end
                while len(held) >= size:
                    yield table_batch(schema, [[file], [block], [bytes(held[:size])], [None], [None]])
                    del held[:size]
                    block += 1
        if held:
            yield table_batch(schema, [[file], [block], [bytes(held)], [None], [None]])

    return tokenise


def token_blocks(docs: DataFrame, separator: int = SEPARATOR, block_ids: int = BLOCK_IDS, vocabulary: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(blocks, names): the token files of ``docs`` as blocks (file, block, payload), and which document is the nth of a file (file, nth, doc_id).

    Each task writes one file.  Both come from one write, so a recomputed
    task cannot disagree with itself.
    """
    out = staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _tokenise(separator, block_ids, vocabulary), "file string, block long, payload binary, nth long, doc_id long"), "tokens")
    return out.where("block is not null").select("file", "block", "payload"), out.where("nth is not null").select("file", "nth", "doc_id")


def _scan(separator: int, width: int):
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("found", pa.int64()), ("last", pa.int64()), ("places", pa.binary())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = np.dtype(f"<u{width}")
        for batch in batches:
            for file, block, payload in zip(batch.column("file"), batch.column("block"), batch.column("payload"), strict=True):
                ids = np.frombuffer(payload.as_buffer(), kind)
                places = np.flatnonzero(ids == separator)
                yield table_batch(schema, [[file.as_py()], [block.as_py()], [len(ids)], [len(places)], [int(places[-1]) if len(places) else None], [places.astype("<i8").tobytes()]])

    return scan


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("file", pa.string()), ("nth", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
    for batch in batches:
        data, offsets = buffer(batch.column("places"))
        places = np.frombuffer(data.tobytes(), "<i8")
        count = np.diff(offsets) // 8
        row = np.repeat(np.arange(batch.num_rows), count)
        first = np.cumsum(count) - count
        at = places + batch.column("base").to_numpy()[row]
        before = np.empty(len(at), np.int64)
        before[1:] = at[:-1]
        heads = first[count > 0]
        before[heads] = batch.column("before").to_numpy()[count > 0]
        nth = batch.column("docs").to_numpy()[row] + np.arange(len(at)) - first[row]
        yield table_batch(schema, [batch.column("file").take(pa.array(row)), pa.array(nth), pa.array(before + 1), pa.array(at - before - 1)])


def _prefixes(summaries: DataFrame, span: int) -> DataFrame:
    """(file, block, base, docs, before): ids, documents and the place of the last separator before each block.

    Two levels: blocks are scanned within spans of ``span`` blocks, the spans'
    sums within files, and both are added up.  A task holds one span's blocks,
    or one row a span, however large a file is.
    """
    def before(keys: list[str], order: str) -> Window:
        return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)

    zero, none = F.lit(0), F.lit(-1)
    inner = before(["file", "span"], "block")
    blocks = summaries.withColumn("span", F.floor(F.col("block") / span))
    blocks = blocks.withColumns({"base": F.coalesce(F.sum("n").over(inner), zero), "docs": F.coalesce(F.sum("found").over(inner), zero)})
    blocks = blocks.withColumn("before", F.max(F.col("base") + F.col("last")).over(inner))
    spans = blocks.groupBy("file", "span").agg(F.sum("n").alias("n"), F.sum("found").alias("found"), F.max(F.col("base") + F.col("last")).alias("last"))
    outer = before(["file"], "span")
    spans = spans.withColumns({"s_base": F.coalesce(F.sum("n").over(outer), zero), "s_docs": F.coalesce(F.sum("found").over(outer), zero)})
    spans = spans.withColumn("s_before", F.max(F.col("s_base") + F.col("last")).over(outer)).select("file", "span", "s_base", "s_docs", "s_before")
    return blocks.join(spans, ["file", "span"]).select(
        "file", "block", "n", "found", "last", (F.col("s_base") + F.col("base")).alias("base"), (F.col("s_docs") + F.col("docs")).alias("docs"),
        F.coalesce(F.col("s_base") + F.col("before"), "s_before", none).alias("before"))


def count_tokens(blocks: DataFrame, separator: int = SEPARATOR, width: int = 2, span: int = SPAN_BLOCKS) -> DataFrame:
    """(file, nth, start, n_tokens) of each document in the files, without its separator."""
    found = staged(blocks.mapInArrow(_scan(separator, width), "file string, block long, n long, found long, last long, places binary"), "separators")
    scanned = staged(_prefixes(found.drop("places"), span), "prefixes")
    # The places wait where they are until the prefixes of their block are known.
    places = found.where("found > 0").select("file", "block", "places")
    whole = places.join(scanned.select("file", "block", "base", "docs", "before"), ["file", "block"]).select("file", "places", "base", "docs", "before").mapInArrow(
        _lengths, "file string, nth long, start long, n_tokens long")
    ends = scanned.groupBy("file").agg(F.sum("n").alias("n"), F.sum("found").alias("nth"), F.coalesce(F.max(F.col("base") + F.col("last")), F.lit(-1)).alias("last"))
    rest = ends.where("n - 1 > last").select("file", "nth", (F.col("last") + 1).alias("start"), (F.col("n") - F.col("last") - 1).alias("n_tokens"))
    return whole.union(rest)


def op2_token_counts(spark, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens) of every document, counted in token files made from ``documents``."""
    from sideline.llm.common import table

    blocks, names = token_blocks(table(spark, sf_dir, "documents"))
    return names.join(count_tokens(blocks), ["file", "nth"], "left").select("doc_id", "n_tokens")
