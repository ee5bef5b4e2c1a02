"""Removal of repeated byte strings over a sparse, range-partitioned suffix array.

A byte goes if it lies in a ``size``-byte string (200 by default) that also
starts anywhere else in the corpus, the same document included.  Suffixes are
the strings that start at each byte of a text and stay inside it.

Sorting every suffix of the corpus would move ``size`` times its bytes, so
the array is built only where an equal partner is possible, without loss:

1. Every string of ``size`` bytes has a leading token: the smallest hash of
   its ``TOKEN``-byte substrings.  Equal strings have equal leading tokens,
   and neighbouring strings mostly share theirs, so a text falls into runs of
   suffixes with one leading token at one place.  Runs whose token occurs in
   no other run hold no repeat.
2. Runs with the same whole content are repeats as a whole.
3. What is left are runs that share their token with others of different
   content: the ends of repeats.  Only their suffixes are sorted.  Spark
   samples splitters and range-partitions the runs by leading token (ties by
   content, so a token with a third of all rows is spread over many buckets).
   Each bucket sorts its suffixes locally by a multikey quicksort over
   ``NAME``-byte tokens, refining only runs of equal prefixes.  A token that
   touches a boundary of its bucket is compared across boundaries: its
   undecided suffixes go, ``BLOCK`` neighbours in a row, to an exchange on the
   bytes they have in common, and what meets rows of another bucket there
   goes on to one on the whole suffix.

Nothing is collected, no pairs are made, and every step is an equi-join or an
aggregate with partial aggregation.

Defined results: a null text is empty; a null ``doc_id`` is kept as a row of
its own; repeated rows are copies of each other (all of their bytes go if
they have ``size`` bytes); texts shorter than ``size`` stay whole; an empty
table gives an empty result; further columns travel in the struct ``row`` and
cannot clash with this operator's names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sideline.llm.batches import as_binary, buffer, groups, parts, table_batch, tidy
from sideline.llm.common import staged
from sideline.llm.hashing import Substrings

SIZE = 200
#: Bytes of a leading token.  Shorter tokens mean fewer runs, longer ones fewer accidental partners.
TOKEN = 48
#: Bytes of one token of the multikey quicksort.
NAME = 40
#: Neighbouring suffixes in one row of the exchange across boundaries.
BLOCK = 8
#: Suffixes, and bytes of text, sorted at once in a bucket; a token with more is compared across as if cut by a boundary.
#: A worker takes about 50 bytes for each byte sorted, so this bounds it whatever the runs are like.
SORT_ROWS, SORT_BYTES = 100_000, 2 << 20


def _sliding_min(h: np.ndarray, w: int) -> np.ndarray:
    """The minimum of every ``w`` neighbours, by prefix and suffix minima of blocks of ``w``."""
    n = len(h) - w + 1
    x = np.concatenate([h, np.full(-len(h) % w, ~np.uint64(0))]).reshape(-1, w)
    before = np.minimum.accumulate(x, axis=1).ravel()
    after = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[w - 1: w - 1 + n])


def runs(data: np.ndarray, offsets: np.ndarray, size: int, token: int) -> tuple[np.ndarray, ...]:
    """(text index, start, number of suffixes, leading token, content hash) of each run of a group of texts."""
    none = (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),) * 2
    if len(data) < size:
        return none
    hashes = Substrings(data)
    every = hashes.windows(token)
    lead = _sliding_min(every, size - token + 1)
    start = np.arange(len(lead))
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(lead)]
    inside = start + size <= offsets[text + 1]
    new = np.ones(len(lead), bool)
    # A run has one place of its token: it ends where the token changes or was at the start of a suffix.
    new[1:] = (lead[1:] != lead[:-1]) | (every[: len(lead) - 1] == lead[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new & inside)
    if not len(first):
        return none
    # A run ends where the next begins or its text has no further suffix.
    begins = np.flatnonzero(new)
    end = np.append(begins, len(lead))[np.searchsorted(begins, first, "right")]
    end = np.minimum(end, offsets[text[first] + 1] - size + 1)
    return text[first], first - offsets[text[first]], end - first, lead[first], hashes.of(first, end + size - 1)


def _scan(size: int, token: int, only_lead: bool):
    schema = pa.schema([("lead", pa.int64())] if only_lead else
                       [("doc_id", pa.int64()), ("key", pa.int64()), ("lead", pa.int64()), ("content", pa.int64()),
                        ("start", pa.int64()), ("n", pa.int32())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in groups(batch, batch.schema.get_field_index("text")):
                text, start, n, lead, content = runs(data, offsets, size, token)
                lead = pa.array(lead.view(np.int64))
                if only_lead:
                    yield pa.RecordBatch.from_arrays([lead], schema=schema)
                    continue
                at = pa.array(text)
                yield table_batch(schema, [part.column("doc_id").take(at), part.column("key").take(at), lead,
                                           pa.array(content.view(np.int64)), pa.array(start), pa.array(n.astype(np.int32))])

    return tidy(scan)


@tidy
def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compress the column ``text`` (to bytes) so that shuffles carry less."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    for batch in parts(batches):
        at = batch.schema.get_field_index("text")
        texts = as_binary(batch.column(at))
        packed = pa.array([squeeze(x.as_buffer()) for x in texts], pa.binary())
        columns = [packed if i == at else c for i, c in enumerate(batch.columns)]
        yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)


def unpack(column: pa.Array) -> list[bytes]:
    expand = zstandard.ZstdDecompressor().decompress
    return [expand(x.as_buffer()) if x.is_valid else b"" for x in column]


def _packed(texts: DataFrame) -> DataFrame:
    kinds = ", ".join(f"`{f.name}` {'binary' if f.name == 'text' else f.dataType.simpleString()}" for f in texts.schema)
    return texts.mapInArrow(pack, kinds)


def _chunks(size: int):
    schema = pa.schema([("lead", pa.int64()), ("content", pa.int64()), ("single", pa.bool_()), ("doc_id", pa.int64()),
                        ("key", pa.int64()), ("start", pa.int64()), ("chunk", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            for text, wanted, doc_id, key in zip(unpack(batch.column("text")), batch.column("wanted").to_pylist(),
                                                 batch.column("doc_id").to_pylist(), batch.column("key").to_pylist(), strict=True):
                yield pa.RecordBatch.from_pylist(
                    [{"lead": x["lead"], "content": x["content"], "single": x["single"], "doc_id": doc_id, "key": key,
                      "start": x["start"], "chunk": text[x["start"]: x["start"] + x["n"] + size - 1]} for x in wanted], schema=schema)

    return tidy(cut)


def multikey_groups(n: int, levels: int, token_at) -> np.ndarray:
    """For ``n`` rows of tokens: the number of the class of equal rows, -1 for a row without an equal.

    A multikey quicksort, a token position at a time: rows are sorted by
    (class so far, token), classes split where the token changes, and rows
    alone in their class leave.  ``token_at(level, rows)`` gives the tokens of
    the rows that are left.
    """
    out = np.full(n, -1, np.int64)
    rows = np.arange(n)
    group = np.zeros(n, np.int64)
    for level in range(levels):
        value = token_at(level, rows)
        order = np.lexsort((value, group))
        rows, group, value = rows[order], group[order], value[order]
        new = np.ones(len(rows), bool)
        new[1:] = (group[1:] != group[:-1]) | (value[1:] != value[:-1])
        group = np.cumsum(new) - 1
        many = np.bincount(group, minlength=1)[group] > 1 if len(rows) else np.empty(0, bool)
        rows, group = rows[many], group[many]
    out[rows] = group
    return out


_SUFFIX = np.dtype([("at", "<i4"), ("asks", "<i4"), ("f1", "<i8"), ("f2", "<i8")])


def _sort_bucket(size: int, name: int, token: int):
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("start", pa.int64()), ("n", pa.int64()),
                        ("c1", pa.int64()), ("c2", pa.int64()), ("bucket", pa.int64()), ("suffixes", pa.binary())])
    calls = [0]

    def decide(rows: list[dict], open_: bool) -> Iterator[pa.RecordBatch]:
        data, offsets = buffer(pa.array([r["chunk"] for r in rows], pa.binary()))
        hashes = Substrings(data)
        count = np.diff(offsets) - size + 1
        run = np.repeat(np.arange(len(rows)), count)
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        pos = offsets[run] + at
        ends = [min(k + name, size) for k in range(0, size, name)]
        group = multikey_groups(len(pos), len(ends), lambda level, on: hashes.of(pos[on] + level * name, pos[on] + ends[level]))
        single = np.array([r["single"] for r in rows])
        repeat = (group >= 0) & single[run]
        # Neighbouring repeats of a run are one row.
        edge = np.ones(len(run), bool)
        edge[1:] = (run[1:] != run[:-1]) | (repeat[1:] != repeat[:-1])
        first = np.flatnonzero(edge)
        length = np.diff(np.append(first, len(run)))
        first, length = first[repeat[first]], length[repeat[first]]
        start = np.array([r["start"] for r in rows], np.int64)
        ids = pa.array([r["doc_id"] for r in rows], pa.int64())
        keys = pa.array([r["key"] for r in rows], pa.int64())
        if len(first):
            who, nul = pa.array(run[first]), pa.nulls(len(first), pa.int64())
            yield table_batch(schema, [ids.take(who), keys.take(who), pa.array(start[run[first]] + at[first]), pa.array(length),
                                       nul, nul, nul, pa.nulls(len(first), pa.binary())])
        if not open_:
            return
        # Undecided suffixes, and one of each class of equals for their partners elsewhere.
        head = np.zeros(len(run), bool)
        seen = np.flatnonzero(group >= 0)
        head[seen[np.unique(group[seen], return_index=True)[1]]] = True
        out = np.flatnonzero((group < 0) | head)
        # Blocks count from the place of the leading token, so equal suffixes are in equal blocks.
        lead = np.array([r["lead"] for r in rows], np.int64)
        owner = np.repeat(np.arange(len(rows)), np.diff(offsets))
        places = hashes.windows(token)
        places = np.flatnonzero(places.view(np.int64) == lead[owner[: len(places)]])
        owner, where = np.unique(owner[places], return_index=True)
        place = places[where]
        distance = place[run[out]] - pos[out]
        block = distance // BLOCK
        new = np.ones(len(out), bool)
        new[1:] = (run[out][1:] != run[out][:-1]) | (block[1:] != block[:-1])
        begins = np.flatnonzero(new)
        common = place[run[out[begins]]] - block[begins] * BLOCK
        half = size // 2
        value = np.zeros(len(out), _SUFFIX)
        value["at"], value["asks"] = at[out], single[run[out]] & (group[out] < 0)
        value["f1"], value["f2"] = hashes.of(pos[out], pos[out] + half).view(np.int64), hashes.of(pos[out] + half, pos[out] + size).view(np.int64)
        raw, ends = value.tobytes(), np.append(begins, len(out)) * _SUFFIX.itemsize
        who = pa.array(run[out[begins]])
        calls[0] += 1
        tag = TaskContext.get().partitionId() << 32 | calls[0]
        yield table_batch(schema, [
            ids.take(who), keys.take(who), pa.array(start[run[out[begins]]]), pa.nulls(len(begins), pa.int64()),
            pa.array(hashes.of(common, common + half).view(np.int64)), pa.array(hashes.of(common + half, common + size - BLOCK + 1).view(np.int64)),
            pa.array(np.full(len(begins), tag)), pa.array([raw[x:y] for x, y in zip(ends[:-1], ends[1:], strict=True)], pa.binary())])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted by (lead, content); closed tokens are sorted together, as many as fit.
        ready: list[dict] = []
        ready_size = np.zeros(2, np.int64)
        group: list[dict] = []
        group_size = np.zeros(2, np.int64)
        most = np.array([SORT_ROWS, SORT_BYTES])
        cut = True  # the first token of a bucket may begin in the bucket before
        for batch in parts(batches):
            for row in batch.to_pylist():
                if group and row["lead"] != group[0]["lead"]:
                    if cut:
                        yield from decide(group, True)
                    else:
                        if ready and (ready_size + group_size > most).any():
                            yield from decide(ready, False)
                            ready, ready_size = [], np.zeros(2, np.int64)
                        ready += group
                        ready_size += group_size
                    group, group_size, cut = [], np.zeros(2, np.int64), False
                elif group and row["content"] == group[-1]["content"]:
                    continue  # the same run of a repeated row
                elif (group_size > most).any():
                    yield from decide(group, True)
                    group, group_size, cut = [], np.zeros(2, np.int64), True
                group.append(row)
                group_size += (len(row["chunk"]) - size + 1, len(row["chunk"]))
        if ready:
            yield from decide(ready, False)
        if group:
            yield from decide(group, True)  # may go on in the next bucket

    return tidy(sort)


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of blocks to rows of suffixes."""
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("start", pa.int64()), ("asks", pa.bool_()), ("f1", pa.int64()), ("f2", pa.int64())])
    for batch in batches:
        data, offsets = buffer(batch.column("suffixes"))
        value = np.frombuffer(data.tobytes(), _SUFFIX)
        who = np.repeat(np.arange(batch.num_rows), np.diff(offsets) // _SUFFIX.itemsize)
        take = pa.array(who)
        yield table_batch(schema, [batch.column("doc_id").take(take), batch.column("key").take(take), pa.array(batch.column("start").to_numpy()[who] + value["at"]),
                                   pa.array(value["asks"] > 0), pa.array(value["f1"]), pa.array(value["f2"])])


def repeated_ranges(texts: DataFrame, size: int = SIZE, token: int = TOKEN) -> DataFrame:
    """(doc_id, key, start, n): the suffixes start .. start + n - 1 of a text begin a repeated string.

    ``texts`` has doc_id, key (a hash of the text) and text.
    """
    scanned = lambda only: texts.mapInArrow(
        _scan(size, token, only),
        "lead long" if only else "doc_id long, key long, lead long, content long, start long, n int")
    shared = staged(scanned(True).groupBy("lead").agg(F.count("*").alias("c")).where("c > 1").select("lead"), "tokens")
    hits = staged(scanned(False).join(shared, "lead", "left_semi"), "runs")
    contents = staged(hits.groupBy("lead", "content").agg(
        F.count("*").alias("c"), F.min(F.struct("doc_id", "key", "start", "n")).alias("at")), "contents")
    mixed = contents.groupBy("lead").agg(F.min("c").alias("least"), F.count("*").alias("kinds")).where("least = 1 and kinds > 1").select("lead")
    wanted = (contents.join(mixed, "lead", "left_semi")
              .select(F.col("at.doc_id").alias("w_doc"), F.col("at.key").alias("w_key"),
                      F.struct("lead", "content", (F.col("c") == 1).alias("single"), F.col("at.start").alias("start"), F.col("at.n").alias("n")).alias("w"))
              .groupBy("w_doc", "w_key").agg(F.collect_list("w").alias("wanted")))
    found = _packed(texts).join(wanted, F.col("doc_id").eqNullSafe(F.col("w_doc")) & (F.col("key") == F.col("w_key")))
    chunks = staged(found.select("doc_id", "key", "text", "wanted").mapInArrow(
        _chunks(size), "lead long, content long, single boolean, doc_id long, key long, start long, chunk binary"), "suffixes")
    # repartitionByRange samples the splitters.
    sorted_ = staged(chunks.repartitionByRange("lead", "content").sortWithinPartitions("lead", "content").mapInArrow(
        _sort_bucket(size, NAME, token), "doc_id long, key long, start long, n long, c1 long, c2 long, bucket long, suffixes binary"), "sorted")
    blocks = sorted_.where("bucket is not null").drop("n")
    shared = blocks.groupBy("c1", "c2").agg(F.min("bucket").alias("x"), F.max("bucket").alias("y")).where("x <> y").select("c1", "c2")
    across = staged(blocks.join(shared, ["c1", "c2"], "left_semi").select("doc_id", "key", "start", "suffixes").mapInArrow(
        _suffixes, "doc_id long, key long, start long, asks boolean, f1 long, f2 long"), "across")
    twice = across.groupBy("f1", "f2").agg(F.count("*").alias("c")).where("c > 1").select("f1", "f2")
    late = across.where("asks").join(twice, ["f1", "f2"], "left_semi").select("doc_id", "key", "start", F.lit(1).cast("long").alias("n"))
    whole = hits.join(contents.where("c > 1").select("lead", "content"), ["lead", "content"], "left_semi").select(
        "doc_id", "key", "start", F.col("n").cast("long"))
    return whole.union(sorted_.where("bucket is null").select("doc_id", "key", "start", "n")).union(late)


def _apply(size: int, as_text: bool):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            sizes, removed, spans, kept = [], [], [], []
            for text, ranges in zip(unpack(batch.column("text")), batch.column("ranges"), strict=True):
                sizes.append(len(text))
                if not ranges.is_valid:
                    removed.append(0), spans.append(0), kept.append(text)
                    continue
                flat = ranges.values
                start = flat.field("start").to_numpy()
                end = start + flat.field("n").to_numpy() + size - 1
                edge = np.zeros(len(text) + 1, np.int64)
                np.add.at(edge, start, 1)
                np.add.at(edge, end, -1)
                gone = np.cumsum(edge[:-1]) > 0
                removed.append(int(gone.sum()))
                spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
                kept.append(np.frombuffer(text, np.uint8)[~gone].tobytes())
            names = ["doc_id", "row", "n_bytes", "n_removed", "n_spans", "kept"]
            columns = [batch.column("doc_id"), batch.column("row"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64())]
            if as_text:
                texts = [x.decode("utf-8", "ignore") for x in kept]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*names, "letters"])
            else:
                yield pa.RecordBatch.from_arrays([*columns, pa.array(kept, pa.binary())], names=names)

    return tidy(apply)


def remove_repeats(docs: DataFrame, size: int = SIZE, token: int = TOKEN, as_text: bool = False) -> DataFrame:
    """(doc_id, row, n_bytes, n_removed, n_spans, kept) for each row of ``docs``.

    ``row`` is a struct of all columns of ``docs``; but ``text`` is empty in
    it, its remaining bytes are ``kept``.  With ``as_text``, ``kept`` is a
    text without the rest of a letter that was cut, and ``letters`` its
    length; that is done where the bytes are, since another Python function
    behind this one would double the workers of an executor, for all later
    stages too.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), F.coalesce("text", F.lit("")).alias("text"),
                        F.struct(*others).alias("row"))
    found = (repeated_ranges(texts.select("doc_id", "key", "text"), size, token)
             .select(F.col("doc_id").alias("r_doc"), F.col("key").alias("r_key"), F.struct("start", "n").alias("r")).distinct()
             .groupBy("r_doc", "r_key").agg(F.collect_list("r").alias("ranges")))
    joined = _packed(texts).join(found, F.col("doc_id").eqNullSafe(F.col("r_doc")) & (F.col("key") == F.col("r_key")), "left")
    row = texts.schema["row"].dataType.simpleString()
    return joined.select("doc_id", "row", "text", "ranges").mapInArrow(
        _apply(size, as_text), f"doc_id long, row {row}, n_bytes long, n_removed long, n_spans long, kept {'string, letters long' if as_text else 'binary'}")


def op6_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract query: what is removed of each whole text of ``documents`` and the hash of the rest."""
    from sideline.llm.common import table

    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(texts: list[bytes], size: int = SIZE) -> list[tuple[int, int, int, str]]:
    """(n_bytes, n_removed, n_spans, kept_sha256) of each text by a dictionary of all strings; for small tests."""
    count: dict[bytes, int] = {}
    for t in texts:
        for i in range(len(t) - size + 1):
            count[t[i: i + size]] = count.get(t[i: i + size], 0) + 1
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - size + 1):
            if count[t[i: i + size]] > 1:
                gone[i: i + size] = b"\1" * size
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(t), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone, strict=True) if not g)).hexdigest()))
    return out
