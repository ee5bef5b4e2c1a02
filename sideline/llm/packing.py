"""Best-fit packing of tokenised documents into fixed-length sequences.

Pattern packing: a pattern is a few piece lengths that fill a sequence
exactly.  How often each pattern is used comes from non-negative least
squares against the histogram of piece lengths; the repeat counts are rounded
down to what the histogram still holds, and the residual pieces are packed
best-fit decreasing, by counts of equal lengths.

Only the histogram reaches the driver: at most ``capacity`` numbers, however
many documents there are.  The plan that goes back has a few slots for each
length.  Pieces find their place by their rank among the pieces of their
length: each writing task numbers its own, and the tasks' counts are added up
by a window over (length, task), so no length, however frequent, meets in
one task.  Token ids are written once (with the task's numbers, so a
recomputed task cannot disagree) and never shuffled.

Defined results: a null text is empty, and an empty text is its separator
alone; a null ``doc_id`` is packed like any other; repeated rows are packed
once each; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sideline.llm.batches import parts, table_batch, tidy
from sideline.llm.common import staged
from sideline.llm.tokens import encoder

CAPACITY = 1024
SEPARATOR = 2
#: Documents cut at once inside a task.
ROWS = 1024


def _cut(capacity: int, separator: int, vocabulary: str | None):
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids_crc32", pa.int64()), ("ids", pa.binary()), ("task", pa.int32()), ("nth", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(vocabulary)
        end = np.array([separator], bpe.dtype).tobytes()
        seen = [0] * (capacity + 1)
        task = TaskContext.get().partitionId()
        for batch in parts(batches, ROWS):
            rows: list[list] = [[] for _ in range(7)]
            size = 0
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = np.frombuffer(bpe.encode(text.as_py() or "") + end, bpe.dtype)
                first = len(ids) % capacity or capacity
                edges = [0, *range(first, len(ids) + 1, capacity)]
                for piece, (a, b) in enumerate(zip(edges, edges[1:])):
                    part = ids[a:b]
                    for column, value in zip(rows, (doc_id, piece, a, b - a, zlib.crc32(part.astype("<u4").tobytes()), part.tobytes(), seen[b - a])):
                        column.append(value)
                    seen[b - a] += 1
                size += ids.nbytes
                if size > 1 << 21:
                    yield table_batch(schema, [*rows[:6], [task] * len(rows[0]), rows[6]])
                    rows, size = [[] for _ in range(7)], 0
            yield table_batch(schema, [*rows[:6], [task] * len(rows[0]), rows[6]])

    return tidy(cut)


def pieces(docs: DataFrame, capacity: int = CAPACITY, separator: int = SEPARATOR, vocabulary: str | None = None) -> DataFrame:
    """Documents as pieces of at most ``capacity`` ids, the separator last; only longer ones are cut, the first piece may be shorter.

    ``ids`` are the ids as little-endian bytes (two each for vocabularies of
    at most 65536 ids, else four), ``ids_crc32`` is of four bytes each;
    ``nth`` counts the pieces of equal length that ``task`` wrote before.
    """
    return staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _cut(capacity, separator, vocabulary),
        "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, task int, nth long"), "pieces")


def exact_patterns(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Rows of up to three of the given lengths (0: none) that fill ``capacity`` exactly."""
    have = np.zeros(capacity + 1, bool)
    have[lengths] = True
    out = [np.array([[x, 0, 0] for x in lengths if x == capacity], np.int64).reshape(-1, 3)]
    a = lengths[lengths * 2 <= capacity]
    two = a[have[capacity - a]]
    out.append(np.stack([two, capacity - two, 0 * two], axis=1))
    for x in lengths[lengths * 3 <= capacity]:
        y = a[(a >= x) & (capacity - x - a >= a)]
        y = y[have[capacity - x - y]]
        out.append(np.stack([np.full(len(y), x), y, capacity - x - y], axis=1))
    return np.concatenate(out)


def non_negative_least_squares(patterns: np.ndarray, histogram: np.ndarray, rounds: int = 300) -> np.ndarray:
    """x >= 0 that brings the lengths used by ``x`` times each pattern near the histogram (accelerated projected gradient)."""
    if not len(patterns):
        return np.zeros(0)
    on = patterns > 0
    flat, owner = patterns[on], np.nonzero(on)[0]
    size = len(histogram)

    def use(x):
        return np.bincount(flat, weights=x[owner], minlength=size)

    def back(r):
        return np.bincount(owner, weights=r[flat], minlength=len(patterns))

    v = np.ones(len(patterns))
    for _ in range(20):
        v = back(use(v))
        steep = np.linalg.norm(v)
        v /= steep
    x = y = np.zeros(len(patterns))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - back(use(y) - histogram) / steep)
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / nt * (new - x)
        x, t = new, nt
    return x


def best_fit_decreasing(histogram: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in one sequence, number of such sequences); equal sequences are handled by count."""
    room: dict[int, list[list]] = defaultdict(list)  # free space -> [lengths, count]
    for length in range(capacity, 0, -1):
        todo = int(histogram[length])
        while todo:
            space = next((s for s in range(length, capacity) if room.get(s)), None)
            if space is None:
                each = capacity // length
                full, rest = divmod(todo, each)
                if full:
                    room[capacity - each * length].append([(length,) * each, full])
                if rest:
                    room[capacity - rest * length].append([(length,) * rest, 1])
                break
            lengths, count = room[space].pop()
            k = min(count, todo)
            if count > k:
                room[space].append([lengths, count - k])
            room[space - length].append([lengths + (length,), k])
            todo -= k
    return [(lengths, count) for held in room.values() for lengths, count in held]


def plan(histogram: np.ndarray, capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns and their repeat counts that hold every piece of the histogram (index: length)."""
    left = histogram.astype(np.int64).copy()
    patterns = exact_patterns(np.flatnonzero(left), capacity)
    repeats = non_negative_least_squares(patterns, left.astype(float))
    out = []
    for k in np.argsort(-repeats, kind="stable"):
        if repeats[k] < 1:
            break
        used, times = np.unique(patterns[k][patterns[k] > 0], return_counts=True)
        count = int(min(np.floor(repeats[k] + 1e-6), (left[used] // times).min()))
        if count > 0:
            left[used] -= times * count
            out.append((tuple(int(x) for x in patterns[k] if x), count))
    return out + best_fit_decreasing(left, capacity)


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """length -> rows (first rank, first sequence, offset), by rank."""
    taken: dict[int, int] = defaultdict(int)
    out: dict[int, list] = defaultdict(list)
    sequence = 0
    for lengths, count in patterns:
        offset = 0
        for length in lengths:
            out[length].append((taken[length], sequence, offset))
            taken[length] += count
            offset += length
        sequence += count
    return {k: np.array(v, np.int64) for k, v in out.items()}


def _place(table: dict[int, np.ndarray]):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for k in np.unique(length):
                on = length == k
                at = np.searchsorted(table[k][:, 0], rank[on], "right") - 1
                sequence[on] = table[k][at, 1] + rank[on] - table[k][at, 0]
                offset[on] = table[k][at, 2]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    return tidy(place)


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of pieces as ``pieces`` made them."""
    # Counted twice from the pieces' table: two of its columns are read sooner than the counts are written.
    counts = cut.groupBy("length", "task").agg(F.count("*").alias("c"))
    histogram = np.zeros(capacity + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("c").alias("c")).collect():  # at most `capacity` rows
        histogram[row["length"]] = row["c"]
    before = F.sum("c").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    ranked = cut.drop("ids").join(counts.select("length", "task", F.coalesce(before, F.lit(0)).alias("before")), ["length", "task"])
    return (ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank"))
            .mapInArrow(_place(slots(plan(histogram, capacity))),
                        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"))


def op4_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """Contract query: all ``documents`` in sequences of at most 1024 ids."""
    from sideline.llm.common import table

    return pack(pieces(table(spark, sf_dir, "documents")))
