"""Arrow batches as byte buffers, shared by the text operators.

Tasks see a column of texts as one byte buffer plus offsets, so hashing and
searching run over whole groups of documents at once.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once inside a task (a longer single text is one group).
GROUP_BYTES = 1 << 19


def give_back() -> None:
    """Return freed memory to the system: a worker outlives its tasks, and what they freed would stay with it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidy(task: Callable) -> Callable:
    """A task over batches that returns freed memory before and after."""
    @functools.wraps(task)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        yield from task(batches)
        give_back()

    return run


def parts(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in slices, so that what a task unpacks at once stays small."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def as_binary(column: pa.Array) -> pa.Array:
    """A text column as UTF-8 bytes; null becomes empty."""
    if pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    elif pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    return column.fill_null(b"") if column.null_count else column


def buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a binary column; offsets count from 0."""
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.empty(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def groups(batch: pa.RecordBatch, text: int, limit: int = GROUP_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch with at most ``limit`` bytes of column ``text``, as (slice, bytes, offsets).

    A single text over the limit is a slice of its own: no text is cut.
    """
    column = as_binary(batch.column(text))
    data, offsets = buffer(column)
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), batch.num_rows)
        yield batch.slice(first, last - first), data[offsets[first]: offsets[last]], offsets[first: last + 1] - offsets[first]
        first = last


def table_batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    """A batch of arrays or lists cast to ``schema``."""
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) and c.type == f.type else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
