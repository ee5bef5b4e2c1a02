"""Vectors in Arrow batches, shared by the vector operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

#: Up to here doubles hold every whole number, so sums below it are exact.
EXACT = 1 << 53


def matrix(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows x dims doubles, which rows are usable): null, of another length, or with null or non-finite components are not."""
    out = np.zeros((len(column), dims))
    lengths = np.array([-1 if n is None else n for n in pa.compute.list_value_length(column).to_pylist()], np.int64)
    ok = lengths == dims
    if ok.any():
        flat = column.filter(pa.array(ok)).flatten().cast(pa.float64())
        out[ok] = flat.fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(int(ok.sum()), dims)
    ok &= np.isfinite(out).all(axis=1)
    out[~ok] = 0
    return out, ok


def binaries(x: np.ndarray) -> pa.Array:
    """The rows of a matrix as byte strings."""
    x = np.ascontiguousarray(x)
    width = x.shape[1] * x.itemsize
    offsets = np.arange(len(x) + 1, dtype=np.int64) * width
    return pa.Array.from_buffers(pa.large_binary(), len(x), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(x.tobytes())]).cast(pa.binary())


def rows_of(column: pa.Array, dtype, dims: int) -> np.ndarray:
    """Byte strings back to a matrix."""
    return np.frombuffer(b"".join(x.as_buffer() for x in column), dtype).reshape(len(column), dims)


def integer_products(q: np.ndarray, v: np.ndarray, dims: int) -> np.ndarray:
    """Exact integer inner products of rows of whole numbers, cut to a long."""
    if dims * np.abs(q).max(initial=0) * np.abs(v).max(initial=0) < EXACT:
        return (q @ v.T).astype(np.int64)
    exact = np.array([[int(x) for x in row] for row in q], object) @ np.array([[int(x) for x in row] for row in v], object).T
    return np.clip(exact, -(1 << 63), (1 << 63) - 1).astype(np.int64)
