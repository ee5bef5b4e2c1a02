"""Repeated byte strings against a dictionary of all strings."""

import hashlib
import random
import subprocess
import sys

import pytest

from conftest import ROOT
from sideline.llm import repeats

SCHEMA = "doc_id long, text string"


def _texts(seed, n=90):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdé") for _ in range(rnd.randint(2, 7))) for _ in range(50)]

    def prose(k):
        return " ".join(rnd.choice(vocabulary) for _ in range(k))

    shared = [prose(60) for _ in range(4)]
    rows = []
    for i in range(n):
        rows.append((i, [prose(90), prose(30) + shared[0] + prose(20), prose(10) + shared[1][20:] + prose(3) + shared[1][:250],
                         rows[rnd.randrange(len(rows))][1] if rows else "", "ab" * rnd.randint(50, 300), shared[2] + shared[3], None,
                         prose(2) * rnd.randint(1, 40)][i % 8]))
    return rows + [(None, prose(100)), (5, rows[5][1]), (None, shared[0])]


def _found(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in repeats.remove_repeats(df).collect()), key=str)


def _wanted(rows):
    return sorted(((d, *b) for (d, _), b in zip(rows, repeats.brute_force([(t or "").encode() for _, t in rows]), strict=True)), key=str)


@pytest.mark.parametrize(("sort_rows", "sort_bytes"), [(400_000, 1 << 30), (40, 1 << 30), (400_000, 1500)])
def test_matches_brute_force(spark, monkeypatch, sort_rows, sort_bytes):
    """Nulls, copies, overlaps, periodic texts and repeated rows; small buckets force the comparison across boundaries."""
    monkeypatch.setattr(repeats, "SORT_ROWS", sort_rows)
    monkeypatch.setattr(repeats, "SORT_BYTES", sort_bytes)
    rows = _texts(1)
    assert _found(spark.createDataFrame(rows, SCHEMA)) == _wanted(rows)


def test_empty_table_and_clashing_columns(spark):
    assert repeats.remove_repeats(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, "x" * 250, "a", 7), (2, "y", "b", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string, kept int")
    out = {r.doc_id: r for r in repeats.remove_repeats(df).collect()}
    assert (out[1].n_removed, out[1].row["row"], out[1].row["kept"]) == (250, "a", 7)
    assert (out[2].n_removed, bytes(out[2].kept), out[2].row["kept"]) == (0, b"y", None)


def test_long_text_is_whole(spark):
    """A repeat at the very end of a text longer than a group of bytes is found."""
    rnd = random.Random(5)
    noise = "".join(rnd.choice("abcdefghij") for _ in range(1_500_000))
    tail = "".join(rnd.choice("klmnop") for _ in range(200))
    out = {r.doc_id: r for r in repeats.remove_repeats(spark.createDataFrame([(1, noise + tail), (2, tail + "z")], SCHEMA)).collect()}
    assert (out[1].n_bytes, out[1].n_removed, out[2].n_removed) == (1_500_200, 200, 200)


def test_size_boundary(spark):
    """199 equal bytes are no repeat, 200 are."""
    a = "".join(chr(97 + (i * i) % 23) for i in range(199))
    out = {r.doc_id: r.n_removed for r in repeats.remove_repeats(spark.createDataFrame(
        [(1, "A" + a + "B"), (2, "C" + a + "D"), (3, "E" + a + "xF"), (4, "G" + a + "xH")], SCHEMA)).collect()}
    assert out == {1: 0, 2: 0, 3: 200, 4: 200}


def test_sorting_stays_within_its_memory():
    """A hot token of runs of one suffix each: a worker's memory follows SORT_BYTES, not the bucket."""
    code = """
import os, resource, numpy as np, pyarrow as pa
from sideline.llm import repeats
class Context:
    @staticmethod
    def get():
        return Context
    partitionId = staticmethod(lambda: 0)
repeats.TaskContext = Context
rng = np.random.default_rng(0)
token = rng.integers(97, 123, repeats.TOKEN, dtype=np.uint8)
lead = repeats.Substrings(token).of(np.array([0]), np.array([repeats.TOKEN])).view(np.int64)[0]
def batches():
    for k in range(40):
        n = 10_000
        text = rng.integers(97, 123, (n, 200), dtype=np.uint8)
        text[:, 60: 60 + repeats.TOKEN] = token
        yield pa.RecordBatch.from_arrays([pa.array(np.full(n, lead)), pa.array(np.arange(n) + k * n), pa.array([True] * n), pa.array(np.arange(n) + k * n),
            pa.array(np.zeros(n, np.int64)), pa.array(np.zeros(n, np.int64)), pa.array([x.tobytes() for x in text], pa.binary())],
            names=["lead", "content", "single", "doc_id", "key", "start", "chunk"])
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
rows = sum(b.num_rows for b in repeats._sort_bucket(repeats.SIZE, repeats.NAME, repeats.TOKEN)(batches()))
print(rows, (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=ROOT, check=True, timeout=300).stdout.split()
    assert int(out[1]) < 300
