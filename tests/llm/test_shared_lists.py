"""Hard negatives against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sideline.llm import shared_lists as L

SCHEMA = "vec_id long, embedding array<float>, label int, score int, cluster string"


def _brute(rows):
    whole = [(i, lab, [math.floor(256 * float(np.float32(v))) for v in e]) for i, e, lab in rows
             if i is not None and lab is not None and e is not None and all(v is not None and math.isfinite(v) for v in e)]
    out = []
    for i, lab, q in whole:
        if i % 100:
            continue
        scores = [(max(-2**63, min(2**63 - 1, sum(a * b for a, b in zip(q, v, strict=True)))), j, lj) for j, lj, v in whole if j != i and len(v) == len(q)]
        best = sorted(scores, key=lambda y: (-y[0], y[1]))
        for ps, p, _ in [s for s in best if s[2] == lab][:5]:
            hard = [s for s in best if s[2] != lab and 30 * ps <= 100 * s[0] <= 90 * ps][:10]
            out += [(i, p, r, n, ps, ns) for r, (ns, n, _) in enumerate(hard, 1)]
    return sorted(out)


def _rows(kind):
    rng = np.random.default_rng(4)
    n = 40 if kind == "few rows" else 900
    heart = rng.normal(size=(12, 16))
    rows = []
    for k in range(n):
        v = rng.normal(size=16)
        if kind == "clustered":
            v = heart[k % 12] * rng.exponential() + 0.2 * v
        elif kind == "copies" and k % 3 == 0:
            v = np.full(16, 0.25)
        elif kind == "huge":
            v = v * 10.0 ** rng.integers(0, 9)
        rows.append((k, [float(x) for x in v.astype(np.float32)], int(rng.integers(0, 3)) if k % 10 else None if k % 20 else 1))
    odd = [(1000, None, 1), (1001, [float("nan")] + [1.0] * 15, 1), (1002, [None] + [1.0] * 15, 2), (1003, [float("inf")] + [0.0] * 15, 1), (None, rows[5][1], 1),
           (1100, [0.0] * 16, 1), (1104, [0.0] * 16, 1), (1105, [0.0] * 16, 2), (1200, [], 1), (1201, [], 1), (1202, [], 2)]
    odd += [(2000 + k, [float(x) for x in rng.normal(size=3)], k % 2) for k in range(200)]  # a length of its own
    return rows + odd


@pytest.mark.parametrize("kind", ["spread", "clustered", "copies", "few rows", "huge"])
def test_hard_negatives(spark, monkeypatch, kind):
    """Small clusters and blocks; ties go to smaller ids, every length is mined, unusable rows take no part."""
    monkeypatch.setattr(L, "MEMBERS", 3)
    monkeypatch.setattr(L, "BLOCK", 50)
    monkeypatch.setattr(L, "PAGE", 2)
    monkeypatch.setattr(L, "HEAD", 100)
    rows = _rows(kind)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    found = sorted(tuple(r) for r in L.hard_negatives(df, F.col("vec_id") % 100 == 0).collect())
    assert found == _brute(rows)


def test_repeated_rows(spark):
    """A repeated anchor is answered as often; a repeated candidate is returned as often."""
    rng = np.random.default_rng(6)
    rows = [(k, [float(x) for x in np.abs(rng.normal(size=4)).astype(np.float32)], k % 2) for k in range(12)]
    once = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    first = L.hard_negatives(once, F.col("vec_id") % 100 == 0, positives=1).collect()
    again = L.hard_negatives(once.union(once.where("vec_id = 0")), F.col("vec_id") % 100 == 0, positives=1).collect()
    assert sorted(map(tuple, again)) == sorted([*map(tuple, first), *map(tuple, first)])


def test_nothing(spark):
    assert L.hard_negatives(spark.createDataFrame([], SCHEMA), F.lit(True)).collect() == []
    assert L.hard_negatives(spark.createDataFrame([(1, [1.0], 1, 1, "x")], SCHEMA), F.lit(False)).collect() == []


def test_bounds_hold():
    rng = np.random.default_rng(7)
    a = rng.normal(size=(20, 8)) + 2
    length = np.linalg.norm(a, axis=1)
    unit = a / length[:, None]
    centre = unit.sum(axis=0) / np.linalg.norm(unit.sum(axis=0))
    radius = float(np.arccos(np.clip(unit @ centre, -1, 1)).max())
    v = rng.normal(size=(500, 8)) * rng.exponential(size=(500, 1))
    bound = L.bounds(centre, radius, v, np.linalg.norm(v, axis=1))
    assert ((a @ v.T) <= length[:, None] * bound[None, :] + 1e-9).all()
    assert (bound < np.linalg.norm(v, axis=1) * 0.99).any()
    assert L.window(100, 30, 90) == (30, 90) and L.window(7, 30, 90) == (3, 6) and L.window(-7, 30, 90) == (-2, -7) and L.window(0, 30, 90) == (0, 0)
