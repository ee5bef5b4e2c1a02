"""Near-duplicate vectors and exact top-k against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sideline.llm import product_quantisation, top_inner

SCHEMA = "vec_id long, embedding array<float>"
ODD = [(700, None), (701, [0.0] * 16), (702, [float("nan")] + [1.0] * 15), (703, [None] + [1.0] * 15), (704, [1.0] * 3), (707, []), (708, [float("inf")] + [0.0] * 15)]

# Vectors of further lengths, with links and queries of their own; one of them also fits the longer ones' beginning.
MINOR = [(800 + k, [float(k % 3 + 1), float(k % 2), 1.0]) for k in range(30)] + [(840, [1.0, 2.0]), (860, [2.0, 4.0]), (880, [5.0])]


def _near_brute(rows, cosine):
    usable = [i is not None and e is not None and all(v is not None and math.isfinite(v) for v in e) and any(e) for i, e in rows]
    x = np.array([np.pad(np.array(e, float) / np.linalg.norm(np.array(e, float)), (0, 16 - len(e))) if ok else np.zeros(16) for (_, e), ok in zip(rows, usable, strict=True)])
    size = np.array([len(e or ()) for _, e in rows])
    near = (x @ x.T >= cosine - 1e-12) & np.outer(usable, usable) & (size[:, None] == size[None, :])
    np.fill_diagonal(near, False)
    parent = {i: i for i, _ in rows}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in zip(*np.nonzero(near)):
        low, high = sorted((find(rows[a][0]), find(rows[b][0])))
        parent[high] = low
    return sorted(((i, int(near[k].sum()), find(i), find(i) == i) if usable[k] else (i, 0, i, True) for k, (i, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("block", [32, 1024])
def test_near_vectors(spark, monkeypatch, block):
    """Dense groups, copies, multiples, repeated ids and unusable vectors; small blocks split the lists."""
    monkeypatch.setattr(product_quantisation, "BLOCK", block)
    rng = np.random.default_rng(0)
    base = rng.normal(size=(20, 16))
    rows = [(i, [float(x) for x in (base[i % 20] + rng.normal(size=16) * 0.3 * (i % 4)).astype(np.float32)]) for i in range(400)]
    rows += [*ODD, *MINOR, (None, rows[0][1]), (705, rows[5][1]), (706, [2 * x for x in rows[5][1]]), (5, rows[5][1])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", rep string, c int")
    found = sorted((tuple(r) for r in product_quantisation.near_vectors(df).collect()), key=str)
    assert found == _near_brute(rows, 0.9)


def test_no_vectors(spark):
    assert product_quantisation.near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []
    only = product_quantisation.near_vectors(spark.createDataFrame([(1, None), (2, [0.0])], SCHEMA)).collect()
    assert sorted(tuple(r) for r in only) == [(1, 0, 1, True), (2, 0, 2, True)]
    assert top_inner.top_inner(spark.createDataFrame([], SCHEMA), F.lit(True)).collect() == []


def test_lookups_bound_the_distance_from_below():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 24))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x = np.concatenate([x, x[:300] + rng.normal(size=(300, 24)) * 0.04])
    x /= np.linalg.norm(x, axis=1)[:, None]
    q = product_quantisation.Quantiser(x[::2], 0.9)
    near, codes, missed = q.encode(x)
    probes = q.probes(x, near)
    for a, b in zip(*np.nonzero(np.triu(x @ x.T >= 0.9, 1))):
        a, b = (a, b) if near[a] <= near[b] else (b, a)
        assert probes[a, near[b]]
        assert q.candidates(x[a:a + 1], near[b], codes[b:b + 1], missed[b:b + 1])[0, 0]


def _side(q, kind, block, x):
    near, codes, missed = q.encode(product_quantisation._unit(x))
    at = np.argsort(near, kind="stable")
    reps = (1000 * block + at).astype(np.int64)
    columns = {"list": near[at].astype(np.int32), "rep": reps, "c": np.ones(len(x), np.int64), "v": x[at].astype(kind), "codes": codes[at], "missed": missed[at]}
    return product_quantisation._Side(q, kind, block, {c: v.tobytes() for c, v in columns.items()})


@pytest.mark.parametrize("kind", [np.float32, np.float64])
@pytest.mark.parametrize("dims", [1, 3, 24, 64])
def test_meetings_find_all_links(monkeypatch, dims, kind):
    """Two blocks, and each with itself: scattered vectors, tight groups, pairs about the threshold, all lengths."""
    monkeypatch.setattr(product_quantisation, "CHUNK", 16)
    rng = np.random.default_rng(dims)
    x = rng.normal(size=(700, dims))
    x[300:500] = x[:8].repeat(25, axis=0) + rng.normal(size=(200, dims)) * 0.02
    x[500:] = x[:200] / np.linalg.norm(x[:200], axis=1)[:, None] + rng.normal(size=(200, dims)) * 0.45 / np.sqrt(dims)
    x = (x * 10.0 ** rng.integers(-20, 20, size=(700, 1))).astype(kind)
    unit = product_quantisation._unit(x)
    q = product_quantisation.Quantiser(unit[::2], 0.9)
    sides = [_side(q, kind, 0, x[::2]), _side(q, kind, 1, x[1::2])]
    names = np.concatenate([np.arange(0, 350), np.arange(1000, 1350)])
    add, edges = dict.fromkeys(names.tolist(), 0), []
    for a, b in ((0, 0), (0, 1), (1, 1)):
        for rep, n, to in zip(*product_quantisation._Meeting(q, sides[a], sides[b]).run(), strict=True):
            add[int(rep)] += int(n)
            edges.append((int(rep), int(to)))
    unit = np.concatenate([unit[::2], unit[1::2]])
    near = unit @ unit.T >= 0.9
    assert [add[k] for k in names.tolist()] == (near.sum(axis=1) - 1).tolist()
    place = {k: i for i, k in enumerate(names.tolist())}
    pairs = np.array([(place[a], place[b]) for a, b in edges])
    assert product_quantisation.forest(*pairs.T, 700).tolist() == product_quantisation.forest(*np.nonzero(near), 700).tolist()


def _held(spark, at):
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


def test_near_vectors_write_little(spark):
    """Vectors whose lists all hold possible partners: what is written follows the vectors, not their probes."""
    from sideline.session import ensure_checkpoint_dir

    x = np.random.default_rng(4).normal(size=(3000, 64)).astype(np.float32)
    x[2000:2010] = x[:10] * 1.01 + np.float32(0.02)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], SCHEMA).repartition(2)
    at = ensure_checkpoint_dir(spark)
    before = _held(spark, at)
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in product_quantisation.near_vectors(df).collect()}
    assert _held(spark, at) - before < 4 * x.nbytes
    unit = x / np.linalg.norm(x.astype(float), axis=1)[:, None]
    assert [found[i][0] for i in range(3000)] == ((unit @ unit.T >= 0.9).sum(axis=1) - 1).tolist()
    assert all(found[2000 + i] == (1, i) for i in range(10))
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def _top_brute(rows, k):
    x = [(i, [math.floor(64 * float(v)) for v in e]) for i, e in rows if i is not None and e is not None and all(v is not None and math.isfinite(v) for v in e)]
    out = []
    for i, q in x:
        if i % 20 == 0:
            scores = [(max(-2**63, min(2**63 - 1, sum(a * b for a, b in zip(q, v, strict=True)))), j) for j, v in x if j != i and len(v) == len(q)]
            out += [(i, r, j, s) for r, (s, j) in enumerate(sorted(scores, key=lambda y: (-y[0], y[1]))[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("kind", ["equal lengths", "many lengths", "copies", "few rows", "huge"])
def test_top_inner(spark, monkeypatch, kind):
    """Ties go to smaller ids; unusable rows take no part; components beyond exact doubles are still exact."""
    monkeypatch.setattr(top_inner, "BUCKET", 50)
    monkeypatch.setattr(top_inner, "QUERIES", 7)
    rng = np.random.default_rng(2)
    rows = []
    for i in range(12 if kind == "few rows" else 400):
        v = rng.normal(size=16)
        v = v / np.linalg.norm(v) if kind == "equal lengths" else v * rng.exponential()
        rows.append((i, [0.3] * 16 if kind == "copies" and i % 3 == 0 else [float(x) for x in v.astype(np.float32)]))
    rows += [*ODD, *MINOR, (None, rows[0][1]), (720, rows[5][1])]
    if kind == "huge":
        rows += [(740, [1e30] + [0.0] * 15), (741, [3e37] + [0.0] * 15), (742, [1e9] * 16)]
    found = sorted(tuple(r) for r in top_inner.top_inner(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0).collect())
    wanted = [(i, [float(np.float32(v)) if v is not None else None for v in e] if e is not None else None) for i, e in rows]
    assert found == _top_brute(wanted, 20)


def test_pruning_keeps_what_scores():
    rng = np.random.default_rng(3)
    v = rng.normal(size=(500, 16)) * rng.exponential(size=(500, 1))
    lengths = np.linalg.norm(v, axis=1)
    order = np.argsort(-lengths)
    v, lengths = v[order], lengths[order]
    for _ in range(50):
        q = rng.normal(size=16)
        scores = v @ q
        for needed in np.quantile(scores, [0.5, 0.9, 0.99, 1.0]):
            keep = set(top_inner.prune(q, float(np.linalg.norm(q)), float(needed), v, lengths).tolist())
            assert set(np.flatnonzero(scores >= needed).tolist()) <= keep
