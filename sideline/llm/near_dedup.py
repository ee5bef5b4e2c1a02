"""Near-duplicate documents by SetSketch registers over word shingles.

A document is the set of its distinct word shingles (64-bit fingerprints).
Its sketch has ``bands * rows`` registers: every shingle emits an endless
series of exponentially spaced points, each falling on one register, and a
register keeps the smallest point it saw, rounded on an exponential scale.
Such minima merge under union, and two sets agree in a register with a
probability close to their Jaccard similarity.  Points beyond the value by
which all registers are taken are never made, so a sketch costs about
``m log m`` points, however long the text.

Bands of register values give the candidates: documents that agree in one
band.  With the defaults a pair at the threshold is missed by all bands with
a probability below 1e-6.  Candidates are estimated jointly: the likelihood
of the numbers of larger, smaller and equal registers, given both set sizes,
must not be e**13 times lower at the threshold than at its best.  What is
left is verified on the full sets.

No group is expanded into pairs:

* rows with the same set are one class, carried by its smallest id;
* in each band bucket all members are compared with one hub only.  What
  links to it is one component, and nothing more is asked of it;
* of buckets that still hold several components, members are settled without
  partners if too many of their shingles occur nowhere else in such buckets
  (a link shares at least the threshold's part of its shingles);
* the others meet the most central member of the bucket, and what even then
  is apart is compared exactly, member by member.

So components are those of all verified links, whatever the group sizes.

Defined results: null or empty texts have no shingles and link with nothing;
a null ``doc_id`` links with nothing and stays; rows that share a ``doc_id``
are one node; repeated rows share a component; an empty table gives an empty
result; ``row`` carries all further columns untouched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sideline.llm.batches import groups, parts, table_batch, tidy
from sideline.llm.common import connected_components, keep_one, staged
from sideline.llm.hashing import mix
from sideline.llm.repeats import _packed, unpack
from sideline.llm.words import shingle_sets

#: Defaults for near-duplicates on word shingles.
SHINGLE, PERCENT = 5, 80
#: Ratio of neighbouring values of the register scale.
BASE = 1.02
#: A pair is given up if its best likelihood beats that at the threshold by e to this power.
GIVE_UP = 13.0
_GOLD = np.uint64(0x9E3779B97F4A7C15)
#: Keys that the rows of one component are dealt over.
SALTS = 64


def band_shape(percent: int) -> tuple[int, int]:
    """(bands, rows): enough bands that a pair at the threshold is missed with a probability below 1e-6."""
    j = percent / 100
    rows = max(1, min(6, int(np.log(0.33) / np.log(j)) if j < 1 else 6))
    return int(np.ceil(np.log(1e-6) / np.log(1 - j**rows))) if j < 1 else 1, rows


def sketches(sets: np.ndarray, offsets: np.ndarray, m: int) -> np.ndarray:
    """Registers (texts x m, uint16) of each set; 0 for an empty set."""
    sizes = np.diff(offsets)
    low = np.full((len(sizes), m), np.inf)
    todo = np.flatnonzero(sizes)
    reach = np.zeros(len(sizes))
    reach[todo] = (np.log(m) + 6) / sizes[todo]
    while len(todo):
        owner = np.repeat(todo, sizes[todo])
        within = np.arange(len(owner)) - np.repeat(np.cumsum(sizes[todo]) - sizes[todo], sizes[todo])
        seed = sets[offsets[owner] + within]
        t, step = np.zeros(len(seed)), 0
        while len(seed):
            block = int(max(1, min(64, 65536 // len(seed))))
            h = mix(seed[:, None] + (np.arange(step, step + block, dtype=np.uint64) + np.uint64(1)) * _GOLD)
            gap = -np.log(((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / m
            gap[:, 0] += t
            point = np.cumsum(gap, axis=1)
            register = (mix(h ^ _GOLD) % np.uint64(m)).astype(np.int64)
            near = point <= reach[owner][:, None]
            which = np.nonzero(near)
            np.minimum.at(low.ravel(), owner[which[0]] * m + register[which], point[which])
            on = near[:, -1]
            seed, owner, t, step = seed[on], owner[on], point[on, -1], step + block
        todo = todo[np.isinf(low[todo]).any(axis=1)]
        reach[todo] *= 2
        low[todo] = np.inf
    with np.errstate(divide="ignore", invalid="ignore"):
        scale = np.floor(1 - np.log(low) / np.log(BASE)) + 32000
    return np.where(np.isfinite(low), np.clip(scale, 1, 65535), 0).astype(np.uint16)


def _scan(shingle: int, m: int):
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("n", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()),
                        ("sketch", pa.binary())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_one("sketches", m, object)  # drops what an earlier stage left in this worker
        for batch in batches:
            for part, data, offsets in groups(batch, batch.schema.get_field_index("text")):
                sets, ends = shingle_sets(data, offsets, shingle)
                n = np.diff(ends)
                registers = sketches(sets, ends, m)
                marks = [hashlib.blake2b(sets[a:b].tobytes(), digest_size=16).digest() for a, b in zip(ends[:-1], ends[1:], strict=True)]
                marks = np.frombuffer(b"".join(marks), np.int64).reshape(-1, 2)
                none = n == 0
                yield table_batch(schema, [part.column("doc_id"), part.column("key"), pa.array(n), pa.array(marks[:, 0], mask=none),
                                           pa.array(marks[:, 1], mask=none), pa.array([r.tobytes() for r in registers], pa.binary(), mask=none)])

    return tidy(scan)


def _bands(bands: int, rows: int):
    schema = pa.schema([("k", pa.int64()), ("rep", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reps, sketch = batch.column("rep").to_numpy(), batch.column("sketch")
            for first in range(0, len(reps), 2048):
                part = sketch.slice(first, 2048)
                value = np.frombuffer(b"".join(x.as_buffer() for x in part), np.uint16).reshape(len(part), bands, rows).astype(np.uint64)
                h = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), value.shape[:2])
                for k in range(rows):
                    h = mix(h * _GOLD + value[:, :, k])
                yield table_batch(schema, [pa.array(h.ravel().view(np.int64)), pa.array(np.repeat(reps[first: first + 2048], bands))])

    return tidy(cut)


def log_likelihood(j, u, larger, smaller, equal):
    """Of similarity ``j``, for sets whose sizes are ``u`` and ``1 - u`` of their sum."""
    def p(x):
        return -np.log1p(-np.clip(x, 1e-12, 1.0) * (BASE - 1) / BASE) / np.log(BASE)

    up, down = p(u - (1 - u) * j), p((1 - u) - u * j)
    return larger * np.log(up) + smaller * np.log(down) + equal * np.log(np.clip(1 - up - down, 1e-12, 1.0))


def plausible(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of sketches may reach the threshold, by set sizes and by the joint likelihood."""
    u = nx / (nx + ny)
    larger, smaller, equal = (x > y).sum(axis=1), (x < y).sum(axis=1), (x == y).sum(axis=1)
    most = np.minimum(nx, ny) / np.maximum(nx, ny)
    at = log_likelihood(np.minimum(percent / 100, most), u, larger, smaller, equal)
    best, above = np.full(len(u), -np.inf), np.zeros(len(u), bool)
    for part in np.linspace(0, 1, 101):
        value = log_likelihood(part * most, u, larger, smaller, equal)
        above = np.where(value > best, part * most >= percent / 100, above)
        best = np.maximum(best, value)
    return (100 * np.minimum(nx, ny) >= percent * np.maximum(nx, ny)) & (above | (best - at <= GIVE_UP))


def _estimate(percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 4096):
                part = batch.slice(first, 4096)
                x, y = (np.frombuffer(b"".join(v.as_buffer() for v in part.column(c)), np.uint16).reshape(part.num_rows, -1) for c in ("sa", "sb"))
                keep = plausible(x, y, part.column("na").to_numpy().astype(float), part.column("nb").to_numpy().astype(float), percent)
                yield table_batch(schema, [part.column(c).filter(pa.array(keep)) for c in ("a", "b")])

    return tidy(estimate)


def _verify(percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            keep = []
            for x, y in zip(batch.column("sa"), batch.column("sb"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield table_batch(schema, [batch.column(c).filter(pa.array(keep, pa.bool_())) for c in ("a", "b")])

    return tidy(verify)


def _sets(shingle: int):
    schema = pa.schema([("rep", pa.int64()), ("n", pa.int64()), ("s", pa.binary())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            whole = pa.RecordBatch.from_arrays([batch.column("rep"), pa.array(unpack(batch.column("text")), pa.binary())], names=["rep", "text"])
            for part, data, offsets in groups(whole, 1):
                sets, ends = shingle_sets(data, offsets, shingle)
                yield table_batch(schema, [part.column("rep"), pa.array(np.diff(ends)),
                                           pa.array([sets[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())])

    return tidy(scan)


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("h", pa.int64()), ("rep", pa.int64())])
    for batch in batches:
        for rep, s in zip(batch.column("rep").to_pylist(), batch.column("s"), strict=True):
            h = np.frombuffer(s.as_buffer(), np.int64)
            yield table_batch(schema, [pa.array(h), pa.array(np.full(len(h), rep, np.int64))])


def _pairs_with(pairs: DataFrame, side: DataFrame, value: str) -> DataFrame:
    """(a, b, na, nb, sa, sb): both sides' sizes and ``value``; plain joins, so AQE splits hot hubs."""
    b = side.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col(value).alias("sb"))
    a = side.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col(value).alias("sa"))
    return pairs.join(b, "b").join(a, "a").select("a", "b", "na", "nb", "sa", "sb")


@tidy
def _beyond(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many shingles of a member its hub has, and the others."""
    schema = pa.schema([("hub", pa.int64()), ("rep", pa.int64()), ("n", pa.int64()), ("both", pa.int64()), ("others", pa.list_(pa.int64()))])
    for batch in parts(batches):
        both, others = [], []
        for x, y in zip(batch.column("sb"), batch.column("sa"), strict=True):
            x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            inside = y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x
            both.append(int(inside.sum()))
            others.append(x[~inside].view(np.int64))
        yield table_batch(schema, [batch.column("a"), batch.column("b"), batch.column("nb"), both, pa.array(others, pa.list_(pa.int64()))])


def _residual(rest: DataFrame, sets: DataFrame, share: DataFrame, percent: int) -> DataFrame:
    """(a, b): the pairs of different components of a bucket that may still reach the threshold.

    ``a`` is not of its hub's component.  Two members either share a shingle
    that the hub has not, and meet through that shingle, or all they share is
    the hub's too; then it is at most what either shares with the hub, which
    for ``a`` is below the threshold's need unless ``b`` is much smaller.  No
    shingle that only one of them has counts in either case.
    """
    near = _pairs_with(rest.select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct(), sets, "s")
    beyond = staged(near.mapInArrow(_beyond, "hub long, rep long, n long, both long, others array<long>")
                    .join(share.select("rep", (F.col("n") - F.col("own")).alias("open")), "rep"), "beyond")
    member = rest.select("hub", "rep", "comp", (F.col("comp") != F.col("main")).alias("minor")).distinct()
    shingle = beyond.select("hub", "rep", F.explode("others").alias("h"))
    often = shingle.groupBy("hub", "h").agg(F.count("*").alias("c")).where("c > 1").select("hub", "h")
    shared = staged(shingle.join(often, ["hub", "h"], "left_semi").groupBy("hub", "rep").agg(F.collect_list("h").alias("hs")), "shared")
    index = staged(shared.join(beyond.drop("others"), ["hub", "rep"]).join(member, ["hub", "rep"]).withColumn("h", F.explode("hs")), "index")
    rows = staged(rest.select("k", "hub", "rep", "comp", (F.col("comp") != F.col("main")).alias("minor"))
                  .join(beyond.drop("others"), ["hub", "rep"]), "rest")

    def sides(df: DataFrame, keys: list[str], most: str, once: str = "true") -> DataFrame:
        columns = [c for c in df.columns if c not in keys]
        x = df.where("minor").select(*keys, *(F.col(c).alias(f"{c}_a") for c in columns))
        y = df.select(*keys, *(F.col(c).alias(f"{c}_b") for c in columns))
        return (x.join(y, keys).where("comp_a <> comp_b").where(once).where(F.expr(f"100 * {most} >= {int(percent)} * (n_a + n_b - {most})"))
                .select(F.least("rep_a", "rep_b").alias("a"), F.greatest("rep_a", "rep_b").alias("b")))

    # What two members share beyond the hub is known here; each pair is made at the first such shingle only.
    through = sides(index, ["hub", "h"], "least(open_a, open_b, least(both_a, both_b) + size(array_intersect(hs_a, hs_b)))",
                    "h = array_min(array_intersect(hs_a, hs_b))")
    inside = sides(rows.drop("hub"), ["k"], "least(both_a, both_b, open_a, open_b)")
    return through.union(inside)


def shingle_classes(docs: DataFrame, shingle: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(scan, classes): scan has doc_id, key, n, f1, f2 of each row; classes has f1, f2, rep, component."""
    bands, rows = band_shape(percent)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), "text")
    scan = staged(texts.mapInArrow(_scan(shingle, bands * rows), "doc_id long, key long, n long, f1 long, f2 long, sketch binary"), "sketches")
    reps = staged(scan.where("n > 0 and doc_id is not null").groupBy("f1", "f2")
                  .agg(F.min(F.struct("doc_id", "key", "n", "sketch")).alias("x"))
                  .select("f1", "f2", F.col("x.doc_id").alias("rep"), "x.key", "x.n", "x.sketch"), "classes")
    banded = reps.select("rep", "sketch").mapInArrow(_bands(bands, rows), "k long, rep long")
    buckets = staged(banded.groupBy("k").agg(F.count("*").alias("c"), F.min("rep").alias("hub")).where("c > 1").select("k", "hub"), "buckets")
    members = staged(banded.join(buckets, "k"), "members")
    wanted = members.select("rep").distinct().join(reps.select("rep", F.col("key").alias("r_key")), "rep")
    found = _packed(texts.where("doc_id is not null")).join(wanted, (F.col("doc_id") == F.col("rep")) & (F.col("key") == F.col("r_key")))
    sets = staged(found.select("rep", "text").mapInArrow(_sets(shingle), "rep long, n long, s binary"), "sets")

    def links(pairs: DataFrame) -> DataFrame:
        pairs = pairs.where("a <> b").distinct()
        likely = _pairs_with(pairs, reps, "sketch").mapInArrow(_estimate(percent), "a long, b long")
        return staged(_pairs_with(likely, sets, "s").mapInArrow(_verify(percent), "a long, b long").distinct(), "links")

    def apart(rows_: DataFrame, linked: DataFrame) -> DataFrame:
        """Bucket rows (k, rep, hub) with their and their hub's component, of the buckets that hold several."""
        comp = connected_components(linked)
        mine, hubs = comp.toDF("rep", "c"), comp.toDF("hub", "h")
        known = staged(rows_.join(mine, "rep", "left").join(hubs, "hub", "left")
                       .select("k", "rep", "hub", F.coalesce("c", "rep").alias("comp"), F.coalesce("h", "hub").alias("main")), "known")
        several = known.groupBy("k").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("k")
        return staged(known.join(several, "k", "left_semi"), "apart")

    all_links = links(members.select(F.col("hub").alias("a"), F.col("rep").alias("b")))
    alive = apart(members, all_links)
    if alive.limit(1).count():
        # Settle members too many of whose shingles nobody else in open buckets has; twice, as settling frees shingles.
        for _ in range(2):
            own = sets.join(alive.select("rep").distinct(), "rep", "left_semi")
            lonely = (own.mapInArrow(_shingles, "h long, rep long").groupBy("h").agg(F.count("*").alias("c"), F.min("rep").alias("rep"))
                      .where("c = 1").groupBy("rep").agg(F.count("*").alias("own")))
            share = staged(own.select("rep", "n").distinct().join(lonely, "rep", "left").select("rep", "n", F.coalesce("own", F.lit(0)).alias("own"))
                           .where(F.col("own") * 100 <= F.col("n") * (100 - percent)), "share")
            alive = staged(alive.join(share.select("rep"), "rep", "left_semi"), "alive")
        # The most central member of each component: the fewest shingles of its own, the largest of equals.
        middle = (alive.select("rep", "comp").distinct().join(share, "rep").groupBy("comp")
                  .agg(F.min(F.struct((F.col("own") / F.col("n")).alias("alone"), (-F.col("n")).alias("size"), "rep")).alias("c"))
                  .select(F.col("comp").alias("main"), F.col("c.rep").alias("mid")))
        main = alive.groupBy("k").agg(F.coalesce(F.max(F.when(F.col("comp") == F.col("main"), F.col("comp"))), F.min("comp")).alias("main"))
        # A component may hold most rows: each is dealt over SALTS keys, and its one middle is there for all of them.
        middles = middle.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = alive.select("k", "rep", "comp").join(main, "k").withColumn("salt", F.pmod(F.xxhash64("k", "rep"), F.lit(SALTS)).cast("int"))
        met = staged(met.join(middles, ["main", "salt"]).drop("salt"), "met")
        all_links = all_links.union(links(met.where("comp <> main").select(F.col("mid").alias("a"), F.col("rep").alias("b"))))
        rest = apart(met.select("k", "rep", F.col("mid").alias("hub")), all_links)
        if rest.limit(1).count():
            all_links = all_links.union(links(_residual(rest, sets, share, percent)))
    comp = connected_components(all_links).withColumnRenamed("node", "rep")
    classes = reps.select("f1", "f2", "rep").join(comp, "rep", "left").select("f1", "f2", F.coalesce("component", "rep").alias("component"))
    return scan.drop("sketch"), classes


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, key, n_shingles, component_id, kept) of each row of ``docs``; ``key`` is xxhash64 of the text."""
    scan, classes = shingle_classes(docs, shingle, percent)
    out = scan.join(classes, ["f1", "f2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "key", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      component.eqNullSafe(F.col("doc_id")).alias("kept"))


def op7_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract query: 3-word shingles, similarity 0.85, all of ``documents``."""
    from sideline.llm.common import table

    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), 3, 85).select("doc_id", "n_shingles", "component_id", "kept")


def brute_force(rows: list[tuple], shingle: int, percent: int) -> list[tuple]:
    """(doc_id, n_shingles, component_id, kept) by all pairs; for small tests."""
    import re

    lower = {i: i + 32 for i in range(65, 91)}
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(lower))
        sets.append({tuple(w[i: i + shingle]) for i in range(len(w) - shingle + 1)} if len(w) >= shingle else ({tuple(w)} if w else set()))
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, _) in enumerate(rows):
        for j in range(i):
            b = rows[j][0]
            if a is None or b is None or not sets[i] or not sets[j]:
                continue
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return [(i, len(s), None if i is None else find(i), i is None or find(i) == i) for (i, _), s in zip(rows, sets, strict=True)]
