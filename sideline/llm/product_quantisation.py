"""Near-duplicate vectors by an inverted file with product-quantised residuals.

* Coarse centroids and the codebooks of the residuals' subspaces are trained on
  a bounded sample (``SAMPLE`` vectors, by a hash of the id); every vector is
  indexed: its nearest centroid is its list, its residual is a code for each
  subspace, and the length of what the code misses is kept.  The number of
  lists follows the number of vectors.
* The index is written once, as blocks of neighbouring lists.  Two blocks meet
  where a vector of one probes a list of the other: one within the threshold's
  distance cannot be further across the plane between two centroids, so the
  other lists are left out without loss.  Blocks are read where they meet;
  nothing is copied for each probe.
* Two lists are first compared by what both sides lie off that plane, then by a
  few coordinates: the leading ones of the sample, those along both centroids,
  and the length of all the others, whose product bounds the cosine from above.
* For what is left, asymmetric distances come from one lookup table for each
  query and subspace.  Less the kept length they bound the true distance from
  below, so what they rule out is no partner; the rest is reranked by exact
  cosine.  Where most pairs of two lists are left, whole products decide, and
  only those within their rounding are reranked.

So no link is lost to the index: recall is 1 up to rounding of doubles.

Equal vectors are one class with a count.  Two blocks meet in one task, which
returns for each vector the number of partners and a spanning forest of the
links: rows grow with the vectors in a block, never with their pairs.

Defined results: vectors that are null, empty, zero, or hold null or
non-finite components link with nothing, and neither does a row whose
``vec_id`` is null; vectors of different lengths link with nothing of each
other; those are their own component and kept; equal rows
are partners of each other; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from sideline.llm.batches import table_batch, tidy
from sideline.llm.common import connected_components, staged
from sideline.llm.vectors import binaries, matrix, rows_of

#: Vectors the quantisers are trained on, at most; centroids at most, subspaces, and codes for each.
SAMPLE, LISTS, SUBSPACES, CODES = 16_384, 2048, 8, 32
#: Vectors that a list is made for; vectors and bytes of a block, at most; blocks aimed at, so that few vectors are dealt out as well.
LIST, BLOCK, BLOCK_BYTES, BLOCKS = 1024, 16_384, 4 << 20, 24
#: Bytes of blocks that a task reads of either side.
READ = 32 << 20
#: Numbers of leading coordinates that two lists may be compared by; vectors compared at once.
LEADS, CHUNK = (4, 8, 12, 16, 20, 24, 32, 48, 64, 96, 128, 192, 256), 128
#: Part of the pairs from which whole products are cheaper than lookups; pairs held until they are looked up.
DENSE, PAIRS = 0.05, 1 << 19
_SLACK = 1e-6
#: The least that bounds in single precision are loosened by.
_LOOSE = 1e-4
#: Steps of length 1 that vectors are sorted by.
_STEPS = 1 << 13


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum(0, (x * x).sum(axis=1)[:, None] - 2 * x @ c.T + (c * c).sum(axis=1))


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The nearest row of ``c`` for each row of ``x``."""
    step = max(1, (1 << 20) // len(c))
    return np.concatenate([np.empty(0, np.int64), *(_squares(x[k: k + step], c).argmin(axis=1) for k in range(0, len(x), step))])


def kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centroids of Lloyd's algorithm from evenly spaced rows; at most one for each row."""
    c = x[np.unique(np.linspace(0, len(x) - 1, min(k, len(x))).astype(int))].copy()
    for _ in range(rounds):
        near = _nearest(x, c)
        count = np.bincount(near, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c[count > 0] = total[count > 0] / count[count > 0, None]
    return c


class Quantiser:
    """Coarse centroids and codebooks; ``r`` is the distance of unit vectors at the threshold."""

    def __init__(self, sample: np.ndarray, cosine: float, lists: int = LISTS):
        self.dims = sample.shape[1]
        self.r = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
        self.cosine = cosine
        #: What bounds in single precision may be off.
        self.loose = _LOOSE + self.dims * 2.4e-7
        self.coarse = kmeans(sample, min(lists, max(1, len(sample) // 8)))
        near = _nearest(sample, self.coarse)
        #: Part of the sample in each list.
        self.share = (np.bincount(near, minlength=len(self.coarse)) + 0.5) / (len(sample) + 0.5 * len(self.coarse))
        rest = sample - self.coarse[near]
        self.parts = np.array_split(np.arange(self.dims), min(SUBSPACES, self.dims))
        self.books = [kmeans(rest[:, p], CODES) for p in self.parts]
        #: Orthonormal directions in which the sample reaches furthest: as many as make comparing cheapest.
        self.lead = self.leading(sample)

    def leading(self, sample: np.ndarray) -> np.ndarray:
        """Directions by which few pairs of the sample that are no partners stay possible, weighed by what coordinates and pairs cost."""
        turned = np.linalg.eigh(sample.T @ sample)[1][:, ::-1]
        a, b = (sample[k: k + 1024: 2] @ turned for k in (0, 1))
        others = a @ b.T < self.cosine
        best, least = 1, np.inf
        for m in (k for k in LEADS if k <= self.dims):
            rest = [np.sqrt((x[:, m:] ** 2).sum(axis=1)) for x in (a, b)]
            left = float((others & (a[:, :m] @ b[:, :m].T + np.outer(*rest) >= self.cosine)).sum() / max(1, others.sum()))
            cost = 25 + m + (5000 * left if left < DENSE else 2.5 * self.dims)
            if cost < least:
                best, least = m, cost
        return turned[:, :best]

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("apart", "ahead", "aside")}

    @cached_property
    def apart(self) -> np.ndarray:
        """Distances of the centroids."""
        return np.sqrt(_squares(self.coarse, self.coarse))

    @cached_property
    def ahead(self) -> np.ndarray:
        """The centroids' leading coordinates."""
        return self.coarse @ self.lead

    @cached_property
    def aside(self) -> tuple[np.ndarray, np.ndarray]:
        """Unit directions of the centroids beyond their leading coordinates, and what to divide by for them; 0 and 1 if hardly anything is there."""
        rest = self.coarse - self.ahead @ self.lead.T
        size = np.sqrt((rest * rest).sum(axis=1))
        some = size > 0.05
        return np.where(some, 1, 0)[:, None] * rest / np.where(some, size, 1)[:, None], np.where(some, size, np.inf)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(list, codes, missed length) of unit vectors."""
        near = _nearest(x, self.coarse)
        rest = x - self.coarse[near]
        codes = np.stack([_squares(rest[:, p], b).argmin(axis=1) for p, b in zip(self.parts, self.books, strict=True)], axis=1)
        return near, codes.astype(np.uint8), np.sqrt(((rest - self.decode(codes)) ** 2).sum(axis=1))

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """The residuals that codes stand for."""
        return np.concatenate([b[codes[:, m]] for m, b in enumerate(self.books)], axis=1)

    def probes(self, x: np.ndarray, near: np.ndarray) -> np.ndarray:
        """Rows x lists: which lists from its own on can hold a partner within ``r``; each pair of lists is probed from the first."""
        d = _squares(x, self.coarse)
        own = d[np.arange(len(x)), near]
        across = self.apart[near]
        ok = (d - own[:, None]) <= 2 * across * (self.r + _SLACK)
        return ok & (np.arange(len(self.coarse)) >= near[:, None])

    def tables(self, x: np.ndarray) -> list[np.ndarray]:
        """For each subspace, products of the rows with all its codes."""
        return [x[:, p] @ book.T.astype(x.dtype) for p, book in zip(self.parts, self.books, strict=True)]

    def reachable(self, ahead: np.ndarray, length: np.ndarray, missed: np.ndarray) -> np.ndarray:
        """Whether the distance is not ruled out; from products of queries with what members' codes stand for, and the squared lengths of that."""
        return 1 + length - 2 * ahead <= (self.r + missed + _SLACK) ** 2 + self.loose

    def candidates(self, queries: np.ndarray, at: int, codes: np.ndarray, missed: np.ndarray) -> np.ndarray:
        """Queries x members of list ``at`` whose distance is not ruled out by the table lookups."""
        ahead = (queries @ self.coarse[at])[:, None] + sum(t[:, codes[:, m]] for m, t in enumerate(self.tables(queries)))
        return self.reachable(ahead, ((self.coarse[at] + self.decode(codes)) ** 2).sum(axis=1), missed)


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; all must be finite and not zero."""
    x = x.astype(np.float64)
    x /= np.abs(x).max(axis=1, initial=0)[:, None]
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    return x


def _normal(dims: int, kind):
    schema = pa.schema([("vec_id", pa.int64()), ("v", pa.binary()), ("unit", pa.binary())])

    def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, ok = matrix(batch.column("embedding"), dims)
            ok &= (x != 0).any(axis=1) & batch.column("vec_id").is_valid().to_numpy(zero_copy_only=False)
            where = np.full(batch.num_rows, -1)
            where[ok] = np.arange(int(ok.sum()))
            where = pa.array(where, mask=where < 0)
            yield table_batch(schema, [batch.column("vec_id"), binaries(x[ok].astype(kind)).take(where), binaries(_unit(x[ok])).take(where)])

    return normal


def _index(q: Quantiser, kind, first_of: np.ndarray, wide: np.ndarray):
    """Lists and codes; ``bin`` is where a vector's block is cut from: list by list, within a list by a hash."""
    schema = pa.schema([("bin", pa.int64()), ("list", pa.int32()), ("rep", pa.int64()), ("c", pa.int64()), ("v", pa.binary()), ("codes", pa.binary()), ("missed", pa.float64())])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 4096):
                part = batch.slice(first, 4096)
                near, codes, missed = q.encode(_unit(rows_of(part.column("v"), kind, q.dims)))
                within = part.column("h1").to_numpy().view(np.uint64) / 2.0**64
                at = np.floor(first_of[near] + within * wide[near]).astype(np.int64)
                yield table_batch(schema, [pa.array(at), pa.array(near.astype(np.int32)), part.column("rep"), part.column("c"), part.column("v"), binaries(codes), pa.array(missed)])

    return tidy(index)


_BLOCK = "block long, lists array<int>, probes array<int>, list binary, rep binary, c binary, v binary, codes binary, missed binary"


def _pack(q: Quantiser, kind, size: int):
    """The rows of each bin, which come sorted, as blocks of about ``size`` vectors."""
    schema = pa.schema([("block", pa.int64()), ("lists", pa.list_(pa.int32())), ("probes", pa.list_(pa.int32())),
                        *((c, pa.binary()) for c in ("list", "rep", "c", "v", "codes", "missed"))])

    def block(rows: pa.Table, at: int, k: int) -> pa.RecordBatch:
        rows = rows.combine_chunks().sort_by([("list", "ascending"), ("rep", "ascending")])
        near = rows.column("list").to_numpy()
        v = b"".join(x.as_buffer() for x in rows.column("v"))
        x = _unit(np.frombuffer(v, kind).reshape(len(near), q.dims))
        step = max(1, (1 << 20) // len(q.coarse))
        probed = np.any([q.probes(x[f: f + step], near[f: f + step]).any(axis=0) for f in range(0, len(x), step)], axis=0)
        return table_batch(schema, [[at << 20 | k], [np.unique(near)], [np.flatnonzero(probed).astype(np.int32)], [near.tobytes()], [rows.column("rep").to_numpy().tobytes()],
                                    [rows.column("c").to_numpy().tobytes()], [v], [b"".join(y.as_buffer() for y in rows.column("codes"))], [rows.column("missed").to_numpy().tobytes()]])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n, at, k = 0, None, 0
        for batch in batches:
            bins = batch.column("bin").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(bins)) + 1).tolist(), len(bins)]
            for f, t in zip(cuts[:-1], cuts[1:], strict=True):
                if t == f:
                    continue
                if bins[f] != at:
                    if n:
                        yield block(pa.Table.from_batches(held), at, k)
                    held, n, at, k = [], 0, int(bins[f]), 0
                held.append(batch.slice(f, t - f))
                n += t - f
                while n >= 2 * size:  # a list that the sample showed too small
                    rows = pa.Table.from_batches(held)
                    yield block(rows.slice(0, size), at, k)
                    held, n, k = rows.slice(size).to_batches(), n - size, k + 1
        if n:
            yield block(pa.Table.from_batches(held), at, k)

    return tidy(pack)


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest reachable node of each of ``n`` nodes, by repeated minima over the links a-b."""
    low = np.arange(n)
    while True:
        was = low.copy()
        least = np.minimum(low[a], low[b])
        np.minimum.at(low, a, least)
        np.minimum.at(low, b, least)
        low = low[low]
        if (low == was).all():
            return low


class _Side:
    """A block in memory, with what all its meetings need."""

    def __init__(self, q: Quantiser, kind, block: int, row: dict):
        self.block, self.q = block, q
        # Copies, as the batch that they come from is large.
        self.list, self.rep, self.c, self.missed, codes = (
            np.frombuffer(row[name], t).copy() for name, t in (("list", np.int32), ("rep", np.int64), ("c", np.int64), ("missed", np.float64), ("codes", np.uint8)))
        self.codes = codes.reshape(len(self.list), len(q.parts))
        self.x = _unit(np.frombuffer(row["v"], kind).reshape(len(self.list), q.dims))
        self.short = self.x.astype(np.float32)
        self.ahead = self.short @ q.lead.astype(np.float32)
        self.rest = 1 - (self.ahead * self.ahead).sum(axis=1)
        self.starts = np.flatnonzero(np.diff(self.list, prepend=-1))
        self.ends = np.append(self.starts[1:], len(self.list))
        self.lists = self.list[self.starts]
        self.own = np.einsum("ij,ij->i", self.short, q.coarse.astype(np.float32)[self.list])
        self.own_aside = self.aside(self.own, self.list)

    def aside(self, ahead: np.ndarray, lists: np.ndarray) -> np.ndarray:
        """Coordinates along the centroids' own directions, from the products with the centroids of ``lists``."""
        lead = self.q.ahead.astype(np.float32)[lists]
        return (ahead - ((self.ahead * lead).sum(axis=1) if ahead.ndim == 1 else self.ahead @ lead.T)) / self.q.aside[1].astype(np.float32)[lists]


class _Meeting:
    """Links between two blocks, or within one."""

    def __init__(self, q: Quantiser, a: _Side, b: _Side):
        self.q, self.a, self.b, self.same = q, a, b, a.block == b.block
        # Vectors of both sides are nodes; those of a block that meets itself are the same ones.
        self.off = 0 if self.same else len(a.rep)
        self.add = np.zeros(self.off + len(b.rep), np.int64)
        self.low = np.arange(len(self.add))
        self.edges: list[np.ndarray] = []
        self.pairs: list[np.ndarray] = []
        self.n_edges = self.n_pairs = 0
        #: What sums of products in single precision may be off.
        self.band = 2e-6 + q.dims * 1.2e-7

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        np.add.at(self.add, i, self.b.c[j])
        np.add.at(self.add, j + self.off, self.a.c[i])
        self.join(i, j)

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        """Keeps the links between what is not known to be one component."""
        x, y = self.low[i], self.low[j + self.off]
        on = x != y
        if on.any():
            self.edges.append(np.stack([x[on], y[on]]))
            self.n_edges += self.edges[-1].shape[1]
            if self.n_edges > PAIRS // 8:
                self.melt()

    def melt(self) -> None:
        if self.edges:
            x, y = np.concatenate(self.edges, axis=1)
            self.low = forest(x, y, len(self.low))[self.low]
            self.edges, self.n_edges = [], 0

    def rerank(self) -> None:
        """Lookups and exact cosines of the pairs held."""
        if not self.pairs:
            return
        i, j = np.concatenate(self.pairs, axis=1)
        self.pairs, self.n_pairs = [], 0
        a, b, q = self.a, self.b, self.q
        # Tables and lengths for the vectors that are in pairs.
        (mine, x), (other, y) = (np.unique(k, return_inverse=True) for k in (i, j))
        at, codes = b.list[other], b.codes[other]
        length = ((q.coarse[at] + q.decode(codes)) ** 2).sum(axis=1)
        ahead = np.einsum("ij,ij->i", a.x[i], q.coarse[at[y]])
        for m, table in enumerate(q.tables(a.short[mine])):
            ahead += table[x, codes[y, m]]
        on = q.reachable(ahead, length[y], b.missed[j])
        self.exact(i[on], j[on])

    def exact(self, i: np.ndarray, j: np.ndarray) -> None:
        for k in range(0, len(i), 65536):
            x, y = i[k: k + 65536], j[k: k + 65536]
            near = (np.einsum("ij,ij->i", self.a.x[x], self.b.x[y]) >= self.q.cosine) & (self.a.rep[x] != self.b.rep[y])
            self.link(x[near], y[near])

    def whole(self, i: np.ndarray, j: np.ndarray, on: np.ndarray) -> None:
        """All pairs of the rows ``i`` and ``j`` where ``on`` holds, by whole products."""
        on = on & (self.a.rep[i][:, None] != self.b.rep[j])
        s = self.a.short[i] @ self.b.short[j].T
        sure = on & (s >= self.q.cosine + self.band)
        x, y = np.divmod(np.flatnonzero(on & ~sure & (s >= self.q.cosine - self.band)), len(j))
        self.exact(i[x], j[y])
        ones = sure.astype(np.float64)
        np.add.at(self.add, i, (ones @ self.b.c[j]).astype(np.int64))
        np.add.at(self.add, j + self.off, (self.a.c[i] @ ones).astype(np.int64))
        known = self.low[i], self.low[j + self.off]
        if min(map(np.min, known)) < max(map(np.max, known)):
            x, y = np.divmod(np.flatnonzero(sure & (known[0][:, None] != known[1])), len(j))
            self.join(i[x], j[y])

    def chunk(self, i: np.ndarray, j: np.ndarray, upper: np.ndarray) -> None:
        """Rows ``i`` and ``j`` whose cosine is at most ``upper``."""
        on = upper >= self.q.cosine - self.q.loose
        at = np.flatnonzero(on)
        if not len(at):
            return
        if len(at) > DENSE * on.size:
            if self.same:
                on &= i[:, None] < j
            self.whole(i, j, on)
            return
        x, y = np.divmod(at, on.shape[1])
        x, y = i[x], j[y]
        if self.same:
            x, y = x[x < y], y[x < y]
        self.pairs.append(np.stack([x, y]))
        self.n_pairs += len(x)
        if self.n_pairs > PAIRS:
            self.rerank()

    def run(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rep, partners, smallest rep of its component) of the vectors with links."""
        a, b, q = self.a, self.b, self.q
        to_b, to_a = (s.short @ q.coarse.astype(np.float32)[o.lists].T for s, o in ((a, b), (b, a)))
        # How far the vectors of two lists are across the plane between their centroids, at least.
        across = np.maximum(np.sqrt(_squares(q.coarse[a.lists], q.coarse[b.lists])), 1e-9)
        mine = np.minimum.reduceat(a.own[:, None] - to_b, a.starts, axis=0)
        other = np.maximum.reduceat(to_a - b.own[:, None], b.starts, axis=0).T
        meet = (mine - other) <= (q.r + q.loose) * across + q.loose
        if self.same:
            meet &= a.lists[:, None] <= b.lists
        side_b, side_a = a.aside(to_b, b.lists), b.aside(to_a, a.lists)
        turn = q.aside[0][a.lists] @ q.aside[0][b.lists].T
        for g, h in zip(*np.nonzero(meet), strict=True):
            f, t, f2, t2 = a.starts[g], a.ends[g], b.starts[h], b.ends[h]
            self.lists(slice(f, t), slice(f2, t2), side_b[f:t, h], side_a[f2:t2, g], float(turn[g, h]), bool(a.lists[g] == b.lists[h]))
        self.rerank()
        self.melt()
        names = a.rep if self.same else np.concatenate([a.rep, b.rep])
        least = np.full(len(names), np.iinfo(np.int64).max)
        np.minimum.at(least, self.low, names)
        on = self.add > 0
        return names[on], self.add[on], least[self.low[on]]

    def lists(self, mine: slice, other: slice, a_side: np.ndarray, b_side: np.ndarray, turn: float, own: bool) -> None:
        """Members of a list and of another, by bounds in an orthonormal frame: leading directions, both centroids', the length of the rest."""
        a, b = self.a, self.b
        sine = np.sqrt(max(0.0, 1 - turn * turn))
        x, y = (np.zeros((s.stop - s.start, a.ahead.shape[1] + 3), np.float32) for s in (mine, other))
        x[:, :-3], y[:, :-3] = a.ahead[mine], b.ahead[other]
        x[:, -3] = a.own_aside[mine]
        y[:, -3] = b.own_aside[other] if own else b_side
        if not own and sine > 0.1:
            x[:, -2], y[:, -2] = (a_side - turn * x[:, -3]) / sine, (b.own_aside[other] - turn * y[:, -3]) / sine
        for z, rest in ((x, a.rest[mine]), (y, b.rest[other])):
            # Slightly too long, so that the products stay upper bounds.
            z[:, -1] = np.sqrt(np.maximum(rest - z[:, -3] ** 2 - z[:, -2] ** 2, 0) + 1e-5)
        i, j = np.arange(mine.start, mine.stop), np.arange(other.start, other.stop)
        # Along the line between the two means, partners are at most r apart.
        line = sum(np.full(len(z), sign / len(z), np.float32) @ z for sign, z in ((1, x), (-1, y)))
        line[-1] = 0
        size = float(np.sqrt(line @ line))
        if size > 1e-3:
            # Whole steps of that line, which sort in linear time.
            u, w = (np.floor(z @ (line * sign / size * _STEPS)).astype(np.int16) for sign, z in ((1, x), (-1, y)))
            first, second = np.argsort(u, kind="stable"), np.argsort(w, kind="stable")
            x, y, i, j = x[first], y[second], i[first], j[second]
            stops = np.searchsorted(w[second], int(np.ceil((self.q.r + self.q.loose) * _STEPS)) + 2 - u[first[::CHUNK]].astype(np.int64), "right")
        else:
            stops = np.full(-(-len(i) // CHUNK), len(j))
        for k, stop in enumerate(stops.tolist()):
            if not stop:
                break
            at = slice(k * CHUNK, (k + 1) * CHUNK)
            for f in range(0, stop, 32 * CHUNK):
                to = slice(f, min(stop, f + 32 * CHUNK))
                if self.same and own and j[to][-1] <= i[at][0]:
                    continue
                self.chunk(i[at], j[to], x[at] @ y[to].T)


def _meet(q: Quantiser, kind):
    schema = pa.schema([("rep", pa.int64()), ("add", pa.int64()), ("to", pa.int64())])

    def side(batch: pa.RecordBatch, k: int, s: str, block: int) -> _Side:
        return _Side(q, kind, block, {c: batch.column(f"{s}_{c}")[k].as_buffer() for c in ("list", "rep", "c", "v", "codes", "missed")})

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = None
        for batch in batches:
            for k, (one, other) in enumerate(zip(batch.column("a_block").to_pylist(), batch.column("b_block").to_pylist(), strict=True)):
                if a is None or a.block != one:
                    a = side(batch, k, "a", one)
                b = a if other == one else side(batch, k, "b", other)
                yield table_batch(schema, [pa.array(x) for x in _Meeting(q, a, b).run()])
            del batch  # before the next one comes

    return tidy(meet)


def _written(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """``staged``, after which nothing is left of the shuffles behind it: they are as large as the table."""
    spark = df.sparkSession
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        return staged(df, name, codec)
    finally:
        spark.conf.unset(key) if was is None else spark.conf.set(key, was)


def near_vectors(vectors: DataFrame, cosine: float = 0.9) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row of ``vectors`` (vec_id, embedding).

    Vectors of different lengths never link; each length is an index of its
    own, and lengths of one vector need none.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    length = F.coalesce(F.size("embedding"), F.lit(0))
    lengths = sorted(r["n"] for r in rows.select(length.alias("n")).where("n > 0").groupBy("n").count().where("count > 1").collect())
    alone = F.col("vec_id").alias("component_id")
    out = rows.where(~length.isin(lengths)).select("vec_id", F.lit(0).cast("long").alias("n_links"), alone, F.lit(True).alias("kept"))
    for dims in lengths:
        out = out.union(_one_length(rows.where(length == dims), dims, cosine))
    return out


def _one_length(rows: DataFrame, dims: int, cosine: float) -> DataFrame:
    """``near_vectors`` of vectors with ``dims`` components."""
    kind = np.float32 if isinstance(rows.schema["embedding"].dataType.elementType, FloatType) else np.float64
    unit = (rows.mapInArrow(_normal(dims, kind), "vec_id long, v binary, unit binary")
            .select("vec_id", "v", F.xxhash64("unit").alias("h1"), F.xxhash64("unit", F.lit(1)).alias("h2")))
    # The vectors are written once, for the classes; other columns are enough for the result.
    classes = _written(unit.where("v is not null").groupBy("h1", "h2").agg(F.min(F.struct("vec_id", "v")).alias("x"), F.count("*").alias("c"))
                       .select("h1", "h2", F.col("x.vec_id").alias("rep"), "c", F.col("x.v").alias("v")), "classes")
    usable = F.col("v").isNotNull()
    ids = staged(unit.select("vec_id", *(F.when(usable, F.col(h)).alias(h) for h in ("h1", "h2"))), "ids")
    found = _found(classes, dims, kind, cosine)
    classes = classes.drop("v")
    if found is not None:
        links = found.groupBy("rep").agg(F.sum("add").alias("others"))
        component = connected_components(found, "rep", "to").withColumnRenamed("node", "rep")
        classes = classes.join(links, "rep", "left").join(component, "rep", "left")
    else:
        classes = classes.withColumns({"others": F.lit(0).cast("long"), "component": F.lit(None).cast("long")})
    known = classes.select("h1", "h2", (F.col("c") - 1 + F.coalesce("others", F.lit(0))).alias("links"), F.coalesce("component", "rep").alias("component"))
    out = ids.join(known, ["h1", "h2"], "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      component.eqNullSafe(F.col("vec_id")).alias("kept"))


def _found(classes: DataFrame, dims: int, kind, cosine: float) -> DataFrame | None:
    """(rep, add, to): partners of classes, block by block, and links that connect them."""
    n = classes.count()
    # At most SAMPLE vectors reach the driver, to train on.
    some = F.pmod(F.xxhash64("rep"), F.lit(1 << 30)) < F.lit(int(min(1.0, 2 * SAMPLE / max(1, n)) * (1 << 30)))
    sample = classes.select("rep", "v").where(some).orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).collect()
    if not sample:
        return None
    q = Quantiser(_unit(np.frombuffer(b"".join(bytes(r["v"]) for r in sample), kind).reshape(-1, dims)), cosine, min(LISTS, -(-n // LIST)))
    size = max(1, min(BLOCK, BLOCK_BYTES // (np.dtype(kind).itemsize * dims), -(-n // BLOCKS)))
    bins = -(-n // size)
    # Lists follow each other in the bins; a list longer than a bin is cut by a hash of its vectors.
    wide = q.share / q.share.sum() * bins
    first_of = np.minimum(np.cumsum(wide) - wide, bins)
    indexed = classes.select("h1", "rep", "c", "v").mapInArrow(_index(q, kind, first_of, wide), "bin long, list int, rep long, c long, v binary, codes binary, missed double")
    blocks = _written(indexed.repartition(bins, "bin").sortWithinPartitions("bin").mapInArrow(_pack(q, kind, size), _BLOCK), "blocks", "lz4")
    cores = blocks.sparkSession.sparkContext.defaultParallelism
    sides = max(int(np.ceil(np.sqrt(8 * cores))), -(-n * dims * np.dtype(kind).itemsize // READ))
    a, b = (blocks.coalesce(int(sides)).toDF(*(f"{s}_{c}" for c in blocks.columns)) for s in "ab")
    # Each pair of blocks meets once, from one side or the other in turn.
    turn = F.expr("a_block = b_block or (a_block < b_block) = ((xxhash64(least(a_block, b_block), greatest(a_block, b_block)) & 1) = 0)")
    probed = F.arrays_overlap("a_probes", "b_lists") | F.arrays_overlap("b_probes", "a_lists")
    met = a.join(b.hint("shuffle_replicate_nl"), turn & probed).drop("a_lists", "b_lists", "a_probes", "b_probes")
    return staged(met.mapInArrow(_meet(q, kind), "rep long, add long, to long"), "near")


def op9_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract query: cosine of at least 0.9 over all ``embeddings``."""
    from sideline.llm.common import table

    return near_vectors(table(spark, sf_dir, "embeddings"), 0.9)
