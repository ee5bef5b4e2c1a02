"""Hard negatives from lists that clusters of anchors share, walked until nothing better can follow.

Anchors are clustered by direction (centroids fitted to a bounded sample of
them) and cut into clusters of bounded size, each with its centre and the
largest angle between the centre and a member.  Candidates are dealt to the
same centroids and cut into blocks by their angle to them.

1. For each cluster one list is sorted once: candidates by the upper bound of
   their score with any member, length times the cosine of the angle that is
   left between them when the cluster's own angle is taken off.  The list is
   kept in two levels: blocks in the order of their bounds (from angle ranges
   and the largest length), and the rows of a block in the order of their own.
2. Members walk the head of the list first.  What they found there gives each
   a score that must be reached; the walk ends at the first place whose bound
   is below it, and only entries before that place are joined and walked.
   Scores with equal bounds and ties (score, id) are decided exactly.
3. This is done twice: for the positives of each anchor, and then, with their
   scores known, for the negatives inside each positive's score window.

Bounds hold for all vectors, so the end of a walk is certified and the result
is exact.  A pair of a cluster and a block is one row of the join; blocks go
through the exchange once, clusters (a few kB) once for each block they walk.
Where many clusters walk a block, they are dealt over ``PAGE`` at a time.

Defined results: rows with a null label, null vector, any null or non-finite
component, or without ``vec_id`` take no part; vectors of different lengths
never meet, each length is mined for itself, also length 0 (all scores 0);
rows with the anchor's ``vec_id`` are its own; a repeated anchor row is
answered as often, a repeated candidate row is returned as often; scores
beyond a long are cut to it; positives with scores of 0 or less have only
negatives of score 0, if their score is 0, or none; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sideline.llm.batches import table_batch
from sideline.llm.common import staged, width
from sideline.llm.product_quantisation import kmeans
from sideline.llm.top_inner import best
from sideline.llm.vectors import binaries, integer_products, matrix, rows_of

#: Anchors the centroids are fitted to, at most, and centroids, at most.
SAMPLE, CENTROIDS = 8192, 256
#: Anchors in a cluster, candidates in a block, candidates in the head of a list.
MEMBERS, BLOCK, HEAD = 64, 2048, 4096
#: Clusters that meet one copy of a block.
PAGE = 4096
#: Slack of cosines against rounding.
_SLACK = 1e-6


def _scaled(dims: int, scale: float):
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("length", pa.float64()), ("most", pa.float64()), ("v", pa.binary())])

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, ok = matrix(batch.column("embedding"), dims)
            with np.errstate(over="ignore"):
                x = np.floor(scale * x[ok])
            x = np.clip(np.nan_to_num(x), -1e300, 1e300)
            most = np.abs(x).max(axis=1, initial=0)
            big = np.maximum(most, 1)
            length = np.sqrt(((x / big[:, None]) ** 2).sum(axis=1)) * big
            on = pa.array(ok)
            yield table_batch(schema, [batch.column("vec_id").filter(on), batch.column("label").filter(on), pa.array(length), pa.array(most), binaries(x)])

    return scaled


def _units(x: np.ndarray, length: np.ndarray) -> np.ndarray:
    return x / np.where(length > 0, length, 1)[:, None]


def _angle(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1, 1))


_DEALT = "cell int, angle double, vec_id long, label long, length double, v binary"


def _deal(dims: int, kind: np.dtype, centroids: np.ndarray):
    """Rows with their nearest centroid and the angle to it; vectors in the smallest kind of number that holds them."""
    schema = pa.schema([("cell", pa.int32()), ("angle", pa.float64()), ("vec_id", pa.int64()), ("label", pa.int64()), ("length", pa.float64()), ("v", pa.binary())])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 4096):
                part = batch.slice(first, 4096)
                x, length = rows_of(part.column("v"), np.float64, dims), part.column("length").to_numpy()
                cosine = _units(x, length) @ centroids.T
                cell = cosine.argmax(axis=1)
                yield table_batch(schema, [pa.array(cell.astype(np.int32)), pa.array(_angle(cosine[np.arange(len(x)), cell])),
                                           *(part.column(c) for c in ("vec_id", "label", "length")), binaries(x.astype(kind))])

    return deal


def _cut(size: int, schema: pa.Schema, made_of):
    """Rows sorted by cell to one row for each ``size`` of a cell; ``made_of`` gives its columns after the number."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        held: pa.Table | None = None

        def row(rows: pa.Table) -> pa.RecordBatch:
            nonlocal made
            made += 1
            return table_batch(schema, [[task << 32 | made], *([c] for c in made_of(rows.combine_chunks()))])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            cell = rows.column("cell").to_numpy()
            first = 0
            while first < len(cell):
                last = min(first + size, int(np.searchsorted(cell, cell[first], "right")))
                if last == len(cell) and last - first < size:
                    break
                yield row(rows.slice(first, last - first))
                first = last
            held = rows.slice(first)
        if held is not None and held.num_rows:
            yield row(held)

    return cut


def _packed(rows: pa.Table) -> list:
    return [rows.column(c).to_numpy().tobytes() for c in ("vec_id", "label", "length")] + [b"".join(x.as_buffer() for x in rows.column("v").chunk(0))]


_CLUSTER = pa.schema([("cluster", pa.int64()), ("centre", pa.binary()), ("radius", pa.float64()), ("cells", pa.list_(pa.float64())),
                      ("ids", pa.binary()), ("labels", pa.binary()), ("lengths", pa.binary()), ("vs", pa.binary())])
_BLOCKS = pa.schema([("block", pa.int64()), ("cell", pa.int32()), ("low", pa.float64()), ("high", pa.float64()), ("most", pa.float64()), ("rows", pa.int64()),
                     ("b_ids", pa.binary()), ("b_labels", pa.binary()), ("b_lengths", pa.binary()), ("b_vs", pa.binary())])


def _clusters(dims: int, kind: np.dtype, centroids: np.ndarray):
    def made_of(rows: pa.Table) -> list:
        length = rows.column("length").to_numpy()
        unit = _units(rows_of(rows.column("v").chunk(0), kind, dims).astype(np.float64), length)
        centre = unit.sum(axis=0)
        size = np.sqrt((centre * centre).sum())
        centre = centre / size if size > 0 else centre
        radius = float(_angle(unit @ centre).max())
        return [centre.tobytes(), radius, _angle(centroids @ centre).tolist(), *_packed(rows)]

    return _cut(MEMBERS, _CLUSTER, made_of)


def _candidates():
    def made_of(rows: pa.Table) -> list:
        angle, length = rows.column("angle").to_numpy(), rows.column("length").to_numpy()
        return [rows.column("cell")[0].as_py(), float(angle.min()), float(angle.max()), float(length.max()), rows.num_rows, *_packed(rows)]

    return _cut(BLOCK, _BLOCKS, made_of)


def bounds(centre: np.ndarray, radius: float, v: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Upper bound of each row's score with a member of length 1: its length times the cosine of the least angle left."""
    angle = _angle(_units(v, lengths) @ centre) if centre.any() else np.zeros(len(v))
    return lengths * np.clip(np.cos(np.clip(angle - radius, 0, np.pi)) + _SLACK, 0, 1)


def walk(row: dict, needed: np.ndarray, dims: int, kind: np.dtype) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(member, its id, its label, ids, labels, scores) of what each member of a cluster meets in a block.

    The block's rows are sorted by their bounds once; a member goes on until
    the bound times its length is below what it ``needed``.
    """
    ids, labels, lengths = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64), np.frombuffer(row["lengths"])
    a = np.frombuffer(row["vs"], kind).reshape(len(ids), dims).astype(np.float64)
    b_ids, b_labels, b_lengths = np.frombuffer(row["b_ids"], np.int64), np.frombuffer(row["b_labels"], np.int64), np.frombuffer(row["b_lengths"])
    v = np.frombuffer(row["b_vs"], kind).reshape(len(b_ids), dims).astype(np.float64)
    bound = bounds(np.frombuffer(row["centre"]), row["radius"], v, b_lengths)
    order = np.argsort(-bound, kind="stable")
    bound, b_ids, b_labels, v = bound[order], b_ids[order], b_labels[order], v[order]
    with np.errstate(invalid="ignore", divide="ignore"):
        reach = np.where(needed <= 0, -np.inf, needed * (1 - _SLACK) / lengths)
    reach[np.isnan(reach)] = -np.inf
    ends = np.searchsorted(-bound, -reach, "right")
    scores = integer_products(a, v[: ends.max(initial=0)], dims)
    for k in range(len(ids)):
        on = np.flatnonzero(b_ids[: ends[k]] != ids[k])
        yield k, int(ids[k]), int(labels[k]), b_ids[on], b_labels[on], scores[k, on]


def window(positive: int, low: int, high: int) -> tuple[int, int]:
    """The least and the largest score in percent ``low`` to ``high`` of a positive's score; empty where it is negative."""
    return -(-low * positive // 100), high * positive // 100


_FOUND = "cluster long, member int, anchor_id long, place int, positive_id long, positive_score long, vec_id long, score long"
_FOUND_SCHEMA = pa.schema([("cluster", pa.int64()), ("member", pa.int32()), ("anchor_id", pa.int64()), ("place", pa.int32()), ("positive_id", pa.int64()),
                           ("positive_score", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _meet(dims: int, kind: np.dtype, k: int, low: int, high: int):
    """Walks of pairs of a cluster and a block.

    ``asked`` holds what the members look for: without it, their ``k`` best
    rows of the same label; its rows have the place of the positive (0 for
    positives themselves), the positive, and the (score, id) to be reached.
    """
    def found(cluster: int, member: int, anchor: int, ask: dict, ids: np.ndarray, scores: np.ndarray) -> pa.RecordBatch:
        n = len(ids)
        full = lambda value, t: pa.array(np.full(n, value), t) if value is not None else pa.nulls(n, t)
        return table_batch(_FOUND_SCHEMA, [full(cluster, pa.int64()), full(member, pa.int32()), full(anchor, pa.int64()), full(ask["place"], pa.int32()),
                                           full(ask["positive_id"], pa.int64()), full(ask["positive_score"], pa.int64()), pa.array(ids), pa.array(scores)])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                members = len(row["ids"]) // 8
                asked: list[list[dict]] = [[] for _ in range(members)]
                if row["asked"] is None:
                    asked = [[{"place": 0, "positive_id": None, "positive_score": None, "need": None, "need_id": None}] for _ in range(members)]
                for ask in row["asked"] or ():
                    asked[ask["member"]].append(ask)
                needed = np.full(members, np.inf)
                for m, asks in enumerate(asked):
                    for ask in asks:
                        if ask["place"]:
                            least, most = window(ask["positive_score"], low, high)
                            ask["range"] = least if ask["need"] is None else max(least, ask["need"]), most
                            if least > most:
                                continue
                        else:
                            ask["range"] = ask["need"], None
                        needed[m] = min(needed[m], -np.inf if ask["range"][0] is None else ask["range"][0])
                for m, anchor, label, ids, labels, scores in walk(row, needed, dims, kind):
                    for ask in asked[m]:
                        least, most = ask["range"]
                        on = labels != label if ask["place"] else labels == label
                        if most is not None:
                            on &= scores <= most
                        if least is not None:
                            on &= scores >= least
                        if ask["need"] is not None:
                            on &= (scores > ask["need"]) | (ids <= ask["need_id"])
                        on = np.flatnonzero(on)
                        on = on[best(scores[on], ids[on], k)]
                        if len(on):
                            yield found(row["cluster"], m, anchor, ask, ids[on], scores[on])

    return meet


def _meet_all(dims: int, kind: np.dtype, k: int, low: int, high: int):
    """The head of one cluster's list at once: ``k`` rows for each member and place, however many blocks they come from."""
    meet = _meet(dims, kind, k, low, high)

    def together(table: pa.Table) -> pa.Table:
        found = pa.Table.from_batches(list(meet(iter(table.to_batches()))), schema=_FOUND_SCHEMA)
        score, ids = found.column("score").to_numpy(), found.column("vec_id").to_numpy()
        group = found.column("member").to_numpy().astype(np.int64) << 32 | found.column("place").to_numpy()
        order = np.lexsort((ids, ~score, group))  # ~ turns the order without overflow
        group = group[order]
        first = np.searchsorted(group, group, "left")
        return found.take(pa.array(order[np.arange(len(order)) - first < k]))

    return together


_ASKED = "array<struct<member:int,place:int,positive_id:bigint,positive_score:bigint,need:bigint,need_id:bigint>>"


class _Lists:
    """Clusters of anchors, blocks of candidates, and the lists of blocks in the order of their bounds, for one vector length."""

    def __init__(self, whole: DataFrame, is_anchor, dims: int, low: int, high: int):
        spark = whole.sparkSession
        self.dims, self.low, self.high = dims, low, high
        anchors = whole.where(is_anchor)
        # At most SAMPLE anchors reach the driver, to fit the centroids to; and one row of counts.
        sample = anchors.select("length", "v").orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(SAMPLE).collect()
        most = whole.agg(F.max("most").alias("m")).collect()[0]["m"] or 0
        self.kind = np.dtype(next((t for t in (np.int16, np.int32) if most <= np.iinfo(t).max), np.float64))
        unit = _units(np.frombuffer(b"".join(bytes(r["v"]) for r in sample), np.float64).reshape(len(sample), dims), np.array([r["length"] for r in sample]))
        centroids = kmeans(unit, max(1, min(CENTROIDS, int(np.sqrt(len(sample)))))) if len(sample) else np.zeros((1, dims))
        size = np.sqrt((centroids * centroids).sum(axis=1, keepdims=True))
        centroids = np.where(size > 0, centroids / np.where(size > 0, size, 1), 0)

        def dealt(rows: DataFrame) -> DataFrame:
            rows = rows.select("vec_id", "label", "length", "v").mapInArrow(_deal(dims, self.kind, centroids), _DEALT)
            return rows.repartitionByRange("cell", "angle", "vec_id").sortWithinPartitions("cell", "angle", "vec_id")

        kinds = "ids binary, labels binary, lengths binary, vs binary"
        self.clusters = staged(dealt(anchors).mapInArrow(_clusters(dims, self.kind, centroids), f"cluster long, centre binary, radius double, cells array<double>, {kinds}"), "clusters")
        self.blocks = staged(dealt(whole).mapInArrow(_candidates(), "block long, cell int, low double, high double, most double, rows long, " + ", ".join(f"b_{c}" for c in kinds.split(", "))), "blocks")
        # The angle left between a cluster's members and a block's rows, by the angles both have to the block's centroid.
        cells = self.clusters.select("cluster", "radius", F.posexplode("cells").alias("cell", "phi"))
        left = F.greatest(F.lit(0.0), F.col("phi") - F.col("radius") - F.col("high"), F.col("low") - F.col("phi") - F.col("radius"))
        bound = F.col("most") * F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.cos(F.least(left, F.lit(np.pi))) + _SLACK))
        entries = cells.join(self.blocks.select("block", "cell", "low", "high", "most", "rows"), "cell").select("cluster", "block", "rows", bound.alias("bound"))
        order = Window.partitionBy("cluster").orderBy(F.desc("bound"), "block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        # The place of an entry: how many candidates come before its own.
        self.list = staged(entries.withColumn("at", F.sum("rows").over(order) - F.col("rows")).drop("rows"), "lists")
        busiest = self.list.groupBy("block").count().agg(F.max("count").alias("n")).collect()[0]["n"] or 0
        self.pages, self.parts = max(1, -(-busiest // PAGE)), width(spark)

    def walk(self, entries: DataFrame, asked: DataFrame | None, k: int, together: bool = False) -> DataFrame:
        """What the members find in these entries of their lists; ``asked`` (cluster, asked) has what they look for.

        ``together`` takes a cluster's entries in one group, for heads, whose size is bounded.
        """
        clusters = self.clusters.drop("cells")
        clusters = clusters.withColumn("asked", F.lit(None).cast(_ASKED)) if asked is None else clusters.join(asked, "cluster")
        page = F.pmod(F.xxhash64("cluster"), F.lit(self.pages)).cast("int")
        left = entries.select("cluster", "block").join(clusters, "cluster").withColumn("page", page).repartition(self.parts, "block", "page")
        right = (self.blocks.select("block", *(c for c in self.blocks.columns if c.startswith("b_")))
                 .withColumn("page", F.explode(F.sequence(F.lit(0), F.lit(self.pages - 1)))).repartition(self.parts, "block", "page"))
        met = left.join(right.hint("merge"), ["block", "page"]).drop("page", "block")
        if together:
            return met.groupBy("cluster").applyInArrow(_meet_all(self.dims, self.kind, k, self.low, self.high), _FOUND)
        return met.mapInArrow(_meet(self.dims, self.kind, k, self.low, self.high), _FOUND)

    def best(self, asked: DataFrame | None, k: int) -> DataFrame:
        """The ``k`` best for each member and place: the head of the lists first, then until no bound reaches what is needed."""
        place = Window.partitionBy("cluster", "member", "place").orderBy(F.desc("score"), "vec_id")
        top = lambda found: found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
        head = staged(top(self.walk(self.list.where(F.col("at") < HEAD), asked, k, together=True)), "head")
        # What the head gives: the k-th best of those that have so many.
        got = head.where(F.col("rank") == k).select("cluster", "member", "place", F.col("score").alias("need"), F.col("vec_id").alias("need_id"))
        if asked is None:
            members = self.clusters.select("cluster", F.posexplode(F.sequence(F.lit(1), (F.octet_length("ids") / 8).cast("int"))).alias("member", "_"))
            wanted = members.select("cluster", "member", F.lit(0).alias("place"), F.lit(None).cast("long").alias("positive_id"), F.lit(None).cast("long").alias("positive_score"))
        else:
            wanted = asked.select("cluster", F.inline("asked")).drop("need", "need_id")
        wanted = wanted.join(got, ["cluster", "member", "place"], "left")
        lengths = self.clusters.select("cluster", F.col("lengths"))
        state = staged(wanted.groupBy("cluster").agg(F.collect_list(F.struct("member", "place", "positive_id", "positive_score", "need", "need_id")).alias("asked"))
                       .join(lengths, "cluster").mapInArrow(_reach(self.low, self.high), f"cluster long, reach double, asked {_ASKED}"), "asked")
        rest = self.list.where(F.col("at") >= HEAD).join(state.select("cluster", "reach"), "cluster").where(F.col("bound") >= F.col("reach"))
        return staged(top(head.drop("rank").union(self.walk(rest, state.select("cluster", "asked"), k))), "walked")


def _reach(low: int, high: int):
    """The least bound that any member of a cluster still needs; infinite where all have ended."""
    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for asks, lengths in zip(batch.column("asked").to_pylist(), batch.column("lengths"), strict=True):
                lengths = np.frombuffer(lengths.as_buffer())
                least = np.inf
                for ask in asks:
                    need = -np.inf if ask["need"] is None else ask["need"]
                    if ask["place"]:
                        bottom, top = window(ask["positive_score"], low, high)
                        if bottom > top:
                            continue
                        need = max(need, bottom)
                    size = lengths[ask["member"]]
                    least = min(least, need * (1 - _SLACK) / size if need > 0 and size > 0 else -np.inf if need <= 0 else np.inf)
                out.append(least)
            yield pa.RecordBatch.from_arrays([batch.column("cluster"), pa.array(out, pa.float64()), batch.column("asked")], names=["cluster", "reach", "asked"])

    return reach


def hard_negatives(vectors: DataFrame, is_anchor, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: float = 256.0) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows where ``is_anchor`` holds.

    ``vectors`` has vec_id, label and embedding.  Negatives are rows of other
    labels that score ``low`` to ``high`` percent of the positive's score.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding").where(
        "vec_id is not null and label is not null and embedding is not null")
    lengths = sorted(r["n"] for r in rows.select(F.size("embedding").alias("n")).distinct().collect())
    out = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    for dims in lengths:
        kinds = "vec_id long, label long, length double, most double, v binary"
        whole = staged(rows.where(F.size("embedding") == dims).mapInArrow(_scaled(dims, scale), kinds), "vectors")
        lists = _Lists(whole, is_anchor, dims, low, high)
        found = lists.best(None, positives)
        asked = staged(found.groupBy("cluster").agg(F.collect_list(F.struct(
            "member", F.col("rank").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
            F.lit(None).cast("long").alias("need"), F.lit(None).cast("long").alias("need_id"))).alias("asked")), "positives")
        mined = lists.best(asked, negatives)
        out = out.union(mined.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
    return out


def op13_shared_lists(spark, sf_dir: str) -> DataFrame:
    """Contract query: anchors are the rows of ``embeddings`` with ids divisible by 100; labels of ids divisible by 7 move on by one."""
    from sideline.llm.common import table

    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec_id") % 100 == 0)
