"""SentencePiece encoding and decoding by suffix-array matching.

For models of the BPE kind with byte fallback.  No piece crosses the start of
a word, so a batch of texts is encoded by its words, each word not yet
remembered once.  These words are one concatenated text:

1. a suffix array sorts its places by the letters that follow (as many as the
   longest piece has, by prefix doubling);
2. every piece of the vocabulary is binary-searched in it, a letter at a time;
   what is left of its range are the places where it occurs, each an edge from
   its first letter to the one behind its last;
3. the edges are sorted by position and relaxed: the last piece of the
   encoding of a prefix is the one edge whose piece may stand behind the last
   piece of the prefix before it.

Two pieces may stand side by side if merging would not have joined or regrouped
any of their parts earlier than it made both; this is checked for all edges of
a wave at once by undoing the latest merge of the two, again and again.
Encodings in which all neighbours may stand side by side are exactly what
merging pair by pair gives, so the result is that of the model's own encoder.

Runs of spaces are merged last by such models, and apart.  Letters without a
piece become their UTF-8 bytes.

Defined results: a null text is empty, an empty text has no ids; a space and
the model's space letter are the same, so decoding gives a space for either; a
null ``doc_id`` stays; repeated rows give equal rows; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sideline.llm.common import keep_one

SPACE = "▁"
#: Words remembered by one Python worker; letters of new words matched at once.
REMEMBERED, LETTERS = 250_000, 1_000_000


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def merge(symbols: list[str], rank: dict[str, int]) -> tuple[list[str], tuple[str, str] | None]:
    """Plain pair merging, the lowest rank first and leftmost among equals: (symbols, last merged pair)."""
    left, right = list(range(-1, len(symbols) - 1)), [*range(1, len(symbols)), -1]
    live: list[str | None] = list(symbols)
    agenda = [(rank[a + b], i, a, b) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in rank]
    heapq.heapify(agenda)
    last = None
    while agenda:
        _, i, a, b = heapq.heappop(agenda)
        j = right[i] if live[i] is not None else -1
        if live[i] != a or j < 0 or live[j] != b:
            continue
        last = (a, b)
        live[i], live[j] = a + b, None
        right[i] = right[j]
        if right[j] >= 0:
            left[right[j]] = i
        for x in (left[i], i):
            y = right[x] if x >= 0 else -1
            if y >= 0 and live[x] + live[y] in rank:
                heapq.heappush(agenda, (rank[live[x] + live[y]], x, live[x], live[y]))
    return [s for s in live if s is not None], last


class PieceModel:
    """A vocabulary prepared for matching.  Inside, a piece is its number in merge order, letters first."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.vocab_size()
        names = [sp.id_to_piece(i) for i in range(size)]
        self.byte = {int(names[i][3:5], 16): i for i in range(size) if sp.is_byte(i)}
        normal = [i for i in range(size) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.plain = [b"" if sp.is_control(i) else bytes([int(names[i][3:5], 16)]) if sp.is_byte(i) else names[i].replace(SPACE, " ").encode() for i in range(size)]
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        score = {names[i]: sp.get_score(i) for i in normal}
        # Equal scores are equal ranks: then the leftmost pair is merged first.
        order = sorted({-score[p] for p in score if len(p) > 1})
        place = {s: r for r, s in enumerate(order)}
        self.rank = {p: place[-score[p]] for p in score if len(p) > 1}
        ident = {names[i]: i for i in normal}
        self.space_runs: dict[int, bytes] = {}
        self.ident = ident
        letters = sorted(p for p in score if len(p) == 1)
        words = sorted((p for p in self.rank if set(p) != {SPACE}), key=lambda p: (self.rank[p], p))
        splits = {}
        for p in words:
            whole, last = merge(list(p), self.rank)
            if whole == [p]:
                splits[p] = last
        self.pieces = [*letters, *(p for p in words if p in splits)]
        number = {p: k for k, p in enumerate(self.pieces)}
        n = len(self.pieces)
        self.unknown = n
        self.id_of = np.array([ident[p] for p in self.pieces] + [0], np.int64)
        self.first = np.array([number[splits[p][0]] if p in splits else k for k, p in enumerate(self.pieces)], np.int64)
        self.second = np.array([number[splits[p][1]] if p in splits else k for k, p in enumerate(self.pieces)], np.int64)
        joins = sorted((number[p[:k]] * n + number[p[k:]], number[p]) for p in splits for k in range(1, len(p)) if p[:k] in number and p[k:] in number)
        self._hash_joins(np.array([a for a, _ in joins], np.int64), np.array([b for _, b in joins], np.int64))
        self.letter = {ord(p): k + 1 for k, p in enumerate(letters)}
        self.longest = max(map(len, self.pieces), default=1)
        self.lengths = np.array([len(p) for p in self.pieces], np.int64)
        self.spelled = np.zeros((n, self.longest), np.int64)
        for k, p in enumerate(self.pieces):
            self.spelled[k, : len(p)] = [self.letter[ord(c)] for c in p]
        self.known: dict[str, bytes] = {}

    def _hash_joins(self, keys: np.ndarray, to: np.ndarray) -> None:
        """Pairs that merge, as an open-addressed table with room; slots are probed up to the longest chain."""
        self.bits = max(8, int(len(keys) * 4).bit_length())
        self.join_key, self.join_to = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int64)
        self.probes = 1
        left, at = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.join_key[at[left]] < 0
            taken, who = np.unique(np.where(free, at[left], -1), return_index=True)
            who = left[who[taken >= 0]]
            self.join_key[at[who]], self.join_to[at[who]] = keys[who], to[who]
            left = np.setdiff1d(left, who)
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)
            self.probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def joined(self, keys: np.ndarray) -> np.ndarray:
        """What each pair merges to; a number beyond all pieces if it does not."""
        out = np.full(len(keys), np.iinfo(np.int64).max)
        at, todo = self._slot(keys), np.arange(len(keys))
        for _ in range(self.probes):
            held = self.join_key[at]
            hit = held == keys[todo]
            out[todo[hit]] = self.join_to[at[hit]]
            on = ~hit & (held >= 0)
            if not on.any():
                break
            todo, at = todo[on], (at[on] + 1) & ((1 << self.bits) - 1)
        return out

    def side_by_side(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether pieces a[i], b[i] may be neighbours; an unknown letter may stand anywhere."""
        n = self.unknown
        ok = np.ones(len(a), bool)
        at = np.flatnonzero((a < n) & (b < n))
        a, b = a[at].copy(), b[at].copy()
        limit = np.full(len(at), np.iinfo(np.int64).max)
        while len(at):
            early = self.joined(a * n + b) < limit
            ok[at[early]] = False
            # Undo the later of the two merges; a letter cannot be undone.
            left = (a > b) & (self.second[a] != a)
            left |= (self.first[b] == b) & (self.second[a] != a)
            right = ~left & (self.first[b] != b)
            limit = np.where(left, a, np.where(right, b + 1, limit))
            a, b = np.where(left, self.second[a], a), np.where(right, self.first[b], b)
            on = ~early & (left | right)
            at, a, b, limit = at[on], a[on], b[on], limit[on]
        return ok

    def occurrences(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, piece) of every piece in a text of letter numbers (0: none), by a suffix array and binary search."""
        n = len(text)
        if not n:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        # Four letters at first, then twice as many in each round.
        bits = int(len(self.letter) + 1).bit_length()
        step = max(1, min(4, 62 // bits))
        ahead = np.concatenate([text, np.zeros(self.longest, np.int64)])
        key = np.zeros(n, np.int64)
        for k in range(step):
            key = key << bits | ahead[k: k + n]
        while step < self.longest:
            rank = np.unique(key, return_inverse=True)[1].astype(np.int64) + 1
            behind = np.zeros(n, np.int64)
            behind[: max(0, n - step)] = rank[step:]
            key = rank << 31 | behind
            step *= 2
        suffixes = np.argsort(key, kind="stable")
        padded = np.concatenate([text, np.zeros(self.longest, np.int64)])
        low, high = np.zeros(len(self.pieces), np.int64), np.full(len(self.pieces), n)
        active = np.arange(len(self.pieces))
        for k in range(self.longest):
            active = active[(self.lengths[active] > k) & (high[active] > low[active])]
            if not len(active):
                break
            letter = self.spelled[active, k]
            edges = []
            for add in (0, 1):  # first place not below the letter, first above it
                x, y = low[active].copy(), high[active].copy()
                while (x < y).any():
                    mid = (x + y) // 2
                    below = padded[suffixes[np.minimum(mid, n - 1)] + k] < letter + add
                    below &= x < y
                    x, y = np.where(below, mid + 1, x), np.where(~below & (x < y), mid, y)
                edges.append(x)
            low[active], high[active] = edges
        count = np.where(high > low, high - low, 0)
        piece = np.repeat(np.arange(len(self.pieces)), count)
        at = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return suffixes[at], piece

    def relax(self, text: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(last piece, where it begins) of the encoding of each prefix of each word; index: end of the prefix plus its word's number."""
        place, piece = self.occurrences(text)
        gaps = np.flatnonzero(text == 0)
        place = np.concatenate([place, gaps])
        length = np.concatenate([self.lengths[piece], np.ones(len(gaps), np.int64)])
        piece = np.concatenate([piece, np.full(len(gaps), self.unknown)])
        ends = np.append(starts[1:], len(text))
        word = np.repeat(np.arange(len(starts)), ends - starts)[place]
        inside = place + length <= ends[word]
        place, piece, length, word = place[inside], piece[inside], length[inside], word[inside]
        reach = place + length - starts[word]
        order = np.argsort(reach.astype(np.int16) if reach.max(initial=0) < 1 << 15 else reach, kind="stable")
        place, piece, length, word, reach = place[order], piece[order], length[order], word[order], reach[order]
        # One more slot for each word: the empty prefix.
        last = np.full(len(text) + len(starts), -1, np.int64)
        back = np.zeros(len(last), np.int64)
        waves = np.searchsorted(reach, np.arange(1, reach.max(initial=0) + 2))
        for a, b in zip(waves[:-1], waves[1:], strict=True):
            source, p = place[a:b] + word[a:b], piece[a:b]
            before = last[source]
            fresh = place[a:b] == starts[word[a:b]]
            ok = fresh | (before >= 0)
            test = np.flatnonzero(ok & ~fresh)
            ok[test] = self.side_by_side(before[test], p[test])
            on = np.flatnonzero(ok)
            target = source[on] + length[a:b][on]
            last[target], back[target] = p[on], source[on]
        return last, back

    def _run(self, n: int) -> bytes:
        if n not in self.space_runs:
            runs, _ = merge([SPACE] * n, {p: r for p, r in self.rank.items() if set(p) == {SPACE}})
            made = np.array([self.ident[p] for p in runs], self.dtype).tobytes()
            if n > 64:
                return made
            self.space_runs[n] = made
        return self.space_runs[n]

    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        """The ids of words, each behind one space letter."""
        out: dict[str, bytes] = {}
        first = 0
        while first < len(words):
            last, size = first, 0
            while last < len(words) and (last == first or size + len(words[last]) + 1 <= LETTERS):
                size += len(words[last]) + 1
                last += 1
            part = words[first:last]
            first = last
            joined = SPACE + SPACE.join(part)
            codes = np.frombuffer(joined.encode("utf-32-le"), "<u4")
            kinds, which = np.unique(codes, return_inverse=True)
            text = np.array([self.letter.get(int(c), 0) for c in kinds], np.int64)[which]
            sizes = np.array([len(w) + 1 for w in part], np.int64)
            starts = np.cumsum(sizes) - sizes
            tail, back = self.relax(text, starts)
            # Walk back from the end of all words at once.
            at = starts + sizes + np.arange(len(part))
            home = starts + np.arange(len(part))
            found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            who = np.arange(len(part))
            while len(who):
                found.append((who, tail[at[who]], back[at[who]] - who))
                at[who] = back[at[who]]
                who = who[at[who] > home[who]]
            word = np.concatenate([f[0] for f in found])
            piece = np.concatenate([f[1] for f in found])
            begin = np.concatenate([f[2] for f in found])
            order = np.lexsort((begin, word))
            word, piece, begin = word[order], piece[order], begin[order]
            ids = self.id_of[piece].astype(self.dtype)
            edges = np.searchsorted(word, np.arange(len(part) + 1))
            odd = set(word[piece == self.unknown].tolist())
            width, raw = self.dtype.itemsize, ids.tobytes()
            for k, w in enumerate(part):
                a, b = edges[k], edges[k + 1]
                if k in odd:
                    made: list[int] = []
                    for x in range(a, b):
                        made += [self.byte[c] for c in joined[begin[x]].encode()] if piece[x] == self.unknown else [int(ids[x])]
                    out[w] = np.array(made, self.dtype).tobytes()
                else:
                    out[w] = raw[a * width: b * width]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian bytes."""
        cut = [(" " + t).replace(SPACE, " ").split(" ")[1:] if t else [] for t in texts]
        new = list({w for words in cut for w in words if w and w not in self.known})
        made = self.encode_words(new)
        for w in new[: max(0, REMEMBERED - len(self.known))]:
            self.known[w] = made[w]
        alone = np.array([self.ident[SPACE]], self.dtype).tobytes() if SPACE in self.ident else b""
        out = []
        for words in cut:
            if "" not in words:
                out.append(b"".join([self.known.get(w) or made[w] for w in words]))
                continue
            ids, run = [], 0
            for w in words:
                run += 1
                if not w:
                    continue
                got = self.known.get(w) or made[w]
                if run > 1:
                    # The last space is the word's if it merged with it.
                    if alone and got.startswith(alone):
                        ids.append(self._run(run))
                        got = got[len(alone):]
                    else:
                        ids.append(self._run(run - 1))
                ids.append(got)
                run = 0
            if run:
                ids.append(self._run(run))
            out.append(b"".join(ids))
        return out

    def decode(self, ids: bytes) -> str:
        """The text of ids; the space the encoder puts in front is taken off."""
        text = b"".join(map(self.plain.__getitem__, np.frombuffer(ids, self.dtype).tolist()))
        return text.removeprefix(b" ").decode("utf-8", "replace")


def model(path: str | None = None) -> PieceModel:
    """One prepared vocabulary for each model file and Python worker."""
    path = path or default_model()
    return keep_one("pieces", path, lambda: PieceModel(path))


def _encode(path: str | None, with_ids: bool):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(path)
        for batch in batches:
            for first in range(0, batch.num_rows, 2000):
                part = batch.slice(first, 2000)
                texts = [t or "" for t in part.column("text").to_pylist()]
                ids = pieces.encode(texts)
                wide = [np.frombuffer(x, pieces.dtype) for x in ids]
                columns = {"doc_id": part.column("doc_id"), "n_ids": pa.array([len(x) for x in wide], pa.int64()),
                           "ids_crc32": pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in wide], pa.int64()),
                           "round_trip": pa.array([pieces.decode(x) == t.replace(SPACE, " ") for x, t in zip(ids, texts, strict=True)], pa.bool_())}
                if with_ids:
                    columns["ids"] = pa.array([x.astype(np.int32) for x in wide], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(columns)

    return encode


def _decode(path: str | None):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model(path)
        for batch in batches:
            rows = [None if x is None else pieces.decode(np.array(x, pieces.dtype).tobytes()) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "text": pa.array(rows, pa.string())})

    return decode


def encode_pieces(docs: DataFrame, path: str | None = None, with_ids: bool = True) -> DataFrame:
    """(doc_id, n_ids, ids_crc32, round_trip, ids) of each text; the checksum is of four little-endian bytes for each id."""
    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(
        _encode(path, with_ids), "doc_id long, n_ids long, ids_crc32 long, round_trip boolean" + ", ids array<int>" * with_ids)


def decode_pieces(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) of rows with ids; null ids give a null text."""
    return encoded.select("doc_id", "ids").mapInArrow(_decode(path), "doc_id long, text string")


def op8_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents`` encoded and decoded again."""
    from sideline.llm.common import table

    return encode_pieces(table(spark, sf_dir, "documents"), with_ids=False)
