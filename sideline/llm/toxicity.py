"""Toxicity of documents: a fuzzy lexicon scan, scored in context.

* The lexicon is a short fixed list of insults plus stems learned from
  labelled rows: word beginnings and whole words whose presence parts toxic
  from clean training texts (signed likelihood ratio), picked greedily so that
  each must explain toxic texts that no earlier pick explains.  Copies of one
  toxic text therefore cannot bring in their ordinary words.
* Every whole text is scanned by a Levenshtein automaton of one edit that is
  intersected with the lexicon's trie and determinised as it goes; a word
  mostly leaves it after two or three letters.
* Near forms that ordinary words often have as well (another first letter, an
  edit in a beginning) are loose hits with a learned weight of their own.
* Each hit is weighed by a window of words around it: quotation marks or
  words of reporting make it a quotation, a pronoun of address makes it abuse.
* A logistic model over a few counts gives the score.

Only the lexicon and the model are fitted on a sample, which is bounded by
``FIT_TOXIC`` and ``FIT_CLEAN`` different labelled texts (chosen by a hash of
the id, so alike at every size); every document is scanned and scored.  What a
score uses is the text alone.

Defined results: a null or empty text has no hit and gets the model's score for
that; a null ``doc_id`` is scored and never held out; repeated rows score
alike; labels that are null, or of ids that are not in ``docs``, are not used;
without both classes the fixed lexicon and fixed weights apply; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sideline.llm.common import keep_one, staged

FIT_TOXIC, FIT_CLEAN = 4000, 8000
THRESHOLD = 0.7
#: Least signed likelihood ratio of a learned stem, and the least ratio of its rates.
LEAST_RATIO, LEAST_ODDS = 20.0, 5.0
#: A learned stem is weak if its odds are below this: clean texts have it by chance too, so its density counts.
STRONG_ODDS = 60.0
TERMS = 200
#: Words on each side of a hit that decide its context.
WINDOW = 6
#: Common insults, pronouns of address, words of reporting.
INSULTS = ("idiot", "moron", "stupid", "loser", "trash", "scum", "worthless", "pathetic", "disgusting", "clown",
           "imbecile", "dumbass", "bastard", "asshole", "bitch", "retard", "vermin", "filth", "degenerate", "scumbag")
ADDRESS = frozenset(("you", "your", "you're", "youre", "u", "ur", "yourself"))
REPORT = frozenset(("said", "says", "wrote", "called", "quote", "quoted", "word", "term", "phrase", "slur", "reported", "allegedly"))
_EDGE = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum()) + "“”„«»‘’…¿¡–—"
_OPEN = re.compile(r"^[\"“„«‘'(\[]*[\"“„«]")
_CLOSE = re.compile(r"[\"”“»][.,;:!?)\]]*$")
#: Weights if there is nothing to learn from: constant, hits, edited, quoted, addressed, weak hits, their density, loose hits, their density.
FIXED = np.array([-3.0, 3.5, 0.0, 0.0, 0.5, 0.0, 0.0, 0.0, 0.0])
_REMEMBERED = 100_000


class FuzzyLexicon:
    """Terms (whole words, or beginnings that end in ``*``) as a trie, run against words with at most one edit.

    ``find(word)`` is 0 for no match, 1 for an exact one, 2 for one with an
    edit, 3 for an exact one of a weak term only, 4 for a loose one.
    Whole words of five letters and more match with an edit if they begin
    alike; beginnings match exactly.  Loose matches are looked for if ``wide``:
    whole words of five letters and more whose first letter is another one or
    missing; beginnings of five letters and more with one edit before their
    last letter (their first letter may be another one or missing, too); whole
    words of four letters with a digit or sign in place of a letter.  Weak
    terms match exactly only.
    """

    def __init__(self, terms, weak=(), wide=False):
        self.wide = wide
        self.children: list[dict[str, int]] = [{}]
        # 1: a whole word ends here, 2: one that allows an edit, 4: a beginning ends here; 8 and 16: a weak word, a weak beginning;
        # 32: a whole word of four letters, 64: a beginning of five or more
        self.ends: list[int] = [0]
        for term in (*terms, *weak):
            node = 0
            for letter in term.rstrip("*"):
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.ends.append(0)
                node = self.children[node][letter]
            if term in weak:
                self.ends[node] |= 16 if term.endswith("*") else 8
            else:
                self.ends[node] |= 4 if term.endswith("*") else 3 if len(term) >= 5 else 1
                self.ends[node] |= 64 if term.endswith("*") and len(term) > 5 else 32 if len(term) == 4 and not term.endswith("*") else 0
        self.letters = {x for c in self.children for x in c}
        self.states: dict[frozenset, int] = {}
        self.steps: list[dict[str, int]] = []
        self.sets: list[frozenset] = []
        self.accept: list[int] = []
        self.begun: list[int] = []
        self.start = self._state(frozenset({(0, 0)}))
        self.known: dict[str, int] = {}

    def _state(self, places: frozenset) -> int:
        """Of (node, edits): no edit, 1: one, 2: one at the first letter, 3: a sign for a letter; node -1: a beginning ended with an edit before."""
        at = self.states.get(places)
        if at is None:
            at = self.states[places] = len(self.sets)
            self.sets.append(places)
            self.steps.append({})
            begun = (-1, 0) in places
            places = places - {(-1, 0)}
            here = 0
            for n, e in places:
                here |= 0 if e else self.ends[n]
            self.begun.append(1 if here & 4 else 3 if here & 16 else 4 if begun else 0)
            loose = any(e == 2 and self.ends[n] & 2 or e == 3 and self.ends[n] & 32 for n, e in places)
            places = {(n, e) for n, e in places if e < 2}
            exact = here & 1
            # With no edit yet, the last letter of the term may still be missing.
            near = any(self.ends[n] & 2 if e else any(self.ends[c] & 2 for c in self.children[n].values()) for n, e in places) \
                or any(e == 0 and self.ends[n] & 2 for n, e in places)
            self.accept.append(1 if exact else 3 if here & 8 else 2 if near else 4 if loose else 0)
        return at

    def _step(self, state: int, letter: str) -> int:
        out = set()
        sign = self.wide and letter and not letter.isalpha()
        for node, edits in self.sets[state]:
            if node < 0:
                continue
            if letter in self.children[node]:
                out.add((self.children[node][letter], edits))
                if self.wide and edits in (1, 2) and self.ends[self.children[node][letter]] & 64:
                    out.add((-1, 0))
            if edits or not (node or self.wide):
                continue
            if node:
                out.add((node, 1))  # a letter too many
            for x, child in self.children[node].items():
                out.add((child, 1 if node else 2))  # another letter
                if sign and x.isalpha():
                    out.add((child, 3))
                if letter in self.children[child]:
                    out.add((self.children[child][letter], 1 if node else 2))  # a letter missing
                    if self.wide and self.ends[self.children[child][letter]] & 64:
                        out.add((-1, 0))
        return self._state(frozenset(out)) if out else -1

    def _run(self, word: str) -> int:
        state, weak, loose = self.start, 0, 0
        for letter in word:
            if letter not in self.letters:
                letter = "" if letter.isalpha() else "\0"
            step = self.steps[state].get(letter)
            if step is None:
                step = self.steps[state][letter] = self._step(state, letter)
            if step < 0:
                return weak or loose
            state = step
            if self.begun[state]:
                if self.begun[state] == 1:
                    return 1
                if self.begun[state] == 3:
                    weak = 3
                else:
                    loose = 4
        return self.accept[state] if self.accept[state] == 1 else weak or self.accept[state] or loose

    def find(self, chunk: str) -> int:
        """For a lower-case word as it stands in the text."""
        got = self.known.get(chunk)
        if got is None:
            got = self._run(chunk.strip(_EDGE))
            if len(self.known) < _REMEMBERED:
                self.known[chunk] = got
        return got


def hits(text: str, lexicon: FuzzyLexicon) -> tuple[float, ...]:
    """(plain exact hits, plain hits with an edit, quoted hits, addressed hits, weak hits, loose hits, words) of a whole text."""
    chunks = text.lower().split()
    find = lexicon.find
    found = {c for c in set(chunks) if find(c)}
    if not found:
        return 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, float(len(chunks))
    exact = edited = quoted = addressed = weak = loose = 0
    for i, chunk in enumerate(chunks):
        if chunk not in found:
            continue
        if find(chunk) == 3:
            weak += 1
            continue
        if find(chunk) == 4:
            loose += 1
            continue
        window = chunks[max(0, i - WINDOW): i + WINDOW + 1]
        at = min(i, WINDOW)
        opened = any(_OPEN.search(w) for w in window[: at + 1])
        closed = any(_CLOSE.search(w) for w in window[at:])
        bare = {w.strip(_EDGE) for w in window}
        to_you = bool(bare & ADDRESS)
        if (opened and closed) or (bare & REPORT and not to_you):
            quoted += 1
        elif find(chunk) == 1:
            exact += 1
            addressed += to_you
        else:
            edited += 1
            addressed += to_you
    return float(exact), float(edited), float(quoted), float(addressed), float(weak), float(loose), float(len(chunks))


def features(counts: np.ndarray) -> np.ndarray:
    """Columns as in ``FIXED``."""
    exact, edited, quoted, addressed, weak, loose, words = counts.T
    return np.stack([np.ones(len(counts)), np.log1p(exact + 0.7 * edited + 0.15 * quoted), np.log1p(edited), np.log1p(quoted), np.log1p(addressed),
                     np.log1p(weak), np.log1p(100 * weak / np.maximum(words, 20)), np.log1p(loose), np.log1p(100 * loose / np.maximum(words, 20))], axis=1)


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic weights by Newton's method, drawn towards ``FIXED``."""
    w = FIXED.copy()
    pull = np.full(len(w), ridge)
    pull[0] = 0.1
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + pull * (w - FIXED)
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(pull), gradient)
        step *= min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def stems(text: str) -> set[str]:
    """Whole words, and beginnings of four to seven letters (ending in ``*``), of a text."""
    out = set()
    for word in {c.strip(_EDGE) for c in text.lower().split()}:
        if len(word) >= 4:
            if len(word) <= 12:
                out.add(word)
            out.update(word[:k] + "*" for k in range(4, min(7, len(word) - 1) + 1))
    return out


def _count_stems(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, 200):
            part = batch.slice(first, 200)
            count = (Counter(), Counter())
            rows: dict[str, int] = {}
            for text, toxic, row in zip(*(part.column(c).to_pylist() for c in ("text", "toxic", "row")), strict=True):
                has = stems(text or "")
                count[toxic].update(has)
                for stem in has:
                    rows[stem] = rows.get(stem, 0) ^ row
            yield pa.RecordBatch.from_pydict({"stem": pa.array(list(rows), pa.string()), "a": pa.array([count[1][s] for s in rows], pa.int64()),
                                              "b": pa.array([count[0][s] for s in rows], pa.int64()), "rows": pa.array(list(rows.values()), pa.int64())})


def ratio(a, b, total_a: float, total_b: float):
    """Signed likelihood ratio of presence in ``a`` of ``total_a`` toxic and ``b`` of ``total_b`` clean texts."""
    a, b = np.asarray(a, float), np.asarray(b, float)

    def ll(k, n, p):
        p = np.clip(p, 1e-12, 1 - 1e-12)
        return k * np.log(p) + (n - k) * np.log(1 - p)

    every = (a + b) / (total_a + total_b)
    g = 2 * (ll(a, total_a, a / total_a) + ll(b, total_b, b / total_b) - ll(a, total_a, every) - ll(b, total_b, every))
    return np.where((odds(a, b, total_a, total_b) >= LEAST_ODDS) & (a >= 3), g, 0.0)


def odds(a, b, total_a, total_b):
    """Ratio of the smoothed rates of presence."""
    return ((a + 0.5) / (total_a + 1)) / ((b + 0.5) / (total_b + 1))


def choose(presence: list[tuple[int, set[str]]], candidates: list[str]) -> tuple[list[str], list[str]]:
    """(strong, weak) terms picked one after the other: the one that best parts the toxic texts not yet explained from all clean ones."""
    total_b = sum(t == 0 for t, _ in presence)
    clean = Counter(s for t, has in presence if t == 0 for s in has)
    left = [has for t, has in presence if t == 1]
    total_a = len(left)
    toxic = Counter(s for has in left for s in has)
    chosen: list[str] = []
    count = Counter(toxic)
    while left and len(chosen) < TERMS:
        names = [s for s in candidates if count[s] >= 3]
        if not names:
            break
        value = ratio([count[s] for s in names], [clean[s] for s in names], total_a, total_b)
        # Of equals the longest, as it is the most specific.
        k = max(range(len(names)), key=lambda i: (round(float(value[i]), 6), len(names[i]), names[i]))
        if value[k] < LEAST_RATIO:
            break
        chosen.append(names[k])
        for has in left:
            if names[k] in has:
                count.subtract(has)
        left = [has for has in left if names[k] not in has]
    strong = [s for s in chosen if odds(toxic[s], clean[s], total_a, total_b) >= STRONG_ODDS]
    return strong, [s for s in chosen if s not in strong]


def _present(candidates: list[str]):
    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {s: k for k, s in enumerate(candidates)}
        for batch in batches:
            rows = [sorted(place[s] for s in stems(t or "") & place.keys()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"toxic": batch.column("toxic"), "has": pa.array(rows, pa.list_(pa.int32()))})

    return present


def _count_hits(terms: tuple, keep: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = _lexicon(terms)
        for batch in batches:
            rows = np.array([hits(t.as_py() or "", lexicon) for t in batch.column("text")]).reshape(-1, 7)
            yield pa.RecordBatch.from_pydict({keep: batch.column(keep)} | {n: pa.array(rows[:, k]) for k, n in enumerate(("exact", "edited", "quoted", "addressed", "weak", "loose", "words"))})

    return count


def _lexicon(terms: tuple) -> FuzzyLexicon:
    """One automaton for each lexicon (strong terms, weak terms, wide or not) and Python worker."""
    return keep_one("lexicon", terms, lambda: FuzzyLexicon(*terms))


def held_out(doc_id="doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame) -> tuple[tuple, np.ndarray]:
    """((strong terms, weak terms, wide), weights) from labelled rows that are not held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        "doc_id is not null and toxic in (0, 1)").where(~held_out()).distinct()
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("_text", F.xxhash64("text"))
    # Each different text once, so copies neither fill the sample nor bring in their ordinary words.
    once = texts.select("doc_id", "_text").join(known, "doc_id").groupBy("toxic", "_text").agg(F.min(F.struct(F.xxhash64("doc_id").alias("at"), "doc_id")).alias("of"))
    ids = [once.where(f"toxic = {t}").orderBy("of", "_text").limit(n).select("toxic", "_text", "of.doc_id") for t, n in ((1, FIT_TOXIC), (0, FIT_CLEAN))]
    # At most FIT_TOXIC + FIT_CLEAN short rows: the bound of this broadcast.
    sample = staged(texts.join(F.broadcast(ids[0].union(ids[1])), ["doc_id", "_text"]).dropDuplicates(["toxic", "_text"])
                    .select("toxic", "text", F.xxhash64("_text", "toxic").alias("row")), "labelled")
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return (INSULTS, ()), FIXED
    counted = sample.mapInArrow(_count_stems, "stem string, a long, b long, rows long").groupBy("stem").agg(
        F.sum("a").alias("a"), F.sum("b").alias("b"), F.bit_xor("rows").alias("rows"))
    a, b = sizes[1], sizes[0]
    worth = odds(F.col("a"), F.col("b"), a, b)
    # Of stems in the same texts the longest stands for all: choose() can take no other one.
    eligible = counted.where(F.col("a") >= 3).where(worth >= LEAST_ODDS).groupBy("a", "b", "rows").agg(F.max(F.struct(F.length("stem"), "stem")).alias("of"))
    found = eligible.select("of.stem", "a", "b").collect()  # bounded by the sample
    # What falls short over all toxic texts falls short over those left, too.
    value = ratio([r["a"] for r in found], [r["b"] for r in found], a, b)
    candidates = sorted(r["stem"] for r, v in zip(found, value, strict=True) if v >= LEAST_RATIO)
    presence = [(r["toxic"], {candidates[k] for k in r["has"]}) for r in sample.mapInArrow(_present(candidates), "toxic int, has array<int>").collect()]
    strong, weak = choose(presence, candidates)
    terms = (tuple(sorted({*INSULTS, *strong})), tuple(sorted({*weak} - {*INSULTS})), True)
    rows = sample.mapInArrow(_count_hits(terms, "toxic"), "toxic int, exact double, edited double, quoted double, addressed double, weak double, loose double, words double").collect()
    x = np.array([r[1:] for r in rows], float).reshape(-1, 7)
    weights = fit(features(x), np.array([r[0] for r in rows], float))
    weights[-2:] = np.maximum(weights[-2:], 0)  # a misspelled insult makes no text better
    return terms, weights


def _score(terms: tuple, weights: np.ndarray):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = _lexicon(terms)
        for batch in batches:
            counts = np.array([hits(t.as_py() or "", lexicon) for t in batch.column("text")]).reshape(-1, 7)
            value = 1 / (1 + np.exp(-np.clip(features(counts) @ weights, -30, 30)))
            at = batch.schema.get_field_index("text")
            columns = [c for i, c in enumerate(batch.columns) if i != at]
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(value)], names=[*names, "score"])

    return score


def score(docs: DataFrame, model: tuple[tuple, np.ndarray]) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row of ``docs``."""
    terms, weights = model
    out = docs.select("doc_id", "text").mapInArrow(_score(terms, weights), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def _reject(terms: tuple, weights: np.ndarray):
    def reject(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = _lexicon(terms)
        for batch in batches:
            counts = np.array([hits(t.as_py() or "", lexicon) for t in batch.column("text")]).reshape(-1, 7)
            value = 1 / (1 + np.exp(-np.clip(features(counts) @ weights, -30, 30)))
            yield batch.filter(pa.array(value < THRESHOLD))

    return reject


def reject_toxic(docs: DataFrame, model: tuple[tuple, np.ndarray]) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are not predicted to be toxic."""
    return docs.mapInArrow(_reject(*model), docs.schema)


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    """Contract query: a toxicity score for every whole text of ``documents``."""
    from sideline.llm.common import table

    docs = table(spark, sf_dir, "documents")
    return score(docs, learn(docs, table(spark, sf_dir, "labels")))
