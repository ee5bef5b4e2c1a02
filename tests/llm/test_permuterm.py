"""Spelling variants against a comparison of all words."""

import random
import re
import zlib
from collections import Counter

import pytest

from sideline.llm import permuterm as P

SCHEMA = "doc_id long, text string, word string, id int, key string"


def _near(a, b):
    """One replaced, inserted or deleted code point, letter by letter."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    return a[k + (len(a) >= len(b)):] == b[k + (len(b) >= len(a)):]


def _brute(rows):
    count = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}
    near = {w: [v for v in words if _near(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), words[w], len(near[w]), form[w] and words[form[w]]) for w in words)


def _rows():
    rnd = random.Random(5)
    stems = ["".join(rnd.choice("abÀÿ") for _ in range(rnd.randint(5, 8))) for _ in range(60)] + ["aaaaaa", "aaaaa", "aaaaaaa", "aabbaa", "ababab", "×÷×÷×"]
    long = "".join(rnd.choice("abc") for _ in range(90))
    stems += [long, long[:40] + "d" + long[40:], long[:40] + "x" + long[41:], long[:-1], "z" * 64, "z" * 65, "z" * 66, "z" * 63 + "y"]
    rows = []
    for k in range(300):
        some = [rnd.choice(stems) if rnd.random() < 0.7 else rnd.choice(stems[:6]) for _ in range(60)]
        some = [w.upper() if rnd.random() < 0.1 and w.isascii() else w for w in some]
        rows.append((k, rnd.choice([" ", "-", "\n", "4"]).join(some)))
    return rows + [(900, None), (901, ""), (None, "null doc words null doc words aaaaaa"), (902, "short abcd four"), (903, "aaaaab " * 50_000), rows[0], rows[0], (904, "q" * 3000), (905, "q" * 3000), (906, "q" * 2999 + " " + "q" * 3000)]


@pytest.mark.parametrize("batch", [None, "7"])
def test_words_forms_roots(spark, monkeypatch, batch):
    """Small batches cut groups; pieces and passed-on counts are small too."""
    monkeypatch.setattr(P, "PIECE", 1000)
    monkeypatch.setattr(P, "HELD", 20)
    rows = _rows()
    if batch:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        rows = rows[:80]
    try:
        found = P.spelling_groups(spark.createDataFrame([(*r, "clash", 1, "k") for r in rows], SCHEMA))
        assert sorted((tuple(r) for r in found.collect())) == _brute(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_long_words_as_digests(spark):
    """With digests from six code points on the result is the same."""
    rows = _rows()[:150]
    found = P.spelling_groups(spark.createDataFrame([(*r, "clash", 1, "k") for r in rows], SCHEMA), long=6)
    assert sorted((tuple(r) for r in found.collect())) == _brute(rows)


def test_nothing(spark):
    assert P.spelling_groups(spark.createDataFrame([], SCHEMA)).collect() == []
    assert P.spelling_groups(spark.createDataFrame([(1, None, None, None, None), (2, "a b", None, None, None)], SCHEMA)).collect() == []


def test_pieces_cut_no_run(monkeypatch):
    monkeypatch.setattr(P, "PIECE", 4)
    text = "abcdefgh ij,klmnop"
    assert [w for p in P._pieces(text) for w in P.RUN.findall(p)] == P.RUN.findall(text)
