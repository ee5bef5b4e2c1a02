"""Near-duplicates against all pairs."""

import random

import numpy as np
import pytest

from sideline.llm import near_dedup
from sideline.llm.words import shingle_sets, word_hashes

SCHEMA = "doc_id long, text string"


def _rows(seed):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdé") for _ in range(rnd.randint(2, 7))) for _ in range(300)]

    def prose(n):
        return [rnd.choice(vocabulary) for _ in range(n)]

    base, rows = prose(150), []
    for i in range(60):
        near = list(base)
        for _ in range(rnd.randint(0, 8)):
            near[rnd.randrange(len(near))] = rnd.choice(vocabulary)
        rows.append((i * 3, [" ".join(prose(rnd.randint(1, 400))), " ".join(near), " ".join(near[:140]).upper(),
                             rows[rnd.randrange(len(rows))][1] if rows else "", ["", " ", "one", "one two", "ONE  two\n"][i % 5], None][i % 6]))
    return rows + [(None, rows[0][1]), (3, rows[3][1]), (5, " ".join(base)), (5, "zzz yyy xxx www")]


@pytest.mark.parametrize("shingle,percent", [(3, 85), (5, 80)])
def test_matches_brute_force(spark, shingle, percent):
    """Near copies, upper case, nulls, repeated ids and texts of fewer words than a shingle."""
    rows = _rows(2)
    found = sorted((tuple(r) for r in near_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA), shingle, percent).drop("key").collect()), key=str)
    assert found == sorted(near_dedup.brute_force(rows, shingle, percent), key=str)


def test_chain_and_group_of_near_copies(spark):
    """Members that the hub does not reach join through others; a chain is one component."""
    rnd = random.Random(9)
    rows, text = [], [f"w{i}" for i in range(120)]
    for i in range(40):
        rows.append((i, " ".join(text)))
        for _ in range(2):
            text[rnd.randrange(len(text))] = f"n{i}_{rnd.random()}"
    found = sorted(tuple(r) for r in near_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA), 3, 85).drop("key").collect())
    assert found == sorted(near_dedup.brute_force(rows, 3, 85))


def test_empty_table_and_extra_columns(spark):
    assert near_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    df = spark.createDataFrame([(1, "a b c d e f", 1, "x"), (2, "a b c d e f", 2, "y")], "doc_id long, text string, rep int, component string")
    assert [(r.doc_id, r.component_id, r.kept) for r in near_dedup.near_duplicates(df).orderBy("doc_id").collect()] == [(1, 1, True), (2, 1, False)]


def test_sketch_agrees_as_often_as_sets_and_merges():
    rng = np.random.default_rng(1)
    shared, a, b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (800, 100, 100))
    x, y = np.unique(np.concatenate([shared, a])), np.unique(np.concatenate([shared, b]))
    both = np.unique(np.concatenate([x, y]))
    sets, ends = np.concatenate([x, y, both]), np.cumsum([0, len(x), len(y), len(both)])
    s = near_dedup.sketches(sets, ends, 4096)
    assert abs((s[0] == s[1]).mean() - 0.8) < 0.03
    assert (np.maximum(s[0], s[1]) == s[2]).all()  # the smaller point has the larger register


def test_tiny_sets_have_full_sketches():
    s = near_dedup.sketches(np.array([5, 9, 11], np.uint64), np.array([0, 1, 1, 3]), 180)
    assert (s[0] > 0).all() and (s[1] == 0).all() and (s[2] > 0).all()


def test_shingles_of_whole_texts():
    data = np.frombuffer("A b\tC d".encode() + b"x" + b"p q r", np.uint8)
    sets, ends = shingle_sets(data, np.array([0, 7, 8, 13]), 3)
    assert np.diff(ends).tolist() == [2, 1, 1]


def test_likelihood_keeps_pairs_at_the_threshold():
    rng = np.random.default_rng(3)
    dropped = 0
    for _ in range(200):
        draw = rng.choice(3, 180, p=[0.85, 0.075, 0.075])
        x = np.full((1, 180), 500, np.uint16)
        y = x + (draw == 1).astype(np.uint16) - (draw == 2).astype(np.uint16)
        dropped += not near_dedup.plausible(x, y, np.array([300.0]), np.array([300.0]), 85)[0]
    assert dropped == 0
    far = np.arange(180, dtype=np.uint16)[None] * 7
    assert not near_dedup.plausible(far, far[:, ::-1], np.array([300.0]), np.array([300.0]), 85)[0]


def test_words_made_to_collide(spark):
    """Thue-Morse words have equal sums of powers; they are different words all the same."""
    def thue_morse(a, b, n):
        return "".join(a if bin(k).count("1") % 2 == 0 else b for k in range(n))

    rest = " ".join(f"w{k}" for k in range(30))
    for n in (32, 64, 1024, 4096):
        rows = [(1, f"{thue_morse('a', 'b', n)} x y"), (2, f"{thue_morse('b', 'a', n)} x y"), (3, rest), (4, rest + " w29")]
        found = sorted(tuple(r) for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).drop("key").collect())
        assert found == near_dedup.brute_force(rows, 3, 85)


def test_word_hashes_depend_on_bytes_only():
    rnd = random.Random(8)
    words = ["".join(rnd.choice("ab") for _ in range(n)) for n in (1, 7, 8, 9, 15, 16, 17, 63, 64, 65, 200) for _ in range(3)]
    hashes = {}
    for sep in (" ", "\n\n  "):
        text = (sep.join(words) + sep).encode()
        h, owner = word_hashes(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        assert len(h) == len(words) and not owner.any()
        for w, x in zip(words, h.tolist(), strict=True):
            assert hashes.setdefault(w, x) == x
    assert len(set(hashes.values())) == len(hashes)
