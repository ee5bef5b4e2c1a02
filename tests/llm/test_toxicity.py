"""Toxicity: the automaton against edit distance, contexts, held-out accuracy."""

import random

import numpy as np
import pytest

from conftest import SF01
from sideline.llm import toxicity
from sideline.llm.common import table

SCHEMA = "doc_id long, text string"


def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def test_automaton_is_edit_distance():
    """One edit of a term of five letters or more, but the first letter stays."""
    rnd = random.Random(0)
    terms = ["idiot", "trash", "scum", "loser", "moron"]
    lexicon = toxicity.FuzzyLexicon(terms)
    for _ in range(20_000):
        word = list(rnd.choice(terms))
        for _ in range(rnd.randint(0, 2)):
            k = rnd.randrange(len(word) + 1)
            word[k:k + rnd.randint(0, 1)] = rnd.choice(["", "x", "o", "r"])
        word = "".join(word)
        want = 1 if word in terms else 2 if any(len(t) >= 5 and word[:1] == t[0] and _edits(word, t) == 1 for t in terms) else 0
        assert lexicon.find(word) == want, word


def test_beginnings_and_weak_terms():
    lexicon = toxicity.FuzzyLexicon(["lowei*", "idiot"], ["achlich*", "bad"])
    assert [lexicon.find(w) for w in ("loweix", "lowei", "lowe", "achlichst", "bad", "badx", "\"idiot!\"", "idi0t")] == [1, 1, 0, 3, 3, 0, 1, 2]


def test_loose_matches():
    """A wide lexicon's near forms beyond those of a narrow one; what matched before matches alike."""
    terms, weak = ["idiot", "stupid", "scum", "lowei*", "achlich*", "worm*"], ["bomente*"]
    wide, narrow = toxicity.FuzzyLexicon(terms, weak, True), toxicity.FuzzyLexicon(terms, weak)
    loose = ["1diot", "ztupid", "diot", "sc0m", "5cum", "achl1chst", "achlch", "axchlich", "chlichst", "bchlichst", "lxweix", "lowxei"]
    assert [(w, wide.find(w), narrow.find(w)) for w in loose] == [(w, 4, 0) for w in loose]
    for w in ("idiot", "idi0t", "stupd", "achlichst", "bomentex", "scum", "lowei"):
        assert wide.find(w) == narrow.find(w) > 0, w
    for w in ("bomxnte", "scam", "warms", "lowex", "zdiott", "xxiot", "fine", "", "lowe", "xidiot", "sc00", "7"):
        assert wide.find(w) == narrow.find(w) == 0, w
    assert toxicity.hits("a ztupid 1diot", wide)[5] == 2 and toxicity.features(np.array([toxicity.hits("a ztupid", wide)]))[0, 1] == 0


def test_wide_automaton_finds_first_letters_edited():
    """Against edit distance: a first letter that is another one or missing, and edits before the end of a beginning."""
    rnd = random.Random(3)
    terms, begin = ["idiot", "trash", "loser", "moron"], "achlich"
    wide, narrow = toxicity.FuzzyLexicon([*terms, begin + "*"], (), True), toxicity.FuzzyLexicon([*terms, begin + "*"])
    for _ in range(5_000):
        t = rnd.choice(terms)
        word = rnd.choice("xzq70é") * rnd.randint(0, 1) + t[1:]
        assert wide.find(word) == 4 and narrow.find(word) == 0, word
        k = rnd.randrange(len(begin) - 1)
        near = begin[:k] + rnd.choice(["", "x", "0"]) + begin[k + 1:] + rnd.choice(["", "st", "keit"])
        assert wide.find(near) == 4 and narrow.find(near) == 0, near


def test_loose_hits_have_a_weight_of_their_own():
    """Where misspelled terms part toxic texts, they are learned to."""
    lexicon = toxicity.FuzzyLexicon(toxicity.INSULTS, (), True)
    texts = [("what a ztupid 1diot they are, sc0m", 1)] * 40 + [("what a fine day it is today", 0)] * 100
    x = toxicity.features(np.array([toxicity.hits(t, lexicon) for t, _ in texts]))
    weights = toxicity.fit(x, np.array([y for _, y in texts], float))
    found = 1 / (1 + np.exp(-x @ weights)) >= toxicity.THRESHOLD
    assert found.tolist() == [y == 1 for _, y in texts]


def test_contexts():
    lexicon = toxicity.FuzzyLexicon(toxicity.INSULTS)
    assert toxicity.hits("you are an idiot and a m0ron", lexicon)[:4] == (1, 1, 0, 2)
    assert toxicity.hits('he used the "idiot" there', lexicon)[:4] == (0, 0, 1, 0)
    assert toxicity.hits("the word idiot was said in court", lexicon)[:4] == (0, 0, 1, 0)
    assert toxicity.hits("", lexicon)[:4] == (0, 0, 0, 0)


def test_quotation_scores_below_abuse(spark):
    rows = [(1, "what a stupid worthless loser you are"), (2, 'the word "stupid" was quoted in the report'), (3, "a fine day"), (4, None), (5, ""),
            (6, "what a stup1d worthles los3r you are"), (None, "fine"), (3, "a fine day"), (7, "fine " * 200_000 + "idiot scum moron trash")]
    out = toxicity.score(spark.createDataFrame(rows, SCHEMA), ((toxicity.INSULTS, ()), toxicity.FIXED)).collect()
    by = {r.doc_id: r for r in out}
    assert len(out) == len(rows) and by[1].predicted == by[6].predicted == by[7].predicted == 1
    assert [by[k].predicted for k in (2, 3, 4, 5, None)] == [0] * 5
    assert by[None].held_out is False and by[4].score == by[5].score == by[3].score
    assert all(0 <= r.score <= 1 for r in out)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "x")], SCHEMA)
    for labels in ([], [(1, None)], [(None, 1)], [(99, 1)]):
        terms, weights = toxicity.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert terms == (toxicity.INSULTS, ()) and (weights == toxicity.FIXED).all()
    empty = spark.createDataFrame([], SCHEMA)
    assert toxicity.score(empty, (terms, weights)).collect() == []


def test_copies_of_one_text_bring_no_ordinary_words():
    presence = [(1, {"bad*", "plain"})] * 50 + [(1, {"bad*", f"x{i}"}) for i in range(50)] + [(0, {f"x{i}"}) for i in range(300)]
    assert toxicity.choose(presence, ["bad*", "plain"]) == (["bad*"], [])


@pytest.mark.parametrize("changed", [False, True])
def test_copies_of_a_long_text_leave_the_stems_of_others(spark, changed):
    """A third of the toxic rows are one long text (or that with one word changed); rarer stems are learned all the same."""
    rnd = random.Random(2)

    def plain(n):
        return [f"{rnd.randrange(10**6):06d}" for _ in range(n)]

    long = " ".join("".join(rnd.choice("abcdefgh") for _ in range(9)) for _ in range(2500))
    families = ["achlich", "bomente", "qurreux", "wixxont", "zuldrak", "yopfern"]
    toxic = [" ".join([*plain(20), f + "xyz"[k % 3] * (k % 4)]) for f in families for k in range(24)]
    toxic += [f"{long} {plain(1)[0] if changed else ''}" for _ in range(72)]
    rows = [(k, t, 1) for k, t in enumerate(toxic)] + [(1000 + k, " ".join(plain(20)), 0) for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    (strong, weak, *_), _ = toxicity.learn(df.drop("toxic"), df.drop("text"))
    assert [f for f in families if not any(t.startswith(f[:4]) for t in (*strong, *weak))] == []


def test_held_out_accuracy(spark):
    """Learned on two thirds of the labels, judged on the others."""
    docs, labels = table(spark, SF01, "documents"), table(spark, SF01, "labels")
    scored = toxicity.score(docs, toxicity.learn(docs, labels)).where("held_out").join(labels.select("doc_id", "toxic"), "doc_id").collect()
    toxic = [r.predicted for r in scored if r.toxic == 1]
    clean = [r.predicted for r in scored if r.toxic == 0]
    assert np.mean(toxic) >= 0.7 and np.mean(clean) <= 0.01


def test_extra_columns(spark):
    df = spark.createDataFrame([(1, "idiot idiot scum", 0.5, "x"), (2, "fine", None, None)], "doc_id long, text string, score double, held_out string")
    model = ((toxicity.INSULTS, ()), toxicity.FIXED)
    assert [r.doc_id for r in toxicity.reject_toxic(df, model).collect()] == [2]
    assert sorted(r.predicted for r in toxicity.score(df, model).collect()) == [0, 1]


@pytest.mark.parametrize("value,held", [(1, None), (2, None)])
def test_held_out_is_crc32(spark, value, held):
    import zlib

    df = spark.createDataFrame([(value, "x")], SCHEMA)
    row = toxicity.score(df, ((toxicity.INSULTS, ()), toxicity.FIXED)).collect()[0]
    assert row.held_out == (zlib.crc32(str(value).encode()) % 3 == 1)
