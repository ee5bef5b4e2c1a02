"""Packing: ids against the library's own encoder, gapless sequences, near the lower bound."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from sideline.llm import packing
from sideline.llm.tokens import default_vocabulary, encoder

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def whole():
    t = Tokenizer.from_file(default_vocabulary())
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_ids_are_the_library_s(whole):
    bpe = encoder()
    for text in ("", "  a  b ", "a\n \nb", " lead", "trail ", "x <|endoftext|> y", "it's we're  you'll\t\n x", "naïve ñandú — “q” 中文 🙂", "a b  c",
                 "\n\n a", "1234 56ab", "a\x1cb \x1d c", "é" * 50, "a " * 100):
        assert np.frombuffer(bpe.encode(text), bpe.dtype).tolist() == whole(text), text


def _check(rows, out, whole, capacity):
    ids = defaultdict(list)
    for doc_id, text in rows:
        ids[doc_id].append(whole(text or "") + [packing.SEPARATOR])
    got, at = defaultdict(int), defaultdict(list)
    for r in out:
        assert any(zlib.crc32(np.array(x[r.start: r.start + r.length], "<u4").tobytes()) == r.ids_crc32 and r.start + r.length <= len(x) for x in ids[r.doc_id])
        assert r.length == capacity or r.piece == 0
        got[r.doc_id] += r.length
        at[r.sequence_id].append((r.offset, r.length))
    assert got == {d: sum(map(len, x)) for d, x in ids.items()}
    for places in at.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(at), -(-sum(got.values()) // capacity)


def test_pieces_and_places(spark, whole):
    """Nulls, empty and long texts, repeated rows and a null id; every id is packed once."""
    rows = [(i, "word %d " % i * (i * 7 % 90)) for i in range(150)] + [(None, "x y"), (7, None), (8, ""), (9, "long " * 3000), (9, "long " * 3000)]
    out = packing.pack(packing.pieces(spark.createDataFrame(rows, SCHEMA), 64), 64).collect()
    used, least = _check(rows, out, whole, 64)
    assert used <= least * 1.03 + 2


def test_empty_table(spark):
    assert packing.pack(packing.pieces(spark.createDataFrame([], SCHEMA))).collect() == []


def test_plan_holds_every_piece_and_is_near_the_bound():
    rng = np.random.default_rng(0)
    for draw in (rng.integers(1, 1025, 5000), rng.geometric(0.01, 5000).clip(1, 1024), np.full(999, 600), np.full(10, 1024), np.array([1])):
        histogram = np.bincount(draw, minlength=1025)
        patterns = packing.plan(histogram)
        held = np.zeros(1025, np.int64)
        for lengths, count in patterns:
            assert sum(lengths) <= 1024 and count > 0
            for x in lengths:
                held[x] += count
        assert (held == histogram).all()
        used = sum(c for _, c in patterns)
        assert used <= max(-(-draw.sum() // 1024) * 1.01 + 1, (draw > 512).sum())


def test_non_negative_least_squares_finds_an_exact_mixture():
    patterns = np.array([[3, 5, 0], [4, 4, 0], [2, 2, 4]])
    x = packing.non_negative_least_squares(patterns, np.bincount([3] * 10 + [5] * 10 + [4] * 9 + [2] * 10, minlength=9).astype(float), 2000)
    assert np.allclose(x, [10, 2, 5], atol=0.1)


def test_residuals_are_packed_best_fit():
    histogram = np.bincount([6, 5, 5, 4, 3, 2, 2], minlength=11)
    assert sum(c for _, c in packing.best_fit_decreasing(histogram, 10)) == 3


def test_a_task_holds_few_documents_and_words_at_once(monkeypatch):
    """Outputs are of at most ``ROWS`` documents however long Spark's batches are; an encoder remembers at most its limits."""
    import pyarrow as pa

    from sideline.llm import tokens

    monkeypatch.setattr(packing, "TaskContext", type("Here", (), {"get": staticmethod(lambda: type("Task", (), {"partitionId": lambda self: 3})())}))
    n = 3 * packing.ROWS + 5
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(n)), "text": [f"w{i} x" for i in range(n)]})
    out = list(packing._cut(64, packing.SEPARATOR, None)(iter([batch])))
    assert max(b.num_rows for b in out) <= packing.ROWS
    assert [x for b in out for x in b.column("doc_id").to_pylist()] == list(range(n))
    monkeypatch.setattr(tokens, "WORDS", 2)
    monkeypatch.setattr(tokens, "PIECES", 3)
    small = tokens.ByteBpe(default_vocabulary())
    text = "one two three four, five's six7 " * 3 + "one"
    assert small.encode(text) == encoder().encode(text) == small.encode(text)
    assert len(small._behind.__self__) == 2 and len(small._piece.__self__) == 3


def test_a_known_text_is_split_as_the_library_does(whole):
    """Every character below U+0250 beside words, spaces, digits and signs, and random mixtures of them."""
    import random

    bpe, rnd = encoder(), random.Random(5)
    for c in map(chr, range(0x250)):
        text = f"a{c}b {c}{c} {c}1  {c} '{c}s {c}"
        assert np.frombuffer(bpe.encode(text), bpe.dtype).tolist() == whole(text), hex(ord(c))
    letters = ["a", "Z", " ", "  ", "\n", "\t", "'", "'s", "'ll", "'re", "1", ".", ",", "é", "ß", "²", "\x1c", "\x85", "\xa0", "ǅ", "¼"]
    for _ in range(500):
        text = "".join(rnd.choices(letters, k=30))
        assert np.frombuffer(bpe.encode(text), bpe.dtype).tolist() == whole(text), repr(text)


def test_a_long_text_is_split_part_by_part(whole, monkeypatch):
    """The pieces of a long text are never all in memory; parts end where the pattern splits anyway."""
    import tracemalloc

    from sideline.llm import tokens

    bpe, text = encoder(), "one two, three's  four\n five 66 " * 300
    monkeypatch.setattr(tokens, "SPAN", 50)
    assert np.frombuffer(bpe.encode(text), bpe.dtype).tolist() == whole(text)
    monkeypatch.undo()
    text = "one two " * 500_000
    tracemalloc.start()
    try:
        bpe.encode(text)
        assert tracemalloc.get_traced_memory()[1] < 20e6
    finally:
        tracemalloc.stop()


def test_words_and_signs_are_remembered_apart():
    """A word with a sign behind it is not remembered beside the word: so many more words find room in less."""
    from sideline.llm import tokens

    bpe = tokens.ByteBpe(default_vocabulary())
    bpe.encode("".join(f" word{c}" for c in ".,;:!?") + " word")
    assert len(bpe._behind.__self__) + len(bpe._piece.__self__) < 15 and tokens.PIECES + tokens.WORDS < 350_000
