"""SentencePiece: ids against the library's own encoder, round trips."""

import random

import numpy as np
import pytest
import sentencepiece

from sideline.llm import sentence_pieces

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def own():
    return sentencepiece.SentencePieceProcessor(model_file=sentence_pieces.default_model())


def test_ids_are_the_library_s(own):
    m = sentence_pieces.model()
    rnd = random.Random(3)
    pieces = [own.id_to_piece(i).replace("▁", " ") for i in range(261, 31999)]
    texts = ["  a  b\n\tc ", "", "   ", " " * 33 + "x", " " * 15 + "中 文", "a▁b", "naïve ＡＢ é é “q”  \n\n x", "<s> <0x41>", "a\x00b", "x" * 5000]
    texts += ["".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 30))) for _ in range(1500)]
    texts += ["".join(rnd.choice("abcdeinrstou   éñ中Ａ🙂") for _ in range(rnd.randint(1, 60))) for _ in range(1500)]
    for text, ids in zip(texts, m.encode(texts), strict=True):
        assert np.frombuffer(ids, m.dtype).tolist() == own.encode(text), text
        assert m.decode(ids) == text.replace("▁", " ")


def test_occurrences_are_all():
    m = sentence_pieces.model()
    text = "▁banana▁bandana"
    place, piece = m.occurrences(np.array([m.letter[ord(c)] for c in text]))
    want = {(i, p) for i in range(len(text)) for p in m.pieces if text.startswith(p, i)}
    assert {(int(i), m.pieces[k]) for i, k in zip(place, piece, strict=True)} == want


def test_rows(spark, own):
    rows = [(1, "Hello world", 1), (2, None, 2), (3, "", 3), (None, "x", 4), (1, "Hello world", 1), (4, "lang " * 100_000, 5), (5, "z" * 20_000, 6)]
    out = sentence_pieces.encode_pieces(spark.createDataFrame(rows, SCHEMA + ", ids int"))
    found = sorted(((r.doc_id, r.n_ids, r.ids, r.round_trip) for r in out.collect()), key=str)
    assert found == sorted(((d, len(own.encode(t or "")), own.encode(t or ""), True) for d, t, _ in rows), key=str)
    back = sentence_pieces.decode_pieces(out.select("doc_id", "ids"))
    assert sorted((tuple(r) for r in back.collect()), key=str) == sorted(((d, t or "") for d, t, _ in rows), key=str)
    assert sentence_pieces.encode_pieces(spark.createDataFrame([], SCHEMA)).collect() == []


def test_null_ids_decode_to_null(spark):
    assert sentence_pieces.decode_pieces(spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")).orderBy("doc_id").collect()[0].text is None
