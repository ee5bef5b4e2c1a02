"""Token counts: flat files, blocks that cut documents, unfinished ends."""

import numpy as np
import pytest
from tokenizers import Tokenizer

from sideline.llm import token_counts
from sideline.llm.tokens import default_vocabulary

SCHEMA = "doc_id long, text string"


@pytest.mark.parametrize(("block_ids", "span"), [(1, 2), (1, 1024), (3, 1), (3, 3), (7, 2), (1000, 1024)])
def test_flat_files(spark, tmp_path, block_ids, span):
    """Documents longer than many blocks, empty ones, an unfinished one, an empty file and half an id at the end."""
    end = 9
    files = {"a.bin": [[1, 2], [], [3] * 50, [4]], "b.bin": [[5] * 8], "c.bin": []}
    for name, docs in files.items():
        flat = [x for d in docs for x in (*d, end)]
        (tmp_path / name).write_bytes(np.array(flat, "<u2").tobytes())
    (tmp_path / "d.bin").write_bytes(np.array([1, end, 2, 2], "<u2").tobytes() + b"\1")
    files["d.bin"] = [[1], [2, 2]]
    found = {}
    for r in token_counts.count_tokens(token_counts.read_token_files(spark, str(tmp_path), 2, block_ids), end, 2, span).collect():
        found.setdefault(r.file.rsplit("/", 1)[1], {})[r.nth] = r.n_tokens
    assert found == {n: {k: len(d) for k, d in enumerate(docs)} for n, docs in files.items() if docs}


def test_counts_are_the_library_s(spark):
    t = Tokenizer.from_file(default_vocabulary())
    t.encode_special_tokens = True
    rows = [(i, "naïve words, %d " % i * (i % 13)) for i in range(60)] + [(None, "x"), (3, None), (4, "<|endoftext|> not a separator"), (5, "a" * 30_000), (5, "a" * 30_000)]
    blocks, names = token_counts.token_blocks(spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", nth int"), block_ids=64)
    out = names.join(token_counts.count_tokens(blocks), ["file", "nth"], "left").select("doc_id", "n_tokens").collect()
    want = [(d, len(t.encode(x or "", add_special_tokens=False).ids)) for d, x in rows]
    assert sorted((tuple(r) for r in out), key=str) == sorted(want, key=str)


def test_empty_table(spark):
    blocks, names = token_counts.token_blocks(spark.createDataFrame([], SCHEMA))
    assert names.collect() == [] and token_counts.count_tokens(blocks).collect() == []
