"""The pipeline against a brute-force version of its stages."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from conftest import SF001
from sideline.llm import near_dedup, toxicity
from sideline.llm.common import table
from sideline.llm.tokens import default_vocabulary


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A few given documents with a planted toxic text, near copies, a shared passage, nulls and an extra column."""
    path = tmp_path_factory.mktemp("pipeline")
    rnd = random.Random(1)
    rows = [tuple(r) for r in table(spark, SF001, "documents").select("doc_id", "text", "lang", "source", "n_chars").orderBy("doc_id").limit(70).collect()]
    prose = [" ".join(f"w{rnd.randrange(5000)}" for _ in range(120)) for _ in range(3)]
    near = prose[0].split()
    near[60] = "changed"
    apart = [" ".join(f"v{rnd.randrange(5000)}" for _ in range(400)) for _ in range(2)]
    extra = [prose[0], " ".join(near), apart[0] + " " + prose[1], prose[1] + " " + apart[1], "you stupid worthless loser, you idiot clown " * 3, None, "", "é" * 150 + prose[2]]
    rows += [(1000 + k, t, "en", None, None if t is None else len(t)) for k, t in enumerate(extra)] + [(None, "no id", None, None, 5)]
    rows += [rows[3]]
    spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long, row int").write.parquet(str(path / "documents.parquet"))
    table(spark, SF001, "labels").write.parquet(str(path / "labels.parquet"))
    return str(path)


def test_run_matches_brute_force(spark, folder):
    docs = table(spark, folder, "documents")
    terms, weights = toxicity.learn(docs, table(spark, folder, "labels"))
    lexicon = toxicity.FuzzyLexicon(*terms)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows = [(d, t) for d, t in rows if 1 / (1 + np.exp(-(toxicity.features(np.array([toxicity.hits(t or "", lexicon)])) @ weights)[0])) < toxicity.THRESHOLD]
    assert 1004 not in {d for d, _ in rows} and len(rows) > 60
    kept = [(d, t) for (d, t), (_, _, _, k) in zip(rows, near_dedup.brute_force(rows, 5, 80), strict=True) if k]
    kept = list(dict.fromkeys(kept))
    assert 1001 not in {d for d, _ in kept}
    texts = _cut([(t or "").encode() for _, t in kept])
    at = [d for d, _ in kept].index(1002)
    assert len(texts[at]) < len(kept[at][1]) - 200
    bpe = Tokenizer.from_file(default_vocabulary())
    bpe.encode_special_tokens = True
    want = []
    for (d, _), text in zip(kept, texts, strict=True):
        ids = bpe.encode(text, add_special_tokens=False).ids + [2]
        first = len(ids) % 1024 or 1024
        edges = [0, *range(first, len(ids) + 1, 1024)]
        want += [(d, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(edges, edges[1:]))]
    found = corpus_pipeline.run(spark, folder).collect()
    assert sorted((tuple(r)[:5] for r in found), key=str) == sorted(want, key=str)
    ends = {}
    for r in sorted(found, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 1024


def _cut(corpus):
    count = {}
    for t in corpus:
        for i in range(len(t) - 199):
            count[t[i: i + 200]] = count.get(t[i: i + 200], 0) + 1
    out = []
    for t in corpus:
        gone = bytearray(len(t))
        for i in range(len(t) - 199):
            if count[t[i: i + 200]] > 1:
                gone[i: i + 200] = b"\1" * 200
        out.append(bytes(b for b, g in zip(t, gone, strict=True) if not g).decode("utf-8", "ignore"))
    return out


def test_stages_return_the_columns_of_documents(spark, folder):
    docs = table(spark, folder, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.dtypes == docs.dtypes


def test_stages_on_an_empty_table(spark, folder):
    empty = table(spark, folder, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).collect() == []


def test_registered():
    names = __spark_entry__.queries()
    assert {f"op{n}_" for n in range(1, 11)} <= {n.split("_")[0] + "_" for n in names if n.startswith("op")} and "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "suffix_dedup", "packing"]


def test_clashing_columns(spark, folder):
    """Names that operators and stages use themselves are columns like others."""
    docs = table(spark, folder, "documents")
    names = ["_stay_id", "_stay_key", "stay_id", "id", "key", "row_", "kept", "score", "toxic", "sketch", "rep", "ranges", "letters", "rows", "n_bytes"]
    clash = docs.withColumns({c: F.lit(c) for c in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, clash, folder)
        assert out.columns == clash.columns, name
        plain = stage(spark, docs, folder)
        assert sorted(map(tuple, out.select(docs.columns).collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
        assert out.where(F.col("_stay_id") != "_stay_id").isEmpty()
    assert corpus_pipeline.packing_stage(spark, clash, folder).count() == corpus_pipeline.packing_stage(spark, docs, folder).count()


def test_a_task_of_a_stage_needs_one_python_worker(spark, folder):
    """Two Python functions in one task take two workers of each core, which stay with the executor for the stages behind."""
    docs = table(spark, folder, "documents")
    plan = corpus_pipeline.suffix_dedup_stage(spark, docs, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow apply" in plan and plan.index("MapInArrow apply") == plan.index("MapInArrow")
