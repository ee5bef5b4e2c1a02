"""Quality rules and host verdicts against a plain version."""

import random
import re
from collections import Counter

import pytest

from sideline.llm import host_rules as H

SCHEMA = "doc_id long, text string, source string, host string, n_words string, row int"


def _measures(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = list(zip(*(w[k:] for k in range(5))))
    seen = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), len(lines))


def _failed(m):
    n, chars, symbols, dup, rep, lines = m
    return (n < 10, 100 * rep > 20 * n, 10 * symbols > n, 100 * dup > 30 * lines, chars < 3 * n or chars > 10 * n)


def _brute(rows, limit=0.5):
    held = [(d, s, _measures(t), _failed(_measures(t))) for d, t, s in rows]
    hosts = {}
    for _, s, _, f in held:
        if s is not None:
            hosts.setdefault(s, []).append(f)
    bad = set()
    docs = sum(len(v) for v in hosts.values())
    for rule in range(5):
        n = {h: len(v) for h, v in hosts.items()}
        f = {h: sum(x[rule] for x in v) for h, v in hosts.items()}
        if not docs:
            continue
        mean = sum(f.values()) / docs
        between = sum(n[h] * (f[h] / n[h] - mean) ** 2 for h in hosts)
        room = docs - sum(x * x for x in n.values()) / docs - (len(hosts) - 1)
        alike = (between / (mean * (1 - mean)) - (len(hosts) - 1)) / room if 0 < mean < 1 and room > 0 else 0
        weight = max(0, 1 / alike - 1) if alike > 0 else None
        bad |= {h for h in hosts if (mean if weight is None else (f[h] + mean * weight) / (n[h] + weight)) >= limit}
    return sorted(((d, *m[:5], f[0] or f[1], not (f[0] or f[1]) and s not in bad) for d, s, m, f in held), key=str), bad


def _rows():
    rnd = random.Random(3)
    prose = lambda n: " ".join("".join(rnd.choice("abcdefghé") for _ in range(rnd.randint(3, 8))) for _ in range(n))
    rows = [(k, prose(40), f"good{k % 5}") for k in range(120)]
    rows += [(200 + k, prose(40) + " # % & $ < >" if k % 8 else prose(40), "noisy") for k in range(60)]  # rejected by its host
    rows += [(300, prose(30) + " # % & $ <", "one"), (301, prose(4), "one-short")]
    line = prose(12)
    rows += [(400, f"{line}\n{line}\n\n \t\n{line}x\n{line}", "good1"), (401, prose(3) + "\x0b\x0c\r\n\t" + prose(3), None), (402, None, "good2"), (403, "", None),
             (404, " \n\t ", "good0"), (None, prose(20), "good3"), (405, "é ü " * 30, ""), (406, (prose(9) + "\n") * 3000 + prose(60000), "good4")]
    rows += [rows[0], rows[0]]
    return rows


@pytest.mark.parametrize("list_bytes", [0, 1 << 20])
def test_rules_and_hosts(spark, list_bytes):
    rows = _rows()
    df = spark.createDataFrame([(d, t, s, "clash", "x", 1) for d, t, s in rows], SCHEMA)
    out = H.with_verdicts(H.measured(df), list_bytes=list_bytes)
    found = sorted((tuple(r) for r in out.select("doc_id", *H.MEASURES[:5], "base_failed", "kept").collect()), key=str)
    want, bad = _brute(rows)
    assert found == want
    assert "noisy" in bad and not bad & {"good0", "good1", "good2", "good3", "good4"}


def test_kept_documents_have_all_columns(spark):
    rows = _rows()
    df = spark.createDataFrame([(d, t, s, "clash", "x", 1) for d, t, s in rows], SCHEMA)
    out = H.keep_documents(df)
    assert out.columns == df.columns
    want, _ = _brute(rows)
    assert sorted((r.doc_id for r in out.collect()), key=str) == sorted((r[0] for r in want if r[-1]), key=str)


def test_empty_and_hostless(spark):
    assert H.keep_documents(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, "w " * 12, None, None, None, 0), (2, " ".join(f"word{k}" for k in range(12)), None, None, None, 0)]
    assert [r.doc_id for r in H.keep_documents(spark.createDataFrame(rows, SCHEMA)).collect()] == [2]


def test_prior_shrinks_little_hosts_more():
    mean, weight = H.prior(3, 210, 100 * 100 + 100 * 100 + 100, 100, 60 * 60 / 100 + 35 * 35 / 100 + 25 / 10)
    assert mean == 100 / 210 and 9 < weight < 10
    assert H.prior(0, 0, 0, 0, 0.0) == (0.0, None)
    assert H.prior(5, 5, 5, 2, 2.0) == (0.4, None)  # a document each: nothing is known about hosts


def test_host_of(spark):
    urls = ["https://www.Example.org/a?b", "http://u@x.y:80/", "ftp://a-b.c#d", "no address", None]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r[0] for r in df.select(H.host_of("u")).collect()] == ["example.org", "x.y", "a-b.c", None, None]
