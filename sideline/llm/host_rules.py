"""Quality rules of documents, and verdicts on hosts from how often their documents fail.

Every whole text is measured once (words, symbols, repeated lines, words in
repeated windows) and held against the ``RULES``.  Then, for each rule:

1. failures are counted for each host (a domain, or whatever ``host`` names);
2. a beta distribution is fitted to the hosts' rates by moments: its mean is
   the rate over all documents, its weight follows from how much hosts differ
   beyond what chance explains (an analysis of variance between hosts);
3. a host's rate is shrunk to that prior, ``(failed + a) / (docs + a + b)``,
   so a host with few documents is judged by what hosts are like, one with
   many by its own;
4. a host whose shrunk rate is ``limit`` or more for any rule is rejected, and
   its verdict is joined back to its documents.

Counting hosts is an aggregate with partial aggregation, so a host with a
third of all rows is one row a task.  Only rejected hosts are joined back:
broadcast while their list is at most ``LIST_BYTES``, else by an equi-join
with each host dealt over ``SALTS`` keys.

Defined results: a null or empty text has no words (all measures 0) and fails
the base rules; rows without a host belong to none, are not counted and have
no host verdict; an empty string is a host like others; repeated rows count
and are returned as often as they are there; a null ``doc_id`` is kept as it
is; hosts that do not differ, or with one document each, are all judged by the
overall rate; an empty table gives an empty result; further columns travel in
the struct ``row`` if asked for and cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sideline.llm.batches import groups
from sideline.llm.common import staged

#: Words in a window that counts as repeated.
WINDOW = 5
#: A host is rejected from this shrunk rate of failures on.
HOST_LIMIT = 0.5
#: The list of rejected hosts is broadcast up to this size; beyond it each host is dealt over so many keys.
LIST_BYTES, SALTS = 8 << 20, 64

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")

#: Rules by name; true is a failure.  The first two are the base rules, which reject the document itself.
RULES = {
    "few_words": "n_words < 10",
    "repeated_words": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "100 * n_dup_lines > 30 * n_lines",
    "word_length": "word_chars < 3 * n_words OR word_chars > 10 * n_words",
}
BASE = ("few_words", "repeated_words")

_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[list(b"#*$%&|<>")] = 1


def _ranked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A number for each pair, equal for equal pairs only."""
    return np.unique(a.astype(np.int64) * (int(b.max(initial=0)) + 1) + b, return_inverse=True)[1]


def _pieces(lists: pa.Array, filled) -> tuple[np.ndarray, pa.Array]:
    """(text index, piece) of the pieces that ``filled`` keeps."""
    text, piece = pc.list_parent_indices(lists), pc.list_flatten(lists)
    on = filled(piece)
    return text.filter(on).to_numpy().astype(np.int64), piece.filter(on)


def measure(texts: pa.Array, data: np.ndarray, offsets: np.ndarray, window: int = WINDOW) -> list[np.ndarray]:
    """The ``MEASURES`` of each text; ``data`` and ``offsets`` are the same texts as bytes."""
    n = len(texts)
    doc, word = _pieces(pc.ascii_split_whitespace(texts), lambda x: pc.greater(pc.binary_length(x), 0))
    n_words = np.bincount(doc, minlength=n)
    chars = np.bincount(doc, weights=pc.utf8_length(word).to_numpy(zero_copy_only=False), minlength=n).astype(np.int64)
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
    # Windows get exact numbers by doubling: of two words, of four, and so on, then the last ones word by word.
    repeats = np.zeros(n, np.int64)
    if len(word) >= window:
        ids = word.dictionary_encode().indices.to_numpy().astype(np.int64)
        number, size = ids, 1
        while 2 * size <= window:
            number, size = _ranked(number[:-size], number[size:]), 2 * size
        while size < window:
            number, size = _ranked(number[:-1], ids[size:]), size + 1
        inside = np.flatnonzero(doc[: len(number)] == doc[window - 1:])
        key = _ranked(doc[inside], number[inside])
        again = inside[np.bincount(key)[key] > 1] if len(key) else inside
        edge = np.zeros(len(ids) + 1, np.int64)
        np.add.at(edge, again, 1)
        np.add.at(edge, again + window, -1)
        repeats = np.bincount(doc[np.cumsum(edge[:-1]) > 0], minlength=n)
    at, line = _pieces(pc.split_pattern(texts, "\n"), lambda x: pc.greater(pc.binary_length(pc.ascii_trim_whitespace(x)), 0))
    n_lines = np.bincount(at, minlength=n)
    seen = np.unique(at * (len(line) + 1) + line.dictionary_encode().indices.to_numpy()) // (len(line) + 1) if len(line) else at
    return [n_words, chars, symbols[offsets[1:]] - symbols[offsets[:-1]], n_lines - np.bincount(seen, minlength=n), repeats, n_lines]


def _scan():
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for part, data, offsets in groups(batch, at):
                found = measure(part.column(at).cast(pa.large_string()).fill_null(""), data, offsets)
                rest = [part.column(i) for i in range(part.num_columns) if i != at]
                names = [f.name for i, f in enumerate(part.schema) if i != at]
                yield pa.RecordBatch.from_arrays([*rest, *(pa.array(x, pa.int64()) for x in found)], names=[*names, *MEASURES])

    return scan


def host_of(url: str | Column) -> Column:
    """The host of a web address in lower case, without a leading ``www.``; null where there is none."""
    url = F.col(url) if isinstance(url, str) else url
    found = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(?:www\.)?([^/?#:]+)", 1)
    return F.when(found != "", found)


def measured(docs: DataFrame, host: str | Column = "source", carry: bool = False) -> DataFrame:
    """(doc_id, host, [row,] the measures, a boolean for each rule, base_failed) of each row, written once."""
    host = F.col(host) if isinstance(host, str) else host
    row = [F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")] if carry else []
    texts = docs.select("doc_id", host.cast("string").alias("host"), *row, F.col("text").cast("string").alias("text"))
    kept = [f for f in texts.schema if f.name != "text"]
    kinds = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in kept] + [f"{m} long" for m in MEASURES])
    out = texts.mapInArrow(_scan(), kinds).withColumns({name: F.expr(rule) for name, rule in RULES.items()})
    base = F.lit(False)
    for name in BASE:
        base = base | F.col(name)
    return staged(out.withColumn("base_failed", base), "measured")


def prior(k: int, docs: int, squares: int, failed: int, spread: float) -> tuple[float, float | None]:
    """(mean, weight a + b) of the beta distribution fitted to the hosts; no weight where they do not differ.

    ``squares`` is the sum of squared documents of a host, ``spread`` the sum
    of squared failures over documents.
    """
    if not docs:
        return 0.0, None
    mean = failed / docs
    chance = mean * (1 - mean)
    room = docs - squares / docs - (k - 1)
    if chance <= 0 or room <= 0:
        return mean, None
    alike = ((spread - failed * failed / docs) / chance - (k - 1)) / room
    return mean, (max(0.0, 1 / alike - 1) if alike > 0 else None)


def host_verdicts(rows: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """(host, docs, failed_<rule>, rate_<rule>, rejected) of each host; the rates are shrunk."""
    hosts = staged(rows.where("host is not null").groupBy("host").agg(
        F.count("*").alias("docs"), *(F.count_if(F.col(r)).alias(f"failed_{r}") for r in RULES)), "hosts")
    # One row: how many hosts and documents there are, and how the failures of each rule spread over them.
    docs = F.col("docs").cast("double")
    total = hosts.agg(F.count("*").alias("k"), F.coalesce(F.sum("docs"), F.lit(0)).alias("docs"), F.coalesce(F.sum(docs * docs), F.lit(0.0)).alias("squares"),
                      *(F.coalesce(F.sum(f"failed_{r}"), F.lit(0)).alias(f"failed_{r}") for r in RULES),
                      *(F.coalesce(F.sum(F.col(f"failed_{r}").cast("double") * F.col(f"failed_{r}") / docs), F.lit(0.0)).alias(f"spread_{r}") for r in RULES)).collect()[0]
    rejected = F.lit(False)
    rates = {}
    for r in RULES:
        mean, weight = prior(total["k"], total["docs"], total["squares"], total[f"failed_{r}"], total[f"spread_{r}"])
        rates[f"rate_{r}"] = F.lit(mean) if weight is None else (F.col(f"failed_{r}") + F.lit(mean * weight)) / (docs + F.lit(weight))
        rejected = rejected | (rates[f"rate_{r}"] >= limit)
    return hosts.withColumns({**rates, "rejected": rejected})


def with_verdicts(rows: DataFrame, limit: float = HOST_LIMIT, list_bytes: int = LIST_BYTES) -> DataFrame:
    """``measured`` rows with ``host_rejected`` and ``kept`` (neither a base rule nor the host rejects the document)."""
    bad = staged(host_verdicts(rows, limit).where("rejected").select(F.col("host").alias("_bad")), "rejected-hosts")
    size = bad.agg(F.coalesce(F.sum(F.octet_length("_bad") + 32), F.lit(0)).alias("n")).collect()[0]["n"]
    if size <= list_bytes:
        out = rows.join(F.broadcast(bad), F.col("host") == F.col("_bad"), "left")
    else:
        salted = bad.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        dealt = rows.withColumn("_deal", F.pmod(F.xxhash64("doc_id", *MEASURES), F.lit(SALTS)).cast("int"))
        out = dealt.join(salted, (F.col("host") == F.col("_bad")) & (F.col("_deal") == F.col("_salt")), "left")
    host_rejected = F.col("_bad").isNotNull()
    return out.select(*rows.columns, host_rejected.alias("host_rejected"), (~F.col("base_failed") & ~host_rejected).alias("kept"))


def keep_documents(docs: DataFrame, host: str | Column = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """The rows of ``docs``, all their columns, that neither the base rules nor their host's verdict reject."""
    out = with_verdicts(measured(docs, host, carry=True), limit).where("kept")
    return out.select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))


def op12_host_rules(spark, sf_dir: str) -> DataFrame:
    """Contract query: the measures and verdicts of all ``documents``, whose host is their ``source``."""
    from sideline.llm.common import table

    out = with_verdicts(measured(table(spark, sf_dir, "documents")))
    return out.select("doc_id", *MEASURES[:5], "base_failed", "kept")
