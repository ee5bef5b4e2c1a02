"""Spelling variants of a corpus' words by sorted rotations of the words.

Each word is marked with a terminator and turned into its rotations.  Two
words that differ in one code point, ``a x b`` and ``a y b``, have rotations
``b $ a x`` and ``b $ a y``: the same but for the skipped last one.  A word
without it, ``a b``, has the rotation ``b $ a`` as a whole.  So all rotations,
sorted by what is left when the edited letter is skipped, put words within one
replacement, insertion or deletion of each other into one prefix range.

1. Runs of letters are counted text by text, then summed over the corpus.
   Words get numbers in code-point order (a sort by range; numbers grow with
   the partition and the place in it).
2. Rotations are range-partitioned by their prefix and sorted; one scan finds
   the groups.  A group holds at most one word for each letter of the alphabet
   and one without, so it is bounded by the alphabet.  The scan emits one row
   for each member: how many neighbours it has there and the best of them.
   No pairs are made, and each pair of neighbours meets in one group: indels
   in a run of one letter count at its first place only.
3. A word's neighbours are summed, its form is the best of all groups, and
   roots follow by pointer doubling (forms at least double the count, so there
   are no rings and few rounds).

A word of more than ``LONG`` code points has the digests of ``a`` and ``b`` as
its rotation, so that the work stays in proportion to its length.

Defined results: a null or empty text has no runs; a null ``doc_id`` is the
empty string in the hash; repeated rows count each; words of equal counts come
in code-point order; an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sideline.llm.batches import as_binary, parts, table_batch
from sideline.llm.common import staged

RUN = re.compile("[A-Za-zÀ-ÿ]+")
_GAP = re.compile("[^A-Za-zÀ-ÿ]")
#: Letters a word has, occurrences, and how many times more often its form occurs, at least.
LETTERS, COUNT, RATIO = 5, 3, 2
#: One run in so many loses a letter (by a hash of the document and the run).
SLIPS = 97
#: Code points of a rotation kept as text; longer ones are digests.
LONG = 64
#: Code points searched at once in a text, and words held in a task before they are passed on.
PIECE, HELD = 1 << 20, 1 << 17
END = "$"


def _pieces(text: str) -> Iterator[str]:
    """The text in pieces that end at a character of no run."""
    first = 0
    while first < len(text):
        gap = _GAP.search(text, first + PIECE)
        last = gap.start() if gap else len(text)
        yield text[first:last]
        first = last


def slipped(doc: str, word: str, slips: int) -> str:
    """The word, without a letter where the hash of document and word says so."""
    h = zlib.crc32(f"{doc}:{word}".encode())
    if not slips or h % slips:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def _count(letters: int, slips: int):
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in parts(batches):
            for doc, text in zip(batch.column("doc").to_pylist(), as_binary(batch.column("text")), strict=True):
                # Only A-Z are lower-cased: bytes know no others.
                runs: Counter[str] = Counter()
                for piece in _pieces(text.as_py().lower().decode("utf-8", "replace")):
                    runs.update(RUN.findall(piece))
                for run, n in runs.items():
                    word = slipped(doc, run, slips) if len(run) >= letters else ""
                    if len(word) >= letters:
                        total[word] += n
                if len(total) > HELD:
                    yield table_batch(schema, [list(total), list(total.values())])
                    total.clear()
        if total:
            yield table_batch(schema, [list(total), list(total.values())])

    return count


def word_counts(docs: DataFrame, letters: int = LETTERS, least: int = COUNT, slips: int = SLIPS) -> DataFrame:
    """(id, word, n) of the words that occur ``least`` times or more; ids are in code-point order."""
    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.col("text").cast("string").alias("text")).where("text is not null")
    counted = texts.mapInArrow(_count(letters, slips), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    counted = staged(counted, "counted")
    return staged(counted.repartitionByRange("word").sortWithinPartitions("word").select(F.monotonically_increasing_id().alias("id"), "word", "n"), "words")


def _digests(word: str) -> list[bytes]:
    """The digest of each beginning of the word, the empty one first."""
    h = hashlib.blake2b(digest_size=16)
    out = [h.digest()]
    for letter in word:
        h.update(letter.encode())
        out.append(h.digest())
    return out


def _long_rotations(long: int):
    schema = pa.schema([("key", pa.string()), ("id", pa.int64()), ("n", pa.int64()), ("edit", pa.bool_()), ("leads", pa.bool_())])

    def rotations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, n, word in zip(*(batch.column(c).to_pylist() for c in ("id", "n", "word")), strict=True):
                before, after, size = _digests(word), _digests(word[::-1]), len(word)
                skip = [(after[size - 1 - k].hex() + END + before[k].hex(), True, k == 0 or word[k] != word[k - 1]) for k in range(size)] if size > long + 1 else []
                skip += [(after[size - k].hex() + END + before[k].hex(), False, True) for k in range(size + 1)]
                for first in range(0, len(skip), 10_000):
                    key, edit, leads = zip(*skip[first: first + 10_000], strict=True)
                    yield table_batch(schema, [list(key), [i] * len(key), [n] * len(key), list(edit), list(leads)])

    return rotations


def rotations(words: DataFrame, long: int = LONG) -> DataFrame:
    """(key, id, n, edit, leads): rotations without the edited letter (``edit``) and whole ones.

    ``leads`` is false where the skipped letter repeats the one before it.
    """
    size = F.char_length("word")

    def part(first, last=None):
        return F.substr("word", first) if last is None else F.substr("word", first, last)

    def skipping(k):
        # The letter at place k is skipped.
        return F.struct(F.concat(part(k + 1), F.lit(END), part(F.lit(1), k - 1)).alias("key"), F.lit(True).alias("edit"),
                        ((k == 1) | (part(k, F.lit(1)) != part(k - 1, F.lit(1)))).alias("leads"))

    def whole(k):
        return F.struct(F.concat(part(k + 1), F.lit(END), part(F.lit(1), k)).alias("key"), F.lit(False).alias("edit"), F.lit(True).alias("leads"))

    edits = words.where(size <= long + 1).select("id", "n", F.explode(F.transform(F.sequence(F.lit(1), size), skipping)).alias("r"))
    wholes = words.where(size <= long).select("id", "n", F.explode(F.transform(F.sequence(F.lit(0), size), whole)).alias("r"))
    columns = ["r.key", "id", "n", "r.edit", "r.leads"]
    far = words.where(size > long).select("id", "n", "word").mapInArrow(_long_rotations(long), "key string, id long, n long, edit boolean, leads boolean")
    return edits.select(*columns).union(wholes.select(*columns)).union(far)


def _best(group: np.ndarray, n: np.ndarray, ids: np.ndarray, groups: int) -> tuple[np.ndarray, ...]:
    """(count, best n, best id, second n, second id) of each group's rows: highest n, then smallest id; n is -1 where there is none."""
    order = np.lexsort((ids, -n, group))
    count = np.bincount(group, minlength=groups)
    first = np.cumsum(count) - count
    out = [count]
    for k in (0, 1):
        on = count > k
        at = order[first[on] + k]
        top, who = np.full(groups, -1), np.full(groups, -1)
        top[on], who[on] = n[at], ids[at]
        out += [top, who]
    return tuple(out)


def neighbours(group: np.ndarray, ids: np.ndarray, n: np.ndarray, edit: np.ndarray, leads: np.ndarray) -> tuple[np.ndarray, ...]:
    """(id, neighbours, best n, best id) of the members that have neighbours in their group."""
    groups = int(group[-1]) + 1
    count, n1, id1, n2, id2 = _best(group[edit], n[edit], ids[edit], groups)
    lead = edit & leads
    near_whole, lead_n, lead_id, _, _ = _best(group[lead], n[lead], ids[lead], groups)
    whole_n, whole_id = np.full(groups, -1), np.full(groups, -1)
    whole_n[group[~edit]], whole_id[group[~edit]] = n[~edit], ids[~edit]
    own = id1[group] == ids
    best_n, best_id = np.where(own, n2[group], n1[group]), np.where(own, id2[group], id1[group])
    # A word with the letter skipped is next to the one without it.
    near = count[group] - 1
    with_whole = leads & (whole_n[group] >= 0)
    better = with_whole & ((whole_n[group] > best_n) | ((whole_n[group] == best_n) & (whole_id[group] < best_id)))
    best_n, best_id = np.where(better, whole_n[group], best_n), np.where(better, whole_id[group], best_id)
    near = near + with_whole
    near, best_n, best_id = np.where(edit, near, near_whole[group]), np.where(edit, best_n, lead_n[group]), np.where(edit, best_id, lead_id[group])
    on = near > 0
    return ids[on], near[on], best_n[on], best_id[on]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of equal keys in sorted rows; the last group of a batch waits for the next batch."""
    schema = pa.schema([("id", pa.int64()), ("near", pa.int64()), ("best_n", pa.int64()), ("best_id", pa.int64())])

    def found(rows: pa.RecordBatch, group: np.ndarray) -> pa.RecordBatch:
        columns = [rows.column(c).to_numpy(zero_copy_only=False) for c in ("id", "n", "edit", "leads")]
        return table_batch(schema, [pa.array(x.astype(np.int64)) for x in neighbours(group, *columns)])

    held: pa.RecordBatch | None = None
    for batch in batches:
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        if not batch.num_rows:
            continue
        key = batch.column("key")
        new = pc.not_equal(key.slice(1), key.slice(0, len(key) - 1)).to_numpy(zero_copy_only=False)
        group = np.concatenate([[0], np.cumsum(new)])
        last = int(np.searchsorted(group, group[-1]))
        if last:
            yield found(batch.slice(0, last), group[:last])
        held = batch.slice(last)
    if held is not None and held.num_rows:
        yield found(held, np.zeros(held.num_rows, np.int64))


def _roots(forms: DataFrame) -> DataFrame:
    """(id, root_id) by pointer doubling over (id, form_id)."""
    hop = staged(forms.select("id", F.col("form_id").alias("root_id")), "roots")
    while True:
        up = hop.select(F.col("id").alias("root_id"), F.col("root_id").alias("above"))
        nxt = staged(hop.join(up, "root_id", "left").select("id", F.coalesce("above", "root_id").alias("root_id"), F.col("above").isNotNull().alias("moved")), "roots")
        hop = nxt.select("id", "root_id")
        if nxt.where("moved").isEmpty():
            return hop


def spelling_groups(docs: DataFrame, letters: int = LETTERS, least: int = COUNT, ratio: int = RATIO, slips: int = SLIPS, long: int = LONG) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each word of ``docs`` (doc_id, text)."""
    words = word_counts(docs, letters, least, slips)
    sorted_ = rotations(words, long).repartitionByRange("key").sortWithinPartitions("key")
    rows = sorted_.mapInArrow(_scan, "id long, near long, best_n long, best_id long")
    best = F.max(F.struct(F.col("best_n"), (-F.col("best_id")).alias("order")))
    near = staged(rows.groupBy("id").agg(F.sum("near").alias("n_near"), best.alias("best"))
                  .select("id", "n_near", F.col("best.best_n").alias("best_n"), (-F.col("best.order")).alias("best_id")), "near")
    known = staged(words.join(near, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        *(F.when(F.col("best_n") >= ratio * F.col("n"), F.col(f"best_{c}")).alias(f"form_{c}") for c in ("n", "id"))), "known")
    roots = _roots(known.where("form_id is not null"))
    text = lambda name: known.select(F.col("id").alias(f"{name}_id"), F.col("word").alias(name))
    named = (known.where("form_id is not null").select("id", "form_id").join(roots, "id")
             .join(text("form"), "form_id").join(text("root"), "root_id").select("id", "form", "root"))
    return known.join(named, "id", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_permuterm(spark, sf_dir: str) -> DataFrame:
    """Contract query: words, forms and roots of all ``documents``."""
    from sideline.llm.common import table

    return spelling_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
