"""Corpus pipeline over ``documents``: toxicity filter, near-dedup, repeated-string removal, packing.

Each stage is (spark, docs, sf_dir) -> DataFrame and works on all its
predecessor kept.  All but the last return the columns of ``documents``, in
their order, further columns included.

1. ``toxicity``: rows whose text scores at least the threshold go; the model
   is learned from the labelled rows among ``docs`` that are not held out.
2. ``near_dedup``: of each group of near-duplicates (five-word shingles,
   similarity 0.8 or more) the row with the smallest ``doc_id`` stays, once.
3. ``suffix_dedup``: bytes in 200-byte strings that also start elsewhere are
   removed from ``text`` (with the rest of a letter that was cut), ``n_chars``
   is counted anew; rows stay, also with nothing left.
4. ``packing``: sequences of at most 1024 ids, one row for each piece.

Nulls, empty texts, repeated rows and empty tables have the results that the
operators state; a null ``doc_id`` is never a duplicate.  Further columns may
have any names: they are carried in a struct, or passed on as they are, and
come out of every stage but the last unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sideline.llm import near_dedup, packing, repeats, toxicity
from sideline.llm.common import ship, staged, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject_toxic(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Rows travel in a struct, so no column of theirs can clash with a name used here.
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("key"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    found = near_dedup.near_duplicates(docs.select("doc_id", "text"))
    stay = staged(found.where("kept").groupBy(F.col("doc_id").alias("stay_id"), F.col("key").alias("stay_key")).agg(F.count("*").alias("rows")), "stay")
    same = F.col("id").eqNullSafe(F.col("stay_id")) & (F.col("key") == F.col("stay_key"))
    many = (F.col("rows") > 1) & F.col("stay_id").isNotNull()
    once = rows.join(stay.where(~many), same, "left_semi").select("row")
    # Rows that repeat id and text: one of them stays.
    again = rows.join(stay.where(many), same, "left_semi").withColumn("text", F.col("row.text")).dropDuplicates(["id", "text"]).select("row")
    return once.union(again).select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))


def suffix_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = repeats.remove_repeats(docs, as_text=True)
    made = {"text": F.col("kept"), "n_chars": F.col("letters").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None}
    return out.select(*(made[c].alias(c) if c in made else F.col(f"row.`{c}`").alias(c) for c in docs.columns))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(docs))


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("suffix_dedup", suffix_dedup_stage),
    ("packing", packing_stage),
]

#: Automata, learned weights and a tokenizer are beyond SQL: tests/llm hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as a table and read again as the next one's input."""
    docs = table(ship(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
