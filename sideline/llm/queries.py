"""Registered queries of the training-data operators: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sideline.llm.common import ship
from sideline.llm.host_rules import op12_host_rules
from sideline.llm.licenses import op1_license_scan
from sideline.llm.near_dedup import op7_minhash_near_dedup
from sideline.llm.oracle import SQL
from sideline.llm.packing import op4_best_fit_packing
from sideline.llm.permuterm import op11_permuterm
from sideline.llm.product_quantisation import op9_embedding_near_dedup
from sideline.llm.repeats import op6_suffix_array_dedup
from sideline.llm.sentence_pieces import op8_sentencepiece
from sideline.llm.shared_lists import op13_shared_lists
from sideline.llm.token_counts import op2_token_counts
from sideline.llm.top_inner import op10_exact_top_k
from sideline.llm.toxicity import op5_toxicity
from sideline.llm.warc import op3_warc_reassembly

_ALL = (
    op1_license_scan,
    op2_token_counts,
    op3_warc_reassembly,
    op4_best_fit_packing,
    op5_toxicity,
    op6_suffix_array_dedup,
    op7_minhash_near_dedup,
    op8_sentencepiece,
    op9_embedding_near_dedup,
    op10_exact_top_k,
    op11_permuterm,
    op12_host_rules,
    op13_shared_lists,
)


def _query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: f(ship(spark), sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: _query(f) for f in _ALL}

#: DuckDB SQL where whole-table SQL can express a query; the others are held against brute force in tests/llm.
ORACLE_SQL: dict[str, str] = dict(SQL)
