"""Queries of the operators over the test tables, and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from caseworks.llm import chat, hyperplanes, langid, lexical, lines, minhash, mixing, negatives, passages, pieces, rules, topk, wrapper
from caseworks.llm.support import table

Query = Callable[[SparkSession, str], DataFrame]


def _over(name: str, build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(table(spark, sf_dir, name))


QUERIES: dict[str, Query] = {
    "op1_source_mixing": _over("documents", mixing.op1_source_mixing),
    "op2_prefix_targets": _over("conversations", chat.op2_prefix_targets),
    "op3_minhash_near_dedup": _over("documents", minhash.op3_minhash_near_dedup),
    "op4_wrapper_extraction": _over("pages", wrapper.op4_wrapper_extraction),
    "op5_language_id": _over("documents", langid.op5_language_id),
    "op6_line_dedup": _over("documents", lines.op6_line_dedup),
    "op7_quality_rules": _over("documents", rules.op7_quality_rules),
    "op8_substring_dedup": _over("documents", passages.op8_substring_dedup),
    "op9_merge_dropout": _over("documents", pieces.op9_merge_dropout),
    "op10_exact_top_k": _over("embeddings", topk.op10_exact_top_k),
    "op11_hard_negatives": _over("embeddings", negatives.op11_hard_negatives),
    "op12_hyperplane_near_dedup": _over("embeddings", hyperplanes.op12_hyperplane_near_dedup),
    "op13_lexical_search": lambda spark, sf_dir: lexical.op13_lexical_search(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    ),
}

CHECKS: dict[str, str] = {
    "op1_source_mixing": mixing.SQL,
    "op2_prefix_targets": chat.SQL,
    "op6_line_dedup": lines.SQL,
    "op7_quality_rules": rules.sql(),
    "op10_exact_top_k": topk.SQL,
    "op11_hard_negatives": negatives.SQL,
    "op12_hyperplane_near_dedup": hyperplanes.SQL,
    "op13_lexical_search": lexical.SQL,
}
