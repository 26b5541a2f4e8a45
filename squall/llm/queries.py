"""One registered query per training-data operator, with production parameters.

Each reads the whole table named by its operator and returns its full result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from squall.llm import dialogue, extraction, idfiles, lexical, lines, packing, pii, quality, repeats, secrets, simhash, tiling, topk
from squall.llm.text import table


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns, then whether and how far passages of 50 words or more repeat."""
    return repeats.without_repeats(table(spark, sf_dir, "documents"), words=repeats.WORDS).drop("kept")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(table(spark, sf_dir, "documents"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per document and the benchmark item that it holds."""
    return tiling.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idfiles.token_ids(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the remaining text, and its numbers of lines and of removed lines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs)


def op11_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue.repair_report(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_array_dedup": op1_suffix_array_dedup,
    "op2_html_extraction": op2_html_extraction,
    "op3_personal_data": op3_personal_data,
    "op4_secret_scan": op4_secret_scan,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_simhash": op6_simhash,
    "op7_decontamination": op7_decontamination,
    "op8_quality_rules": op8_quality_rules,
    "op9_token_ids": op9_token_ids,
    "op10_line_dedup": op10_line_dedup,
    "op11_exact_top_k": op11_exact_top_k,
    "op12_lexical_search": op12_lexical_search,
    "op13_conversation_repair": op13_conversation_repair,
}

#: DuckDB twins of the queries that SQL can express
ORACLE_SQL: dict[str, str] = {
    "op2_html_extraction": extraction.ORACLE_SQL,
    "op10_line_dedup": lines.ORACLE_SQL,
    "op11_exact_top_k": topk.ORACLE_SQL,
    "op12_lexical_search": lexical.ORACLE_SQL,
}
