"""Corpus pipeline: quality rules, line dedup, SimHash near-dedup, benchmark
decontamination, best-fit packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last
return the columns of ``docs``. A null or empty text goes through like any other: it
fails the quality rules. Rows are judged by their id and text, so null and shared ids
neither save a row nor take it along.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from squall.llm import lines, packing, quality, simhash, tiling
from squall.llm.text import free_name, table
from squall.llm.work import written

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and the log-likelihood ratio."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its lines that are the first of their kind; ``n_chars`` follows the text."""
    texts = lines.dedup_lines(docs, *free_name(docs, "_lines", "_removed"))
    if "n_chars" in docs.columns:
        texts = texts.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return texts.select(*docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: one with the smallest id."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return tiling.keep_clean(docs, table(spark, sf_dir, "benchmark"), null_ids=False)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences of at most 2048 tokens."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: hashes, tilings and token ids have no DuckDB twin; tests hold each stage against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
