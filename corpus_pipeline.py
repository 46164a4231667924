"""Corpus pipeline over ``documents``: language ID, exact dedup, near dedup,
benchmark decontamination, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet and read again as the next stage's input.  All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickmart.llm import byte_bpe, decontaminate, exact_dedup, langid, near_dup
from tickmart.llm.queries import table, vocabulary
from tickmart.llm.runtime import prepare
from tickmart.sinks.tables import stage

# Near-duplicate stage: five-word shingles, similarity of 0.8 or more.
SHINGLE_WORDS, PERCENT = 5, 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known (operator 9)."""
    prepare(spark)
    return langid.keep_known(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row of the largest doc_id (operator 10)."""
    prepare(spark)
    return exact_dedup.keep_one(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (operator 5)."""
    prepare(spark)
    return near_dup.keep_one(docs, SHINGLE_WORDS, PERCENT)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item (operator 7)."""
    prepare(spark)
    return decontaminate.clean_only(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, encoded and decoded (operator 8)."""
    prepare(spark)
    return byte_bpe.bpe_digests(docs, vocabulary("byte_bpe_multi_50k.tiktoken"))


STAGES = [("language_id", language), ("exact_dedup", exact), ("near_dedup", near),
          ("decontaminate", decontaminated), ("byte_bpe", tokens)]

# No SQL expresses the first and the last stage; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
