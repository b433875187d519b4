"""The corpus pipeline: five stages, each written as Parquet and read again as the documents of the next.

Defined results: a null text counts as empty, so the first stage drops it; rows that repeat are near-duplicates of each other,
so one stays; columns beyond those of ``documents`` pass through all stages but the last. Empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from holdfast.llm import bpe_trie, decontamination, near_copies, passages, quality_rules
from holdfast.llm.common import bound_batches, stored, table
from holdfast.llm.queries import TOKENIZERS


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    bound_batches(spark)
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word similarity of 0.8 or more."""
    bound_batches(spark)
    return near_copies.keep_one_per_group(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of over 50 words or of 400 bytes that repeat."""
    bound_batches(spark)
    return passages.remove_passages(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    bound_batches(spark)
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    bound_batches(spark)
    return bpe_trie.encoding_report(docs, f"{TOKENIZERS}/byte_bpe_50k.json")


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("benchmark leaks", benchmark_leaks),
    ("encoding", encoding),
]

#: SQL has no fingerprints, suffix order or byte-pair merges; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, one after the other."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
