"""The registered queries of the subpackage. Each applies one operator with production parameters to its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm import bpe_trie, decontamination, html_blocks, licenses, merkle, oracles, order_minhash, prefix_trie, quality_rules, rule_ensemble, simhash, suffix_dedup, token_store, url_lists
from holdfast.llm.common import table
from holdfast.session import shared_dir

#: Folder of the public tokenizer files, the same on every machine.
TOKENIZERS = "/opt/tokenizers"


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/llm/tokens-{uuid.uuid4().hex}"
    store = token_store.write_tokens(table(spark, sf_dir, "documents"), path, f"{TOKENIZERS}/word_bpe_49k.json", 2)
    return store.documents()


def op2_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(table(spark, sf_dir, "pages"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("llr")


def op6_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_ensemble.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicate_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op8_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_trie.encoding_report(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json")


def op9_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_lists.judged(url_lists.captures_of(pages), url_lists.entries_of(pages))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_report(table(spark, sf_dir, "documents"))


def op11_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.edit_report(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.turns_of(table(spark, sf_dir, "conversations"))))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_store": op1_token_store,
    "op2_html_blocks": op2_html_blocks,
    "op3_decontamination": op3_decontamination,
    "op4_license_scan": op4_license_scan,
    "op5_quality_rules": op5_quality_rules,
    "op6_rule_ensemble": op6_rule_ensemble,
    "op7_simhash_groups": op7_simhash_groups,
    "op8_bpe_trie": op8_bpe_trie,
    "op9_url_lists": op9_url_lists,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_order_minhash": op11_order_minhash,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE: dict[str, str] = {
    "op5_quality_rules": oracles.QUALITY_RULES,
    "op9_url_lists": url_lists.ORACLE,
    "op10_suffix_dedup": oracles.SUFFIX_DEDUP,
    "op12_prefix_trie": oracles.PREFIX_TRIE,
    "op13_merkle_manifest": oracles.MERKLE,
}
