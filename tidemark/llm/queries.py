"""The operators with production parameters over their whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import exact_dedup, hard_negatives, license_scan, line_templates, mixing, ngram_join, packing, pair_ranking, prefix_trie, quality, sharding, token_orc, toxicity
from tidemark.llm.common import table


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_templates.line_report(table(spark, sf_dir, "documents"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_groups(table(spark, sf_dir, "documents")).drop("key")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents"), license_scan.document_path())


def op6_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_orc.round_trip(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), hash_all=True)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id"))


def op11_pair_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_ranking.quality_ranking(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_line_dedup, op2_ngram_join, op3_quality, op4_toxicity, op5_license_scan, op6_token_orc, op7_exact_dedup, op8_packing, op9_mixing, op10_sharding, op11_pair_ranking, op12_prefix_trie, op13_hard_negatives)}

ORACLES = {"op5_license_scan": license_scan.oracle(), "op7_exact_dedup": exact_dedup.ORACLE, "op10_sharding": sharding.oracle(), "op12_prefix_trie": prefix_trie.ORACLE, "op13_hard_negatives": hard_negatives.ORACLE}
