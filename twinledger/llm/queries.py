"""The queries of the operators over the whole tables, and their SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from twinledger.llm import chunk_dedup, conversations, exact, license_rules, main_text, mixing, packing, phrases, quality, secret_scan, simhash, spotsigs, toxicity
from twinledger.llm.common import documents, labels


def op1_chunk_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.repeated_spans(documents(spark, sf_dir))


def op2_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.fingerprint_edits(documents(spark, sf_dir))


def op3_quality_additive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(documents(spark, sf_dir), labels(spark, sf_dir))


def op4_minimum_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op5_exact_run_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(documents(spark, sf_dir))


def op6_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_rules.scan_licenses(documents(spark, sf_dir))


def op7_simhash_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op9_toxicity_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(documents(spark, sf_dir), labels(spark, sf_dir))


def op10_secret_trigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(documents(spark, sf_dir)).drop("found")


def op11_main_text_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.main_texts(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op12_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chunk_repeats": op1_chunk_repeats,
    "op2_spot_signatures": op2_spot_signatures,
    "op3_quality_additive": op3_quality_additive,
    "op4_minimum_bin_slack": op4_minimum_bin_slack,
    "op5_exact_run_merge": op5_exact_run_merge,
    "op6_license_rules": op6_license_rules,
    "op7_simhash_trees": op7_simhash_trees,
    "op8_source_mix": op8_source_mix,
    "op9_toxicity_ratios": op9_toxicity_ratios,
    "op10_secret_trigrams": op10_secret_trigrams,
    "op11_main_text_trees": op11_main_text_trees,
    "op12_phrase_automata": op12_phrase_automata,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLES: dict[str, str] = {
    "op5_exact_run_merge": """
        WITH d AS (
            SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h
            FROM documents
        )
        SELECT doc_id, max(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
        FROM d
    """,
    "op6_license_rules": license_rules.scan_sql(),
    "op12_phrase_automata": phrases.collocations_sql(),
}
