"""Registered queries of the operators and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from linepareto.llm import attention_lm, bpe, exact_dedup, hash_forest, jaccard, language, license_scan, line_chunks, \
    main_text, merkle, packing, spelling, sql, substrings


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_language_model_scores(spark: SparkSession, folder: str) -> DataFrame:
    return attention_lm.scores(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op3_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.digests(_table(spark, folder, "documents"))


def op4_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                          public_tokenizers.PATTERN)


def op5_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return main_text.extract(_table(spark, folder, "pages"))


def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, folder, "documents"))


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.held_out_predictions(_table(spark, folder, "documents"))


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_chunks.repeated_runs(_table(spark, folder, "documents"))


def op9_hash_forest_search(spark: SparkSession, folder: str) -> DataFrame:
    return hash_forest.every_nth(_table(spark, folder, "embeddings"))


def op10_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar_documents(_table(spark, folder, "documents"))


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(_table(spark, folder, "documents"))


def op12_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.license_labels(_table(spark, folder, "documents"))


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.verified_manifest(_table(spark, folder, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_best_fit_packing, op2_language_model_scores, op3_suffix_array_dedup, op4_byte_bpe, op5_html_extraction, op6_exact_dedup, op7_language_id, op8_line_dedup,
        op9_hash_forest_search, op10_ngram_jaccard_join, op11_spelling_variants, op12_license_scan, op13_merkle_manifest)}


def oracle_sql() -> dict[str, str]:
    """What SQL can express; the other operators are tested against brute force in tests/llm."""
    return {
        "op6_exact_dedup": """
            SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
                   doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
            FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
        "op12_license_scan": sql.license_scan(license_scan.TEMPLATES, license_scan.PHRASES, license_scan.CONTAINMENT),
        "op13_merkle_manifest": sql.MERKLE_MANIFEST,
    }
