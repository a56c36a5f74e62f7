"""The corpus pipeline: stages from documents to packed sequences.

Every stage takes all that the one before kept and gives back rows of `documents` with the same
columns; the last one gives the packed pieces. Texts change in the stages that cut them, and n_chars
with them. A document whose text is cut to nothing leaves. Null texts leave with the first stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from linepareto.llm import jaccard, language, line_chunks, packing, substrings
from linepareto.llm.common import in_small_batches, stored

# Documents below this score, or of no known language, leave with the first stage. Clean prose of a
# learned language scores above 0.4 even in a single short line.
LEAST_SCORE = 0.1


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model knows; it learns from all labelled documents."""
    in_small_batches(spark)
    found = language.languages(docs, language.train(docs))
    return found.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the runs of lines that an earlier place holds."""
    in_small_batches(spark)
    return line_chunks.cut_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the smallest id."""
    in_small_batches(spark)
    return jaccard.one_of_each_group(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 100-byte strings that an earlier place holds."""
    in_small_batches(spark)
    return substrings.cut_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document left, in as few sequences of 1024 tokens as best-fit finds."""
    in_small_batches(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("ngram_jaccard_join", near_duplicates),
          ("suffix_array_dedup", substring_dedup), ("best_fit_packing", best_fit_packing)]

# Trained classifiers and rolling hashes are not SQL; tests/llm/test_pipeline.py has brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
