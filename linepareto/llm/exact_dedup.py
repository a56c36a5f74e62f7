"""Exact duplicates by progressive refinement, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Characters of a text that the second step hashes.
PREFIX = 64


def exact_duplicates(docs: DataFrame, prefix: int = PREFIX) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Three steps, each only for what the one before left: byte length, hash of the first `prefix`
    characters, SHA-256 of the whole text. Lengths and prefix hashes come from a narrow scan; only
    full hashes of surviving groups are grouped. (The hash of every other row is a column of the
    result, so its text is read once in the last scan as well.) No text is shuffled; every grouping
    combines before its shuffle and the joins' hot keys can be split.

    Null text counts as empty. Of equal texts the largest doc_id stays; a null doc_id is smaller than
    any other. Rows that repeat the id that stays are all marked kept. An empty table gives none.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    step = [F.octet_length(text).alias("size"), F.xxhash64(F.substring(text, 1, prefix)).alias("head")]
    narrow = docs.select(*step).groupBy("size", "head").count()  # combined first, so no length is hot
    lengths = narrow.groupBy("size").agg(F.sum("count").alias("rows")).filter("rows > 1").select("size")
    heads = narrow.join(lengths, "size", "left_semi").filter("count > 1").select("size", "head")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(text.cast("binary"), 256).alias("text_sha256"),
                       *step)
    groups = (rows.join(heads, ["size", "head"], "left_semi").groupBy("text_sha256")
              .agg(F.max("doc_id").alias("keep"), F.count(F.lit(1)).alias("n")).filter("n > 1"))
    alone = F.col("n").isNull()
    keep = F.when(alone, F.col("doc_id")).otherwise(F.col("keep"))
    return rows.join(groups, "text_sha256", "left").select(
        "doc_id", keep.alias("keep_id"), F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256")
