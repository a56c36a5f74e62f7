"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# A key is hot from this number of rows on; it is spread over one task per so many rows.
HOT_ROWS = 1_000_000
# Keys the sketch tells apart and the most it reports.
TRACKED = 65_536
REPORTED = 10_000


def hot_keys(df: DataFrame, key: str, min_rows: int = HOT_ROWS) -> DataFrame:
    """Keys too frequent for one task with their `_fan`, found with a fixed-size sketch.

    One scan of the key column; the shuffle moves one sketch per task and the result has at
    most REPORTED rows. The sketch only chooses where `spread_join` splits, never which rows join.
    """
    top = df.filter(F.col(key).isNotNull()).selectExpr(key).groupBy().agg(
        F.expr(f"approx_top_k({key}, {REPORTED}, {TRACKED})").alias("top"))
    return top.select(F.inline("top")).filter(F.col("count") >= min_rows).select(
        F.col("item").alias(key), F.ceil(F.col("count") / min_rows).cast("int").alias("_fan"))


def spread_join(left: DataFrame, right: DataFrame, key: str, spread_by: list[str], hot: DataFrame) -> DataFrame:
    """Inner equi join whose hot left keys are spread over their `_fan` tasks.

    `right` must have few rows per key (pre-aggregated): its rows are copied for the hot keys and
    kept single for all others. The result equals the plain join.
    """
    marked = F.broadcast(hot.select(key, "_fan"))
    fan = F.coalesce("_fan", F.lit(1))
    left = left.join(marked, key, "left").withColumn("_salt", F.pmod(F.xxhash64(*spread_by), fan).cast("int")).drop("_fan")
    right = right.join(marked, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), fan - 1))).drop("_fan")
    return left.join(right, [key, "_salt"]).drop("_salt")


def spread_lookup(left: DataFrame, dimension: DataFrame, on: dict[str, str], spread_by: list[str],
                  condition: Column | None = None, how: str = "inner", fan: int = 16) -> DataFrame:
    """Join with a dimension of unknown size.

    Small ones are broadcast by Spark, which knows their size; large ones are shuffled, with
    every key spread over `fan` tasks so that no hot key lands in one of them. `on` maps left
    to dimension columns.
    """
    left = left.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(fan)).cast("int"))
    copied = dimension.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(fan - 1))))
    match = F.col("_salt") == F.col("_copy")
    for ours, theirs in on.items():
        match = match & (left[ours] == copied[theirs])
    if condition is not None:
        match = match & condition
    return left.join(copied, match, how).drop("_salt", "_copy")
