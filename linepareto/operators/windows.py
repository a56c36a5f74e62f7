"""Distinct units per hour and per sliding window of hours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def tumbling_units(rows: DataFrame, ts: str, by: Sequence[str], unit: str, width: str = "1 hour") -> DataFrame:
    """Distinct units per window and group."""
    return (rows.groupBy(F.window(ts, width)["start"].alias("window_start"), *by)
            .agg(F.countDistinct(unit).alias("n")))


def sliding_units(rows: DataFrame, ts: str, by: Sequence[str], unit: str, hours: int = 8) -> DataFrame:
    """Distinct units in every window of `hours` that starts on the hour.

    Rows are first reduced to one per unit and hour. An hour then adds the unit only to the
    windows its previous hour did not reach, so each (window, unit) arises once and windows
    are counted without another distinct.
    """
    seen = rows.filter(F.col(unit).isNotNull()).select(
        *by, unit, F.window(ts, "1 hour")["start"].alias("_hour")).distinct()
    before = F.lag("_hour").over(Window.partitionBy(*by, unit).orderBy("_hour"))
    earliest = F.col("_hour") - F.expr(f"INTERVAL {hours - 1} HOURS")
    opened = seen.withColumn("_from", F.greatest(earliest, before + F.expr("INTERVAL 1 HOUR")))
    starts = F.sequence(F.col("_from"), F.col("_hour"), F.expr("INTERVAL 1 HOUR"))
    return (opened.select(*by, F.explode(starts).alias("window_start"))
            .groupBy("window_start", *by).agg(F.count("*").alias("n")))


# log2 of a sketch's registers: a relative standard error of 1.04 / sqrt(4096), 1.6 %; 5 % are three of them.
SKETCH_LG_K = 12
SKETCH_ERROR = 0.05


def hourly_sketches(rows: DataFrame, ts: str, by: Sequence[str], unit: str, lg_k: int = SKETCH_LG_K) -> DataFrame:
    """`(window_start, group, sketch)`: the distinct units of an hour in at most 2**lg_k registers.

    For groups whose units are too many to be kept: sketches of any hours or parts of the log are merged by union.
    """
    return (rows.filter(F.col(unit).isNotNull()).groupBy(F.window(ts, "1 hour")["start"].alias("window_start"), *by)
            .agg(F.hll_sketch_agg(unit, F.lit(lg_k)).alias("sketch")))


def sketched_units(sketches: DataFrame, by: Sequence[str], hours: int = 8) -> DataFrame:
    """About the distinct units in every window of `hours` that starts on the hour, from hourly sketches.

    Within SKETCH_ERROR of `sliding_units` (of `tumbling_units` for one hour), exact for a few hundred units.
    """
    first = F.col("window_start") - F.expr(f"INTERVAL {hours - 1} HOURS")
    starts = F.sequence(first, F.col("window_start"), F.expr("INTERVAL 1 HOUR"))
    merged = sketches.select(*by, "sketch", F.explode(starts).alias("window_start")).groupBy("window_start", *by).agg(
        F.hll_union_agg("sketch").alias("sketch"))
    return merged.select("window_start", *by, F.hll_sketch_estimate("sketch").alias("n"))
