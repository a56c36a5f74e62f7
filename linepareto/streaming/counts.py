"""Distinct units per window on a stream.

`countDistinct` is not available on streams; units are dropped per window as duplicates, then
counted. State is spread by window, group and unit. Late rows count while the watermark
has not passed their window; a window is emitted once it has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from linepareto.functions.times import is_ntz
from linepareto.operators.windows import SKETCH_LG_K


def as_instant(rows: DataFrame, ts: str) -> DataFrame:
    """Watermarks need instants: read a zone-less column as UTC."""
    if not is_ntz(rows, ts):
        return rows
    shifted = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col(ts))
    return rows.withColumn(ts, shifted.cast("timestamp"))


def as_wall(instant: Column) -> Column:
    """An instant back to its UTC wall clock."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))


def stream_units(rows: DataFrame, ts: str, by: Sequence[str], unit: str, width: str = "1 hour",
                 slide: str | None = None, delay: str = "1 hour") -> DataFrame:
    """`(window_start, group, n)` per closed window; `slide`, which divides `width`, makes them overlap."""
    timed = as_instant(rows, ts).withWatermark(ts, delay).filter(F.col(unit).isNotNull())
    once = (timed.select(F.window(ts, slide or width).alias("window"), *by, unit)
            .dropDuplicates(["window", *by, unit]))
    if slide:  # one row per slide and unit goes into the windows over it, however often it was seen
        overlapping = F.window(F.window_time("window"), width, slide)
        once = once.select(overlapping.alias("window"), *by, unit).dropDuplicates(["window", *by, unit])
    counted = once.groupBy("window", *by).agg(F.count("*").alias("n"))
    return counted.select(as_wall(F.col("window.start")).alias("window_start"), *by, "n")


def stream_sketched_units(rows: DataFrame, ts: str, by: Sequence[str], unit: str, hours: int = 8, delay: str = "1 hour",
                          lg_k: int = SKETCH_LG_K) -> DataFrame:
    """As `stream_units` over windows of `hours` that start on the hour, but about: see `sketched_units`.

    The state is a sketch per hour and group instead of every unit seen.
    """
    timed = as_instant(rows, ts).withWatermark(ts, delay).filter(F.col(unit).isNotNull())
    hourly = timed.groupBy(F.window(ts, "1 hour").alias("window"), *by).agg(F.hll_sketch_agg(unit, F.lit(lg_k)).alias("sketch"))
    over = F.window(F.window_time("window"), f"{hours} hours", "1 hour")
    merged = hourly.groupBy(over.alias("window"), *by).agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select(as_wall(F.col("window.start")).alias("window_start"), *by, F.hll_sketch_estimate("sketch").alias("n"))
