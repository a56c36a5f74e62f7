"""Log tables laid out by day, so that a lookback opens only the days it reaches into, and sorted within;
genealogy and child records bucketed alike, so that they are joined where they lie."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from linepareto.operators.skew import HOT_ROWS, hot_keys

DAY = "log_day"
# The raw value of a measurement as a number, beside the text it is logged as.
NUMBER = "log_number"
# Beside the child in a bucket: which of a hot child's parts a scan is in, and which part a record is copied to.
SPREAD = "log_spread"
LAYOUT = (DAY, NUMBER, SPREAD)


def _day(df: DataFrame, ts: str) -> Column:
    return F.to_date(F.to_utc_timestamp(ts, F.current_timezone()) if dict(df.dtypes)[ts] == "timestamp" else F.col(ts))


def write_by_day(df: DataFrame, ts: str, path: str) -> None:
    """Append `df` to a Parquet table partitioned by the day of `ts` (of a zoned time: its UTC day)."""
    df.withColumn(DAY, _day(df, ts)).write.mode("append").partitionBy(DAY).parquet(path)


def write_clustered(df: DataFrame, ts: str, path: str, by: Sequence[str] = ("station_name", "parameter_name"),
                    raw: str | None = "parameter_value_raw", **options: str) -> None:
    """As `write_by_day`, each day's rows sorted by station and parameter, and `raw` as a number beside it.

    Files and their row groups then hold few stations and parameters, and a scan for some of them, or for raw
    values outside a band, skips the others by their statistics. Rows are cut by range, `ts` included, so a
    parameter with a large share of a day is spread over several files.
    """
    laid = df.withColumn(DAY, _day(df, ts))
    if raw is not None:
        laid = laid.withColumn(NUMBER, F.col(raw).try_cast("double"))
    laid = laid.repartitionByRange(DAY, *by, ts).sortWithinPartitions(DAY, *by, ts)
    laid.write.mode("append").options(**options).partitionBy(DAY).parquet(path)


def from_day(df: DataFrame, start: datetime, zones: bool = False) -> DataFrame:
    """Keep the days from `start` on, if `df` is laid out by day; else leave it to the time filter.

    With `zones`, `start` is local and the days are UTC: one more day is kept.
    """
    if DAY not in df.columns:
        return df
    first = (start - timedelta(days=1) if zones else start).date()
    return df.filter(F.col(DAY) >= F.lit(first))


def write_colocated(genealogy: DataFrame, records: DataFrame, names: tuple[str, str], buckets: int,
                    folder: str | None = None, min_hot_rows: int = HOT_ROWS) -> None:
    """Genealogy and child records as two catalog tables with the same buckets by child.

    Joins of the two on the child, and groups by child, then shuffle neither. Scans of a child with more
    than `min_hot_rows` are spread over several buckets, which all hold a copy of its records: of
    those there must be few per child. Scans without a child are spread as well. `once` gives every
    record a single time. The tables lie in the warehouse or, if given, below `folder`.
    """
    child = "scanned_child_serial"
    hot = F.broadcast(hot_keys(genealogy, child, min_hot_rows))
    part = F.pmod(F.xxhash64("product_serial"), F.when(F.col(child).isNull(), buckets).otherwise(F.coalesce("_fan", F.lit(1))))
    scans = genealogy.join(hot, child, "left").select(*genealogy.columns, part.cast("int").alias(SPREAD))
    parts = F.explode(F.sequence(F.lit(0), F.coalesce("_fan", F.lit(1)) - 1))
    copied = records.join(hot.withColumnRenamed(child, "product_serial"), "product_serial", "left") \
                    .select(*records.columns, parts.alias(SPREAD))
    for name, df, key in ((names[0], scans, child), (names[1], copied, "product_serial")):
        place = {"path": f"{folder}/{name}"} if folder else {}
        df.repartition(buckets, key, SPREAD).write.mode("overwrite").options(**place) \
          .bucketBy(buckets, key, SPREAD).sortBy(key, SPREAD).saveAsTable(name)


def once(records: DataFrame) -> DataFrame:
    """Every child record a single time, however it is laid out."""
    return records.filter(F.col(SPREAD) == 0).drop(SPREAD) if SPREAD in records.columns else records
