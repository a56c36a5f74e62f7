"""Running a stream over what has arrived, and reports refreshed by arriving data."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from linepareto.functions.times import is_ntz
from linepareto.plans.config import LineConfig
from linepareto.plans.report import deliver, deliver_line_report
from linepareto.plans.scans import hourly_partials
from linepareto.sources.tables import LineTables


@contextmanager
def state_partitions(spark: SparkSession) -> Iterator[None]:
    """Start queries with no more state partitions than tasks the cluster runs at once.

    A query keeps the number it started with; each partition is a state store per operator.
    """
    name = "spark.sql.shuffle.partitions"
    session = spark.conf.get(name)
    spark.conf.set(name, min(int(session), spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(name, session)


@contextmanager
def adaptive(spark: SparkSession, like: str) -> Iterator[None]:
    """Plan what a batch function runs adaptively, if `like` says so; Spark plans the stream itself without."""
    name = "spark.sql.adaptive.enabled"
    session = spark.conf.get(name)
    spark.conf.set(name, like)
    try:
        yield
    finally:
        spark.conf.set(name, session)


def run_available(stream: DataFrame, folder: str) -> DataFrame:
    """Process all data present, append the result to `folder`, and read it."""
    with state_partitions(stream.sparkSession):
        query = (stream.writeStream.format("parquet").outputMode("append")
                 .option("checkpointLocation", f"{folder}/checkpoint").option("path", f"{folder}/rows")
                 .trigger(availableNow=True).start())
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/rows")


def newest_instant(batch: DataFrame, ts: str, tz: str = "UTC") -> datetime | None:
    """The newest time of a batch as an instant; a zone-less column is the clock of `tz`."""
    if is_ntz(batch, ts):
        newest = batch.agg(F.max(ts).cast("string")).first()[0]
        return None if newest is None else datetime.fromisoformat(newest).replace(tzinfo=ZoneInfo(tz)).astimezone(timezone.utc)
    micros = batch.agg(F.unix_micros(F.max(ts))).first()[0]
    return None if micros is None else datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=micros)


def start_reports(arrivals: DataFrame, ts: str, build: Callable[[SparkSession, datetime], DataFrame],
                  folder: str, tz: str = "UTC", **trigger) -> StreamingQuery:
    """Write a report as of the newest time of every batch to `folder`/reports.

    `build` gets that time as an instant in UTC and reads the tables anew, so rows that came late
    are counted as long as they lie in a lookback. `tz` is the clock of a zone-less `ts`.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        newest = newest_instant(batch, ts, tz)
        if newest is not None:
            deliver(build(batch.sparkSession, newest), f"{folder}/reports/batch={batch_id}", "parquet")

    return (arrivals.writeStream.foreachBatch(process)
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(**(trigger or {"availableNow": True})).start())


def start_line_reports(records: DataFrame, tables: Callable[[SparkSession], LineTables], cfg: LineConfig, folder: str,
                       **trigger) -> StreamingQuery:
    """The line's whole report as of the newest measurement of every batch of `records`, to `folder`/reports.

    A batch is reduced to hourly partials, which are kept in `folder`/partials by batch and day, in one file a day
    unless there is much of it; a repeated batch overwrites its own. Reports are merged from the partials their lookbacks reach into, so the
    measurement log is read once, as it arrives, and late rows count from then on. Jobs, alarms and the genealogy
    come from `tables`. Nothing else is left of a report.
    """

    planned = records.sparkSession.conf.get("spark.sql.adaptive.enabled")

    def process(batch: DataFrame, batch_id: int) -> None:
        with adaptive(batch.sparkSession, planned):
            report(batch, batch_id)

    def report(batch: DataFrame, batch_id: int) -> None:
        spark, seen = batch.sparkSession, Observation()
        partials = hourly_partials(batch.observe(seen, F.max("recorded_at").cast("string").alias("newest")), cfg)
        schema = partials.schema
        by_day = partials.hint("rebalance", "day")  # else every task writes a file for each day
        by_day.write.mode("overwrite").partitionBy("day").parquet(f"{folder}/partials/batch={batch_id}")
        newest = seen.get["newest"]
        if newest is None:
            return
        as_of = datetime.fromisoformat(newest).replace(tzinfo=ZoneInfo(cfg.plant_tz)).astimezone(timezone.utc)
        kept = spark.read.schema(schema.add("batch", "long")).option("basePath", f"{folder}/partials").parquet(f"{folder}/partials")
        deliver_line_report(tables(spark), cfg, as_of, f"{folder}/reports/batch={batch_id}", "parquet", kept)

    return (records.writeStream.foreachBatch(process)
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(**(trigger or {"availableNow": True})).start())
