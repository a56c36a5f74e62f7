"""Debounced alarms on a stream.

`lag` is not available on streams, and a keyed state function would handle all alarms of a
busy source in one task. Each micro-batch therefore runs the batch operator. Alarms are held back
until the newest one seen is `delay` ahead of them, so those that come late, by up to the delay,
take their place before anything after them is decided; the result does not depend on how
arrivals were cut into batches. The state is the alarms held back and the last settled alarm of
every source, a table per batch, so a repeated batch starts from the same state and overwrites its
own output; only the last two are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from linepareto.operators.alarms import _order, gap_passed, with_prev_cleared
from linepareto.session import remove_folder

LAST, HELD = "last", "held"


def last_per_source(alarms: DataFrame) -> DataFrame:
    """The latest alarm of every source."""
    rest = [c for c in alarms.columns if c != "alarm_source"]
    latest = F.max_by(F.struct(*rest), F.struct(*_order(alarms)))
    return alarms.groupBy("alarm_source").agg(latest.alias("_last")).select(
        *[F.col(c) if c == "alarm_source" else F.col(f"_last.{c}").alias(c) for c in alarms.columns])


def debounce_batch(due: DataFrame, last: DataFrame | None, gap: str) -> tuple[DataFrame, DataFrame]:
    """Counted alarms among those due, and the last alarm of every source after them."""
    seen = due.withColumn("_old", F.lit(False))
    if last is not None:
        seen = seen.unionByName(last.withColumn("_old", F.lit(True)))
    counted = with_prev_cleared(seen, settled=True).filter(~F.col("_old") & gap_passed(gap))
    return counted.select(*due.columns), last_per_source(seen.drop("_old"))


def _state(spark: SparkSession, folder: str, batch: int, schema) -> tuple[DataFrame, DataFrame]:
    state = spark.read.schema(StructType([*schema.fields, StructField("_kind", StringType())])).parquet(f"{folder}/state/batch={batch}")
    return (state.filter(F.col("_kind") == LAST).drop("_kind"),
            state.filter(F.col("_kind") == HELD).drop("_kind"))


def _newest(alarms: DataFrame) -> str | None:
    return alarms.agg(F.max("activated_at").cast("string")).first()[0]


def start_debounce(alarms: DataFrame, folder: str, gap: str = "30 seconds", delay: str = "1 hour",
                   **trigger) -> StreamingQuery:
    """Run the debounce into `folder`/counted; `trigger` as for `DataStreamWriter.trigger`.

    Alarms later than `delay` behind the newest one are left out, as behind a watermark.
    """
    kind = alarms.schema["activated_at"].dataType

    def settled(newest: str) -> Column:
        """Before or at the line that nothing in time can fall behind any more; no time is the earliest."""
        line = F.lit(newest).cast(kind) - F.expr(f"INTERVAL {delay}")
        return F.col("activated_at").isNull() | (F.col("activated_at") <= line)

    def process(batch: DataFrame, batch_id: int) -> None:
        spark, schema = batch.sparkSession, batch.schema
        # settled in the shared folder: it is read several times
        batch.write.mode("overwrite").parquet(f"{folder}/arrived/batch={batch_id}")
        arrived, last = spark.read.schema(schema).parquet(f"{folder}/arrived/batch={batch_id}"), None
        if batch_id:
            last, held = _state(spark, folder, batch_id - 1, batch.schema)
            before = _newest(last.unionByName(held))
            if before is not None:
                arrived = arrived.filter(~settled(before) | F.col("activated_at").isNull())
            arrived = arrived.unionByName(held)
        newest = _newest(arrived if last is None else arrived.unionByName(last))
        ready = F.lit(True) if newest is None else settled(newest)
        counted, after = debounce_batch(arrived.filter(ready), last, gap)
        counted.write.mode("overwrite").parquet(f"{folder}/counted/batch={batch_id}")
        state = after.withColumn("_kind", F.lit(LAST)).unionByName(
            arrived.filter(~ready).withColumn("_kind", F.lit(HELD)))
        state.write.mode("overwrite").parquet(f"{folder}/state/batch={batch_id}")
        for name, old in (("arrived", batch_id - 1), ("state", batch_id - 2)):
            remove_folder(spark, f"{folder}/{name}/batch={old}")

    return (alarms.writeStream.foreachBatch(process)
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(**(trigger or {"availableNow": True})).start())


def finish_debounce(spark: SparkSession, query: StreamingQuery, folder: str, schema, gap: str = "30 seconds") -> DataFrame:
    """All counted alarms of a stopped query, those it still holds back decided without waiting longer."""
    counted = spark.read.schema(schema).parquet(f"{folder}/counted/batch=*")
    if not query.lastProgress:
        return counted
    last, held = _state(spark, folder, query.lastProgress["batchId"], schema)
    return counted.unionByName(debounce_batch(held, last, gap)[0])
