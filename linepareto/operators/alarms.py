"""Alarm counts: plain, debounced, and by a key in the description."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from linepareto.functions.text import icontains, key_after
from linepareto.functions.times import after_local, is_ntz
from linepareto.operators.settle import settle
from linepareto.sources.layout import from_day


def alarm_scope(alarms: DataFrame, source: str, priorities: Sequence[str],
                start: datetime | None = None, tz: str = "UTC") -> DataFrame:
    """Alarms of the sources containing `source`, of these priorities, newer than plant time `start`."""
    if start is not None:
        alarms = from_day(alarms, start, zones=True)
    kept = alarms.filter(F.col("alarm_priority_desc").isin(*priorities)
                         & icontains(F.col("alarm_source"), source))
    if start is not None:
        kept = kept.filter(after_local(F.col("activated_at"), start, tz, is_ntz(alarms, "activated_at")))
    return kept


def _order(alarms: DataFrame) -> list[str]:
    ties = ["event_id"] if "event_id" in alarms.columns else ["alarm_description", "cleared_at"]
    return ["activated_at", *ties]


# Seconds of the time slices alarms are ordered in, finest first; each divides the next.
SLICES = (60, 86_400)


def _seconds(rows: DataFrame, time: str) -> Column:
    """Whole seconds since 1970 of an instant, or of a zone-less time as it stands; null stays null."""
    t = F.col(time)
    if not is_ntz(rows, time):
        return F.unix_seconds(t)
    days = F.datediff(F.to_date(t), F.to_date(F.lit("1970-01-01"))).cast("long")
    return days * 86_400 + F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)


def _previous(rows: DataFrame, at: Column, order: Sequence[str], value: str, result: str,
              slices: Sequence[int]) -> DataFrame:
    """Add `value` of the row before, per source; `at` is the second a row belongs to.

    Rows are ordered within slices of time, so a busy source is spread over many tasks. The
    first row of a slice takes the last value of the source's slice before, which is found the
    same way among the last rows of all slices, in the next coarser slices. Rows without a source
    are a source of their own, rows without a time the earliest slice, as a plain order has them.
    """
    if not slices:
        whole = Window.partitionBy("alarm_source").orderBy(*order)
        return rows.withColumn(result, F.lag(value).over(whole))
    name, last, carried = f"_slice{len(slices)}", f"_last{len(slices)}", f"_carried{len(slices)}"
    sliced = rows.withColumn(name, F.floor(at / slices[0]))
    inside = Window.partitionBy("alarm_source", name).orderBy(*order)
    local = sliced.withColumns({"_first": F.row_number().over(inside) == 1,
                                result: F.lag(value).over(inside)})
    ends = sliced.groupBy("alarm_source", name).agg(F.max_by(value, F.struct(*order)).alias(last))
    ends = _previous(ends, F.col(name) * slices[0], [name], last, carried, slices[1:]).select(
        F.col("alarm_source").alias("_source"), F.col(name).alias("_at"), carried)
    joined = local.join(ends, F.col("alarm_source").eqNullSafe(F.col("_source")) & F.col(name).eqNullSafe(F.col("_at")),
                        "left")
    found = F.when(F.col("_first"), F.col(carried)).otherwise(F.col(result))
    return joined.withColumn(result, found).drop(name, carried, "_first", "_source", "_at")


def with_prev_cleared(alarms: DataFrame, slices: Sequence[int] = SLICES, settled: bool = False) -> DataFrame:
    """Add times of the alarm before, per source, in order of activation.

    Adds `prev_activated_at` (null: no alarm before) and `prev_cleared_at` (null as well if
    that alarm never cleared). The slices are read several times, so alarms that are not `settled` are settled
    first: their log is scanned once, and what is read again is only what passed its filters.
    """
    if not settled:
        alarms = settle(alarms, "alarms").df
    times = alarms.withColumn("_times", F.struct("activated_at", "cleared_at"))
    found = _previous(times, _seconds(alarms, "activated_at"), _order(alarms), "_times", "_prev", slices)
    return found.select(*alarms.columns, F.col("_prev.activated_at").alias("prev_activated_at"),
                        F.col("_prev.cleared_at").alias("prev_cleared_at"))


def gap_passed(gap: str) -> Column:
    """Activated more than `gap` after the alarm before cleared, or no such clear time."""
    later = F.col("activated_at") > F.col("prev_cleared_at") + F.expr(f"INTERVAL {gap}")
    return later | F.col("prev_cleared_at").isNull()


def debounce(alarms: DataFrame, gap: str = "30 seconds", slices: Sequence[int] = SLICES) -> DataFrame:
    """Alarms that do not follow the one before of their source too closely.

    Filter by source, time and priority before, by description after: an alarm of another
    description resets the gap.
    """
    return with_prev_cleared(alarms, slices).filter(gap_passed(gap))


def count_alarms(alarms: DataFrame, station: str, label: str, label_column: str = "alarm_description",
                 keep_empty: bool = False) -> DataFrame:
    """One row with the number of alarms; without alarms none, or a zero row if `keep_empty`."""
    counted = alarms.agg(F.count("*").alias("fail_count"))
    if not keep_empty:
        counted = counted.filter(F.col("fail_count") > 0)
    return counted.select("fail_count", F.lit(station).alias("station_name"), F.lit(label).alias(label_column))


def count_by_key(alarms: DataFrame, station: str, marker: str = "Key") -> DataFrame:
    """Alarms per key named in their description."""
    return (alarms.groupBy(key_after(F.col("alarm_description"), marker).alias("parameter_name"))
            .agg(F.count("*").alias("fail_count"))
            .select("fail_count", F.lit(station).alias("station_name"), "parameter_name"))


def lookback_flags(alarms: DataFrame, lookbacks: Mapping[str, datetime], tz: str,
                   column: str = "activated_at") -> dict[str, Column]:
    """Per lookback: is `column` newer than its plant-time threshold?"""
    ntz = is_ntz(alarms, column)
    return {name: after_local(F.col(column), start, tz, ntz) for name, start in lookbacks.items()}


def debounced_flags(debounced_from: DataFrame, lookbacks: Mapping[str, datetime], tz: str,
                    gap: str = "30 seconds") -> dict[str, Column]:
    """Per lookback: does the alarm count there, from one `with_prev_cleared` over the widest?

    The alarm before only matters where it lies in the same lookback.
    """
    now = lookback_flags(debounced_from, lookbacks, tz)
    before = lookback_flags(debounced_from, lookbacks, tz, "prev_activated_at")
    return {name: now[name] & (F.col("prev_activated_at").isNull() | ~before[name] | gap_passed(gap))
            for name in lookbacks}


def count_flags(alarms: DataFrame, flags: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Alarms per group, one column per flag."""
    return alarms.groupBy(*by).agg(*[F.count_if(flag).alias(name) for name, flag in flags.items()])
