"""Plant time: lookback thresholds, local/UTC predicates and report gates.

Thresholds are folded on the driver into typed literals, so the scan gets a plain
comparison with a bare column, which Parquet can prune on.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, functions as F, types as T


def local_literal(value: datetime) -> Column:
    """A `timestamp_ntz` literal that no session time zone can shift."""
    return F.lit(value.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")


def instant_literal(value: datetime) -> Column:
    """A `timestamp` literal for an instant with a zone."""
    return F.lit(value.astimezone(timezone.utc).isoformat(sep=" ")).cast("timestamp")


def to_local(as_of: datetime, tz: str) -> datetime:
    """The plant's wall clock at an instant, which needs its zone: the host's says nothing about a plant."""
    if as_of.tzinfo is None:
        raise ValueError(f"an instant with its time zone is needed, not {as_of}")
    return as_of.astimezone(ZoneInfo(tz)).replace(tzinfo=None)


def lookback_start(as_of: datetime, hours: int) -> datetime:
    """Top of the hour, `hours` before the plant-local `as_of`."""
    return (as_of - timedelta(hours=hours)).replace(minute=0, second=0, microsecond=0)


def after(ts: Column, start: datetime) -> Column:
    """Strictly newer than a plant-local threshold."""
    return ts > local_literal(start)


def since(df: DataFrame, ts_col: str, as_of: datetime, hours: int,
          upper: datetime | None = None) -> DataFrame:
    """Rows newer than the lookback threshold; open-ended unless `upper` is given."""
    kept = df.filter(after(F.col(ts_col), lookback_start(as_of, hours)))
    return kept if upper is None else kept.filter(F.col(ts_col) <= local_literal(upper))


def _utc(local: datetime, zone: ZoneInfo, fold: int) -> datetime:
    return local.replace(tzinfo=zone, fold=fold).astimezone(timezone.utc)


def _offset_change(zone: ZoneInfo, low: datetime, high: datetime) -> datetime:
    """The first second in (low, high] whose UTC offset differs from that at `low`."""
    before = low.astimezone(zone).utcoffset()
    span = int((high - low).total_seconds())
    left, right = 0, span
    while right - left > 1:
        middle = (left + right) // 2
        if (low + timedelta(seconds=middle)).astimezone(zone).utcoffset() == before:
            left = middle
        else:
            right = middle
    return low + timedelta(seconds=right)


def after_local(utc: Column, start: datetime, tz: str, ntz: bool = False) -> Column:
    """`plant time of utc > start`, written on the bare UTC column.

    Exact on days the clocks change as well. Where `start` occurs twice, the second pass
    through the repeated hour is left out up to `start`; where it does not exist, all from the
    change on is kept.
    """
    zone = ZoneInfo(tz)
    first, second = _utc(start, zone, 0), _utc(start, zone, 1)
    if ntz:
        def point(value):
            return local_literal(value)
    else:
        point = instant_literal
    if first == second:
        return utc > point(first)
    if first > second:  # a skipped hour: fold 0 and 1 lie on either side of the change
        return utc >= point(_offset_change(zone, second - timedelta(hours=2), first))
    change = _offset_change(zone, first, second)
    return (utc > point(first)) & ((utc < point(change)) | (utc > point(second)))


def is_ntz(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.TimestampNTZType)


def since_local(df: DataFrame, utc_col: str, tz: str, as_of: datetime, hours: int) -> DataFrame:
    """Lookback on a UTC column, the threshold in plant time."""
    start = lookback_start(as_of, hours)
    return df.filter(after_local(F.col(utc_col), start, tz, is_ntz(df, utc_col)))


def plant_time(df: DataFrame, utc_col: str, tz: str) -> Column:
    """Wall clock at the plant as `timestamp_ntz`."""
    source = F.lit("UTC") if is_ntz(df, utc_col) else F.current_timezone()
    return F.convert_timezone(source, F.lit(tz), F.col(utc_col))


def hour_floor(ts: Column) -> Column:
    """Top of the hour as `timestamp_ntz`; `date_trunc` alone returns a zoned timestamp."""
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def due(hour: Column, gate_hours: tuple[int, ...]) -> Column:
    """Is a report due at this plant hour? An empty gate is always open."""
    return hour.isin(*gate_hours) if gate_hours else F.lit(True)
