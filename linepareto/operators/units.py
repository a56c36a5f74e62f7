"""Counting failed units: by parameter, by station, over one or several lookbacks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from linepareto.functions.times import after

BY_PARAMETER = ("station_name", "parameter_name")


def scope(df: DataFrame, **equal) -> DataFrame:
    """Equality conjunction on the given columns; `None` leaves a column free."""
    for column, value in equal.items():
        if value is not None:
            df = df.filter(F.col(column) == value)
    return df


def fails_by_parameter(violations: DataFrame, by: Sequence[str] = BY_PARAMETER,
                       unit: str = "product_serial") -> DataFrame:
    """Distinct units per group. Spark shuffles on group and unit, so a hot group is split."""
    return violations.groupBy(*by).agg(F.countDistinct(unit).alias("fail_count"))


def unique_failed_units(violations: DataFrame) -> DataFrame:
    """Distinct units per station, whatever parameter failed."""
    return fails_by_parameter(violations, by=("station_name",)).withColumnRenamed("fail_count", "n")


def fails_multi_lookback(rows: DataFrame, ts: str, lookbacks: Mapping[str, datetime],
                         by: Sequence[str], unit: str = "product_serial") -> DataFrame:
    """Distinct units per group, one column per lookback, from a single pass.

    A unit counts in a lookback exactly if its newest row is inside, so the newest time per
    group and unit decides all of them: one combined row per unit is shuffled, however many
    lookbacks there are.
    """
    widest = min(lookbacks.values())
    newest = (rows.filter(after(F.col(ts), widest) & F.col(unit).isNotNull())
              .groupBy(*by, unit).agg(F.max(ts).alias("_newest")))
    return newest.groupBy(*by).agg(
        *[F.count_if(after(F.col("_newest"), start)).alias(name) for name, start in lookbacks.items()])


def tall(wide: DataFrame, lookbacks: Sequence[str], by: Sequence[str], keep_zero: bool = False) -> DataFrame:
    """One row per lookback and group instead of one column per lookback."""
    rows = wide.unpivot([F.col(c) for c in by], [F.col(c) for c in lookbacks], "lookback", "fail_count")
    return rows if keep_zero else nonzero(rows)


def nonzero(counts: DataFrame) -> DataFrame:
    """Drop groups nothing failed in."""
    return counts.filter(F.col("fail_count") > 0)


def count_units(rows: DataFrame, ts: str, lookbacks: Mapping[str, datetime],
                by: Sequence[str] = BY_PARAMETER, unit: str = "product_serial") -> DataFrame:
    """`(lookback, group, fail_count)` with distinct units, groups of no unit left out."""
    return tall(fails_multi_lookback(rows, ts, lookbacks, by, unit), list(lookbacks), by)
