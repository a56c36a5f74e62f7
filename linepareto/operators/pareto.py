"""Roll-ups of counted failures: combined list, station Pareto, origin list."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from linepareto.operators.units import nonzero


def stack(relations: Sequence[DataFrame]) -> DataFrame:
    """Concatenate by column name, columns a relation lacks as null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), relations)


def with_lookback(df: DataFrame) -> list[str]:
    return ["lookback"] if "lookback" in df.columns else []


def combined(relations: Sequence[DataFrame]) -> DataFrame:
    """All counts by station and parameter; an alarm's label stands in for the parameter."""
    rows = stack(relations)
    label = (F.coalesce("alarm_description", "parameter_name")
             if "alarm_description" in rows.columns else F.col("parameter_name"))
    return nonzero(rows.select(*with_lookback(rows), "fail_count", "station_name",
                               label.alias("parameter_name")))


def by_count(rows: DataFrame, *ties: str) -> DataFrame:
    """Pareto order: largest count first, ties by the given columns."""
    return rows.orderBy(*with_lookback(rows), F.desc("fail_count"), *ties)


def by_count_and_station(rows: DataFrame, *ties: str) -> DataFrame:
    """Largest count first, then the station as a number; other stations last."""
    number = F.col("station_name").try_cast("int").asc_nulls_last()
    return rows.orderBy(*with_lookback(rows), F.desc("fail_count"), number, *ties)


def station_pareto(rows: DataFrame, override: DataFrame | None = None) -> DataFrame:
    """Failures per station, summed over its parameters.

    `override` holds `(station_name, n)` with distinct units; its count replaces the sum of
    the stations it names, which would count a unit once per failed parameter. It never adds
    a station.
    """
    by = [*with_lookback(rows), "station_name"]
    sums = (rows.filter(F.col("station_name").isNotNull())
            .groupBy(*by).agg(F.sum("fail_count").cast("bigint").alias("fail_count")))
    if override is not None:
        sums = (sums.join(override.select(*by, "n"), by, "left")
                .withColumn("fail_count", F.coalesce("n", "fail_count")).drop("n"))
    return nonzero(sums.withColumn("fail_count", F.coalesce("fail_count", F.lit(0))))
