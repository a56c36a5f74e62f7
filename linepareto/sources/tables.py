"""Readers of the five source tables, from a path or from the catalog."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from linepareto import schemas
from linepareto.sources.layout import LAYOUT

# Names the plant's own tables use where ours are shorter.
WAREHOUSE_COLUMNS = {
    "alarms": {"alarm_source": "alarm_source_scada_short_name"},
    "work_element_names": {
        "work_element": "DELMIA_WE_Name",
        "pin_pair": "Hairpins_In_Welded_Pin_Pair",
    },
}


class SchemaMismatch(ValueError):
    """A source lacks a declared column or holds it in another type."""


def conform(df: DataFrame, schema: T.StructType, renamed: Mapping[str, str] | None = None) -> DataFrame:
    """Project `df` on the declared columns; fail where one is absent or of another type."""
    renamed = renamed or {}
    found = {f.name.lower(): f.dataType for f in df.schema.fields}
    problems = []
    for field in schema.fields:
        source = renamed.get(field.name, field.name)
        kind = found.get(source.lower())
        if kind is None:
            problems.append(f"{source}: missing")
        elif kind != field.dataType:
            problems.append(f"{source}: {kind.simpleString()}, not {field.dataType.simpleString()}")
    if problems:
        raise SchemaMismatch("; ".join(problems))
    layout = [name for name in LAYOUT if name in df.columns]
    return df.select(*[F.col(renamed.get(f.name, f.name)).alias(f.name) for f in schema.fields], *layout)


def _read(spark: SparkSession, source: str, kind: str, schema: T.StructType, fmt: str,
          renamed: Mapping[str, str] | None) -> DataFrame:
    if fmt == "table":
        raw = spark.table(source)
    else:
        raw = spark.read.format(fmt).load(source)
    if renamed is None:
        present = {c.lower() for c in raw.columns}
        renamed = {ours: theirs for ours, theirs in WAREHOUSE_COLUMNS.get(kind, {}).items()
                   if theirs.lower() in present}
    return conform(raw, schema, renamed)


def param_records(spark, source, fmt="parquet", renamed=None) -> DataFrame:
    """The tall measurement log: one row per unit, station and parameter."""
    return _read(spark, source, "param_records", schemas.PARAM_RECORDS, fmt, renamed)


def jobs(spark, source, fmt="parquet", renamed=None) -> DataFrame:
    """Station jobs with their status."""
    return _read(spark, source, "jobs", schemas.JOBS, fmt, renamed)


def alarms(spark, source, fmt="parquet", renamed=None) -> DataFrame:
    """The alarm log, times in UTC."""
    return _read(spark, source, "alarms", schemas.ALARMS, fmt, renamed)


def genealogy(spark, source, fmt="parquet", renamed=None) -> DataFrame:
    """Parent/child edges between serials."""
    return _read(spark, source, "genealogy", schemas.GENEALOGY, fmt, renamed)


def work_element_names(spark, source, fmt="parquet", renamed=None) -> DataFrame:
    """Work element to pin-pair name."""
    return _read(spark, source, "work_element_names", schemas.WORK_ELEMENT_NAMES, fmt, renamed)


READERS = {"jobs": jobs, "param_records": param_records, "alarms": alarms,
           "genealogy": genealogy, "work_element_names": work_element_names}


class LineTables:
    """The source relations a report reads, each a DataFrame or a function that yields one.

    `child_records` holds the records of the child parts; it is the measurement log itself
    unless the plant keeps them elsewhere.
    """

    def __init__(self, **sources: DataFrame | Callable[[], DataFrame]):
        unknown = set(sources) - {*READERS, "child_records"}
        if unknown:
            raise TypeError(f"unknown relations: {sorted(unknown)}")
        self._sources = sources

    def _get(self, name: str) -> DataFrame:
        source = self._sources[name]
        if not isinstance(source, DataFrame):
            source = self._sources[name] = source()
        return source

    @property
    def jobs(self) -> DataFrame:
        return self._get("jobs")

    @property
    def param_records(self) -> DataFrame:
        return self._get("param_records")

    @property
    def alarms(self) -> DataFrame:
        return self._get("alarms")

    @property
    def genealogy(self) -> DataFrame:
        return self._get("genealogy")

    @property
    def work_element_names(self) -> DataFrame:
        return self._get("work_element_names")

    @property
    def child_records(self) -> DataFrame:
        return self._get("child_records" if "child_records" in self._sources else "param_records")


def line_tables(spark: SparkSession, sources: Mapping[str, str], fmt: str = "parquet") -> LineTables:
    """All five tables; `sources` maps each neutral name to a path or table name."""
    return LineTables(**{name: partial(read, spark, sources[name], fmt) for name, read in READERS.items()})
