"""The report as a relation: titled sections, one row per title and per line."""

from __future__ import annotations

from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from linepareto.functions.times import to_local
from linepareto.operators.pareto import stack
from linepareto.operators.settle import settle, together
from linepareto.plans import families
from linepareto.plans.config import SECTION_TITLES, LineConfig, Report
from linepareto.plans.scans import BY_PARAMETER_LISTS, ORIGIN_LISTS, PINS, UNIQUE, MergedScans, Scans
from linepareto.session import published, run
from linepareto.sources.tables import LineTables

DETAILS = ("parameter_name", "origin", "pin_type")


def section_titles(cfg: LineConfig, as_of: datetime) -> list[tuple[int, str, int, str | None]]:
    """`(report_no, report, section_no, title)` of all sections due; section 0 is the heading."""
    stamp = to_local(as_of, cfg.plant_tz).strftime("%Y-%m-%d %H:00")
    starts = cfg.starts(as_of)
    rows = []
    for number, report in enumerate(cfg.due(as_of), start=1):
        until = stamp if report.heading else stamp.split(" ")[1]
        span = f"{starts[report.name]:%Y-%m-%d %H:00} to {until}"
        if report.heading:
            rows.append((number, report.name, 0, report.heading))
        rows.append((number, report.name, 1, f"{SECTION_TITLES[0]} {span}"))
        rows += [(number, report.name, 2, SECTION_TITLES[1]), (number, report.name, 3, SECTION_TITLES[2])]
        # the pin types of a headed report follow without a title of their own
        if report.pin_types:
            rows.append((number, report.name, 4, None if report.heading else SECTION_TITLES[3]))
    return rows


def _titles_frame(spark: SparkSession, rows) -> DataFrame:
    kinds = {"report_no": pa.int32(), "report": pa.string(), "section_no": pa.int32(), "title": pa.string()}
    columns = list(zip(*rows))
    return spark.createDataFrame(pa.table(
        [pa.array(list(c), k) for c, k in zip(columns, kinds.values())], names=list(kinds)))


def _report_no(due: tuple[Report, ...]) -> Column:
    number = F.lit(None).cast("int")
    for at, report in enumerate(due, start=1):
        number = F.when(F.col("lookback") == report.name, at).otherwise(number)
    return number


def line_report(tables: LineTables, cfg: LineConfig, as_of: datetime, partials: DataFrame | None = None) -> DataFrame:
    """All reports due at `as_of`, each list counted in one pass for all of them, from one scan of every log.

    With hourly `partials` of the measurements these stand in for their log.

    Columns: report_no, report, section_no, title (of title rows), fail_count, station_name,
    detail and body_json (of lines). `in_report_order` gives the reading order.
    """
    due = cfg.due(as_of)
    starts = cfg.starts(as_of)
    with_pins = {r.name: starts[r.name] for r in due if r.pin_types}
    lists = BY_PARAMETER_LISTS | ORIGIN_LISTS | {UNIQUE} | ({PINS} if with_pins else set())
    scans = (Scans(tables, cfg, starts, lists, with_pins) if partials is None
             else MergedScans(tables, cfg, starts, lists, with_pins, partials))
    together(lambda: scans.failures, lambda: scans.alarms)  # before what is read off them
    counted, (origins, pins) = together(
        lambda: settle(families.by_parameter(tables, cfg, starts, scans), "by_parameter").df,
        lambda: families.by_origin_and_pin_type(tables, cfg, starts, with_pins, scans))
    sections = [counted, families.by_station(tables, cfg, starts, counted=counted, scans=scans), origins]
    if pins is not None:
        sections.append(pins)
    lines = []
    for number, rows in enumerate(sections, start=1):
        details = [c for c in DETAILS if c in rows.columns]
        lines.append(rows.select(
            _report_no(due).alias("report_no"), F.col("lookback").alias("report"),
            F.lit(number).alias("section_no"), F.lit(None).cast("string").alias("title"),
            "fail_count", "station_name",
            F.concat_ws(" / ", *details).alias("detail"),
            F.to_json(F.struct("fail_count", "station_name", *details)).alias("body_json")))
    titles = _titles_frame(tables.jobs.sparkSession, section_titles(cfg, as_of))
    return stack([titles, *lines])


def in_report_order(report: DataFrame) -> DataFrame:
    """Sections in order, each title before its lines, lines by count and station."""
    return report.orderBy("report_no", "section_no", F.desc_nulls_first("fail_count"),
                          F.col("station_name").try_cast("int").asc_nulls_last(), "station_name", "detail")


def deliver(report: DataFrame, path: str, fmt: str = "json") -> None:
    """Write the report in reading order; an earlier one there stays until all of this one is written."""
    with published(report.sparkSession, path) as staged:
        in_report_order(report).write.format(fmt).save(staged)


def deliver_line_report(tables: LineTables, cfg: LineConfig, as_of: datetime, path: str, fmt: str = "json",
                        partials: DataFrame | None = None) -> None:
    """Build and write the report as of an instant; no intermediate table of it is left."""
    with run(tables.jobs.sparkSession):
        deliver(line_report(tables, cfg, as_of, partials), path, fmt)
