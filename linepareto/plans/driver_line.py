"""Configuration and registered queries for the relations derived from the driver tables."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from linepareto import schemas
from linepareto.functions.text import icontains, key_after, short_pair_name
from linepareto.functions.times import after, due, hour_floor, plant_time, since, since_local
from linepareto.operators import alarms as al, genealogy as gen, pareto
from linepareto.operators.limits import Limit, LimitCheck, for_variant, limit_violations
from linepareto.operators.units import (
    count_units, fails_by_parameter, fails_multi_lookback, nonzero, scope, unique_failed_units)
from linepareto.operators.windows import hourly_sketches, sketched_units, sliding_units, tumbling_units
from linepareto.plans import families
from linepareto.plans.config import REPORTS, AlarmRule, LineConfig, Report, StatusCheck
from linepareto.plans.report import line_report
from linepareto.session import shared_folder
from linepareto.sources import driver_data
from linepareto.sources.layout import write_colocated
from linepareto.sources.tables import LineTables
from linepareto.streaming.counts import stream_sketched_units, stream_units
from linepareto.streaming.debounce import finish_debounce, start_debounce
from linepareto.streaming.runs import run_available, start_line_reports, start_reports

VISION = (
    Limit("020", "eq", "Quantity Value", None, 3, 48),
    Limit("020", "eq", "Discount Value", None, 0, 0.09),
    Limit("030", "eq", "Tax Value", None, 0.01, 0.07),
    Limit("040", "ilike", "%DEFECT%", None, 1000, 100000),
)
ELECTRICAL = (
    Limit("050", "eq", "Quantity Value", 2, 5, 45),
    Limit("050", "eq", "Tax Value", 2, 0, 0.07),
    Limit("070", "eq", "Tax Value", None, 0, 0),
)
LOCATED = (
    Limit("060", "eq", "Quantity Value", 1, 4, 47),
    Limit("060", "eq", "Discount Value", 2, 0, 0.05),
)
LIMITS = VISION + ELECTRICAL + LOCATED
PATTERNS = (
    Limit("010", "ilike", "%value%", None, 0, 50000),
    Limit("040", "ilike", "%DEFECT%", None, 1000, 100000),
    Limit("050", "ilike", "tax VALUE", None, 0, 0),
    Limit("070", "ilike", "Discount value", None, 0, 0),
)
SUMMARY = (Limit("030", "eq", "Tax Value", None, 0.01, 0.01, "summary"),)
ONE_SIDED = (Limit("010", "eq", "Quantity Value", 0, None, 45.0), Limit("010", "ilike", "%tax%", None, 0.01, None))
# apply to every station with theirs in its name
LOOSE = (Limit("0", "eq", "Tax Value", None, 0, 0.07), Limit("2", "ilike", "%DEFECT%", None, 1000, 90000),
         Limit("5", "eq", "Quantity Value", 2, 5, 45))

YEAR = 365 * 24
# the measurements are decades older than the alarms, so lookbacks are in years
DRIVER_REPORTS = tuple(
    Report(r.name, years * YEAR, r.gate, r.heading, r.pin_types, r.variant)
    for r, years in zip(REPORTS, (24, 26, 28)))
AS_OF = datetime(2024, 1, 31, 11, 20, tzinfo=timezone.utc)  # 05:20 at the plant: end of a shift

LINE = LineConfig(
    shop="SHOP1", line="LINE1", plant_tz="America/Chicago", fail_status="NOK", fail_result="FAIL",
    priorities=("high", "critical"), gap="30 seconds", job_station="020", job_location="02",
    force=StatusCheck("040", "Quantity Value", 1),
    plate=AlarmRule("050", "line1-050", "Assembly error%Task[301]", "Check plate"),
    gripper=AlarmRule("050", "LINE1-050", "Gripper%work"),
    weld=(AlarmRule("060", "LINE1-060", "Assembly error :", "Weld fail"),
          AlarmRule("080", "LINE1-080", "Assembly error :", "Weld fail"),
          AlarmRule("080", "LINE1-080", "Laser: General error", "Laser")),
    checks=(LimitCheck(VISION, "raw"), LimitCheck(ELECTRICAL, "num", "NOK"),
            LimitCheck(LOCATED, "num", "NOK", "id")),
    unique_check=LimitCheck(LOCATED, "num", "NOK", "name"),
    child_prefix="030", child_parameter="Nest", stack_parts=("STACK",),
    spool_parameter="batch", spool_value="spool-a", traced_status_station="050",
    traced_check=LimitCheck(LIMITS + SUMMARY, "raw"), reports=DRIVER_REPORTS,
)

# the same with lookbacks of days, which begin among the alarms
ALARM_LINE = replace(LINE, reports=tuple(r._replace(hours=days * 24) for r, days in zip(DRIVER_REPORTS, (6, 12, 27))))
# and for reports as of the newest measurement, whatever the hour
ARRIVALS_LINE = replace(LINE, reports=tuple(r._replace(hours=years * YEAR, gate=()) for r, years in zip(DRIVER_REPORTS, (1, 2, 4))))

START = datetime(1996, 1, 1)  # lookback threshold of the measurement queries
ALARM_START = datetime(2024, 1, 3, 6)  # and of the alarm queries, plant time
ONE = {"all": START}
ALARM_ONE = {"all": ALARM_START}
SEVERAL = {"n_short": datetime(2001, 3, 1), "n_mid": datetime(1999, 9, 1), "n_shift": START}
ALARM_SEVERAL = {"n_short": datetime(2024, 1, 29, 6), "n_mid": datetime(2024, 1, 15, 7),
                 "n_shift": ALARM_START}


BUCKETS = 16


def colocated(t: LineTables) -> LineTables:
    """`t` with genealogy and child records bucketed alike by child."""
    spark = t.genealogy.sparkSession
    folder = shared_folder(spark, "colocated")
    at = folder.rpartition("-")[2]
    names = (f"genealogy_{at}", f"child_records_{at}")
    write_colocated(t.genealogy, t.child_records, names, BUCKETS, folder)
    return LineTables(param_records=t.param_records, work_element_names=t.work_element_names,
                      genealogy=spark.table(names[0]), child_records=spark.table(names[1]))


def tables(spark: SparkSession, folder: str) -> LineTables:
    return driver_data.line_tables(driver_data.folder_reader(spark, folder))


def _records(t: LineTables) -> DataFrame:
    return scope(t.param_records, line_name=LINE.line).filter(after(F.col("recorded_at"), START))


def _failed(t: LineTables) -> DataFrame:
    return scope(_records(t), overall_process_status="NOK")


def _alarms(t: LineTables, source: str, start: datetime | None = ALARM_START) -> DataFrame:
    return al.alarm_scope(t.alarms, source, LINE.priorities, start, LINE.plant_tz)


def _described(alarms: DataFrame, text: str) -> DataFrame:
    return alarms.filter(icontains(F.col("alarm_description"), text))


def station_job_fails(t: LineTables) -> DataFrame:
    failed = scope(t.jobs, shop_name="SHOP1", line_name="LINE1", station_name="020",
                   work_location_name="02", job_status="NOK")
    recent = since(failed, "started_at", START, 0).withColumnRenamed("work_location_desc", "parameter_name")
    return fails_by_parameter(recent)


def limit_violations_by_parameter(t: LineTables) -> DataFrame:
    return fails_by_parameter(limit_violations(_failed(t), LIMITS))


def limit_violations_variant(t: LineTables) -> DataFrame:
    return fails_by_parameter(limit_violations(_records(t), for_variant(LIMITS + SUMMARY, "summary")))


def limit_violations_table(t: LineTables) -> DataFrame:
    """Limits from a table, with a variant, a side without a bound and location 0 for any."""
    rows = [x._replace(lo=None if x.lo is None else float(x.lo), hi=None if x.hi is None else float(x.hi))
            for x in LIMITS + SUMMARY + ONE_SIDED]
    limits = t.param_records.sparkSession.createDataFrame(rows, schemas.LIMITS)
    return fails_by_parameter(limit_violations(_records(t), limits, variant="summary"))


def limit_violations_loose(t: LineTables) -> DataFrame:
    return fails_by_parameter(limit_violations(_records(t), LOOSE, loose_stations=True))


def alarm_debounced(t: LineTables) -> DataFrame:
    counted = _described(al.debounce(_alarms(t, "LINE1-050")), LINE.plate.description)
    return al.count_alarms(counted, "050", "Check plate", "parameter_name", keep_empty=True)


def alarm_count_constant_group(t: LineTables) -> DataFrame:
    return al.count_alarms(_described(_alarms(t, "line1-060"), "Assembly error :"), "060", "Weld fail")


def alarm_by_extracted_key(t: LineTables) -> DataFrame:
    return al.count_by_key(_described(_alarms(t, "LINE1-050"), "Gripper%work"), "050")


def alarm_debounced_and_keys(t: LineTables) -> DataFrame:
    return pareto.stack([alarm_debounced(t), alarm_by_extracted_key(t)])


def alarm_local_time(t: LineTables) -> DataFrame:
    local = since_local(t.alarms, "activated_at", LINE.plant_tz, ALARM_START, 0)
    hour = hour_floor(plant_time(t.alarms, "activated_at", LINE.plant_tz))
    return local.groupBy(hour.alias("local_hour")).agg(F.count("*").alias("n"))


def lookback_debounced(t: LineTables) -> DataFrame:
    ordered = al.with_prev_cleared(_alarms(t, "LINE1-050"))
    flags = al.debounced_flags(ordered, ALARM_SEVERAL, LINE.plant_tz)
    return al.count_flags(ordered, flags, ["alarm_source"])


def due_reports(t: LineTables) -> DataFrame:
    hour = F.hour(plant_time(t.alarms, "activated_at", LINE.plant_tz))
    per_hour = t.alarms.groupBy(hour.alias("local_hour")).agg(F.count("*").alias("n"))
    return per_hour.select("local_hour", "n", *[
        due(F.col("local_hour"), r.gate).cast("int").alias(r.name) for r in REPORTS])


def _single(rows: DataFrame) -> DataFrame:
    return rows.drop("lookback")


def _spans(rows: DataFrame) -> DataFrame:
    return rows.select("lookback", *[c for c in rows.columns if c != "lookback"])


def short_pair_names(t: LineTables) -> DataFrame:
    named = t.work_element_names.select(short_pair_name(F.col("pin_pair")).alias("pin_type"))
    return named.groupBy("pin_type").agg(F.count("*").alias("n"))


def batch_queries() -> dict:
    """Queries on the derived relations, `name -> f(tables)`."""
    units = ("alarm_source",)
    return {
        "station_job_fails": station_job_fails,
        "status_fails": lambda t: _single(families.force_fails(t, LINE, ONE)),
        "limit_violations_by_parameter": limit_violations_by_parameter,
        "limit_violations_unfiltered_status":
            lambda t: fails_by_parameter(limit_violations(_records(t), LIMITS)),
        "limit_violations_numeric":
            lambda t: fails_by_parameter(limit_violations(_records(t), LIMITS, "num", "NOK")),
        "limit_violations_by_location":
            lambda t: fails_by_parameter(limit_violations(_records(t), ELECTRICAL + LOCATED, "num")),
        "limit_violations_patterns":
            lambda t: fails_by_parameter(limit_violations(_records(t), PATTERNS)),
        "limit_violations_variant": limit_violations_variant,
        "limit_violations_table": limit_violations_table,
        "limit_violations_loose": limit_violations_loose,
        "limit_violations_one_scan": lambda t: _single(families.limit_fails(t, LINE, ONE)),
        "unique_failed_units":
            lambda t: unique_failed_units(limit_violations(_failed(t), LOCATED, "num", location="name")),
        "alarm_count_constant_group": alarm_count_constant_group,
        "alarm_weld_and_laser": lambda t: _single(families.weld_fails(t, LINE, ALARM_ONE)),
        "alarm_debounced": alarm_debounced,
        "alarm_by_extracted_key": alarm_by_extracted_key,
        "alarm_debounced_and_keys": alarm_debounced_and_keys,
        "alarm_local_time": alarm_local_time,
        "origin_rowcount": lambda t: _single(families.force_fails_by_origin(t, LINE, ONE)),
        "origin_units_status": lambda t: _single(families.result_fails_by_origin(t, LINE, ONE)),
        "origin_units_limits": lambda t: _single(families.limit_fails_by_origin(t, LINE, ONE)),
        "origin_units_shuffled":
            lambda t: _single(families.limit_fails_by_origin(t, LINE, ONE, max_keys=0)),
        "origin_rowcount_colocated":
            lambda t: _single(families.force_fails_by_origin(colocated(t), LINE, ONE)),
        "origin_units_colocated":
            lambda t: _single(families.limit_fails_by_origin(colocated(t), LINE, ONE, max_keys=0)),
        "pin_type_units_colocated": lambda t: _single(families.limit_fails_by_pin_type(colocated(t), LINE, ONE)),
        "pin_type_units": lambda t: _single(families.limit_fails_by_pin_type(t, LINE, ONE)),
        "origin_pareto":
            lambda t: pareto.by_count_and_station(_single(families.by_origin(t, LINE, ONE)), "origin"),
        "short_pair_names": short_pair_names,
        "combined_pareto":
            lambda t: pareto.by_count(_single(families.by_parameter(t, LINE, ONE)),
                                      "station_name", "parameter_name"),
        "station_pareto_sum": lambda t: _single(families.by_station(t, LINE, ONE, unique=False)),
        "station_pareto_override": lambda t: _single(families.by_station(t, LINE, ONE)),
        "lookback_1_4_8":
            lambda t: fails_multi_lookback(limit_violations(_records(t), LIMITS), "recorded_at", SEVERAL,
                                           ["station_name"]),
        "lookback_by_parameter":
            lambda t: _spans(count_units(limit_violations(_records(t), LIMITS), "recorded_at", SEVERAL)),
        "lookback_origin": lambda t: _spans(families.force_fails_by_origin(t, LINE, SEVERAL)),
        "lookback_debounced": lookback_debounced,
        "windowed_units": lambda t: tumbling_units(t.alarms, "activated_at", units, "alarm_description")
            .withColumnRenamed("window_start", "hour_start"),
        "sliding_units": lambda t: sliding_units(t.alarms, "activated_at", units, "alarm_description"),
        "sketched_units": lambda t: sketched_units(hourly_sketches(t.alarms, "activated_at", units, "alarm_description"), units),
        "due_reports": due_reports,
        "report_sections": lambda t: line_report(t, LINE, AS_OF),
        "report_sections_alarms": lambda t: line_report(t, ALARM_LINE, AS_OF),
    }


def _stream_tables(spark: SparkSession, folder: str):
    return driver_data.stream_reader(spark, folder)


def stream_units_query(spark: SparkSession, folder: str) -> DataFrame:
    alarms = driver_data.alarms(_stream_tables(spark, folder)("events"))
    counted = stream_units(alarms, "activated_at", ["alarm_source"], "alarm_description")
    return run_available(counted, shared_folder(spark, "stream_units"))


def stream_sliding_units(spark: SparkSession, folder: str) -> DataFrame:
    alarms = driver_data.alarms(_stream_tables(spark, folder)("events"))
    counted = stream_units(alarms, "activated_at", ["alarm_source"], "alarm_description",
                           "8 hours", "1 hour")
    return run_available(counted, shared_folder(spark, "stream_sliding_units"))


def stream_sketches(spark: SparkSession, folder: str) -> DataFrame:
    alarms = driver_data.alarms(_stream_tables(spark, folder)("events"))
    counted = stream_sketched_units(alarms, "activated_at", ["alarm_source"], "alarm_description")
    return run_available(counted, shared_folder(spark, "stream_sketches"))


def stream_debounced(spark: SparkSession, folder: str) -> DataFrame:
    alarms = driver_data.alarms(_stream_tables(spark, folder)("events"))
    target = shared_folder(spark, "stream_debounced")
    query = start_debounce(alarms, target)
    query.awaitTermination()
    return finish_debounce(spark, query, target, alarms.schema).groupBy("alarm_source").agg(F.count("*").alias("n"))


def stream_limit_check(spark: SparkSession, folder: str) -> DataFrame:
    records = driver_data.param_records(_stream_tables(spark, folder)("lineitem"))
    found = limit_violations(records, LIMITS).select("product_serial", "station_name", "parameter_name")
    rows = run_available(found, shared_folder(spark, "stream_limit_check"))
    return fails_by_parameter(rows)


def stream_report(spark: SparkSession, folder: str) -> DataFrame:
    arrivals = driver_data.jobs(_stream_tables(spark, folder)("orders"))
    target = shared_folder(spark, "stream_report")

    def build(session: SparkSession, newest: datetime) -> DataFrame:
        start = {"all": newest.replace(year=newest.year - 4, tzinfo=None)}
        return nonzero(_single(families.job_fails(tables(session, folder), LINE, start)))

    def ordered(session, newest):
        lines = build(session, newest)
        return lines.select(
            F.lit(1).alias("report_no"), F.lit("jobs").alias("report"), F.lit(1).alias("section_no"),
            F.lit(None).cast("string").alias("title"), "fail_count", "station_name",
            F.col("parameter_name").alias("detail"))

    start_reports(arrivals, "started_at", ordered, target).awaitTermination()
    return spark.read.parquet(f"{target}/reports/batch=*").drop("title")


def stream_line_report(spark: SparkSession, folder: str) -> DataFrame:
    """The whole report as of the newest measurement, built as measurements arrive."""
    records = driver_data.param_records(_stream_tables(spark, folder)("lineitem"))
    target = shared_folder(spark, "stream_line_report")
    start_line_reports(records, lambda session: tables(session, folder), ARRIVALS_LINE, target).awaitTermination()
    return spark.read.parquet(f"{target}/reports/batch=*")


def queries() -> dict:
    """All registered queries, `name -> f(spark, folder)`."""
    def on_tables(query):
        return lambda spark, folder: query(tables(spark, folder))

    registered = {name: on_tables(query) for name, query in batch_queries().items()}
    return registered | {
        "stream_units": stream_units_query,
        "stream_sliding_units": stream_sliding_units,
        "stream_sketches": stream_sketches,
        "stream_debounced": stream_debounced,
        "stream_limit_check": stream_limit_check,
        "stream_report": stream_report,
        "stream_line_report": stream_line_report,
    }
