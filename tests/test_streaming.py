import shutil
from datetime import datetime, timezone, timedelta

import pytest
from pyspark.sql import functions as F

from linepareto.operators.alarms import debounce
from linepareto.operators.limits import limit_violations
from linepareto.operators.windows import sliding_units, tumbling_units
from linepareto.plans.driver_line import LIMITS
from linepareto.sources import driver_data
from linepareto.streaming.counts import stream_units
from linepareto.streaming.debounce import finish_debounce, start_debounce
from linepareto.streaming.runs import run_available, start_reports

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    """The events in four files that arrive in order of time."""
    folder = tmp_path_factory.mktemp("events")
    rows = spark.read.parquet(f"{FOLDER}/events.parquet")
    for i, (low, high) in enumerate(zip((0, 250, 500, 750), (250, 500, 750, 10**9))):
        part = rows.filter((F.col("event_id") >= low) & (F.col("event_id") < high))
        part.coalesce(1).write.parquet(str(folder / f"events.parquet/{i}"))
    return str(folder)


def stream(spark, folder):
    reader = spark.readStream.schema(driver_data.BASE_SCHEMAS["events"])
    return driver_data.alarms(reader.option("maxFilesPerTrigger", 1).parquet(f"{folder}/events.parquet/*"))


def batch(spark, folder):
    return driver_data.alarms(spark.read.parquet(f"{folder}/events.parquet/*"))


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("hours", [1, 8])
def test_closed_windows_equal_batch(spark, events, tmp_path, hours):
    by = ["alarm_source"]
    slide = "1 hour" if hours > 1 else None
    counted = stream_units(stream(spark, events), "activated_at", by, "alarm_description", f"{hours} hours", slide)
    got = run_available(counted, str(tmp_path / "run"))
    alarms = batch(spark, events)
    same = (tumbling_units(alarms, "activated_at", by, "alarm_description") if hours == 1 else
            sliding_units(alarms, "activated_at", by, "alarm_description", hours))
    newest = alarms.agg(F.max("activated_at")).first()[0] - timedelta(hours=1)
    closed = same.filter(F.col("window_start") + F.expr(f"INTERVAL {hours} HOURS")
                         <= F.lit(str(newest)).cast("timestamp_ntz"))
    assert rows(got) == rows(closed)
    assert 0 < closed.count() < same.count()


def test_sliding_batch_equals_plain_distinct(spark, events):
    alarms = batch(spark, events)
    plain = (alarms.groupBy(F.window("activated_at", "8 hours", "1 hour")["start"].alias("window_start"), "alarm_source")
             .agg(F.countDistinct("alarm_description").alias("n")))
    assert rows(sliding_units(alarms, "activated_at", ["alarm_source"], "alarm_description")) == rows(plain)


def test_debounce_over_batches_equals_batch(spark, events, tmp_path):
    folder, alarms = str(tmp_path / "run"), stream(spark, events)
    query = start_debounce(alarms, folder)
    query.awaitTermination()
    got = finish_debounce(spark, query, folder, alarms.schema)
    plain = debounce(batch(spark, events)).drop("prev_activated_at", "prev_cleared_at")
    assert rows(got) == rows(plain)
    assert sorted(p.name for p in (tmp_path / "run" / "state").iterdir()) == ["batch=2", "batch=3"]


def test_late_alarms_within_the_delay_equal_batch(spark, events, tmp_path):
    """Arrivals in another order than the alarms', by up to 50 minutes."""
    alarms = batch(spark, events)
    jitter = F.pmod(F.xxhash64("event_id"), F.lit(3000)).cast("int")
    order = F.unix_seconds(F.col("activated_at").cast("timestamp")) + jitter
    bounds = alarms.select(F.percentile(order, F.array(*[F.lit(k / 5) for k in range(1, 5)]))).first()[0]
    part = sum(((order > b).cast("int") for b in bounds), F.lit(0))
    for k in range(5):
        alarms.filter(part == k).coalesce(1).write.mode("append").parquet(str(tmp_path / "late"))
    late = spark.readStream.schema(alarms.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "late"))
    folder = str(tmp_path / "run")
    query = start_debounce(late, folder, delay="1 hour")
    query.awaitTermination()
    assert rows(finish_debounce(spark, query, folder, alarms.schema)) == rows(debounce(alarms).select(*alarms.columns))


def test_repeated_batch_gives_the_same_rows(spark, events, tmp_path):
    folder = tmp_path / "run"
    start_debounce(stream(spark, events), str(folder)).awaitTermination()
    before = rows(spark.read.parquet(f"{folder}/counted/batch=*"))
    # as after a crash between the work of the last batch and its commit
    for name in ("3", ".3.crc"):
        (folder / "checkpoint" / "commits" / name).unlink(missing_ok=True)
    start_debounce(stream(spark, events), str(folder)).awaitTermination()
    assert rows(spark.read.parquet(f"{folder}/counted/batch=*")) == before


def test_limit_check_on_a_stream(spark, tmp_path):
    read = driver_data.stream_reader(spark, FOLDER)
    found = limit_violations(driver_data.param_records(read("lineitem")), LIMITS)
    got = run_available(found, str(tmp_path / "run"))
    same = limit_violations(driver_data.param_records(driver_data.folder_reader(spark, FOLDER)("lineitem")), LIMITS)
    assert got.count() == same.count() > 0
    assert rows(got.groupBy("station_name", "parameter_name").count()) == rows(
        same.groupBy("station_name", "parameter_name").count())


def test_report_per_arrival(spark, events, tmp_path):
    def build(session, newest):
        assert isinstance(newest, datetime)
        seen = session.createDataFrame([(1, 1, 2, "050", "x")], """report_no int, section_no int, fail_count bigint,
          station_name string, detail string""")
        return seen.withColumn("as_of", F.lit(str(newest)))

    folder = str(tmp_path / "run")
    start_reports(stream(spark, events), "activated_at", build, folder).awaitTermination()
    reports = spark.read.parquet(f"{folder}/reports/batch=*")
    assert reports.count() == 4
    last = batch(spark, events).agg(F.max("activated_at").cast("string")).first()[0]
    assert reports.agg(F.max("as_of")).first()[0] == str(datetime.fromisoformat(last).replace(tzinfo=timezone.utc))


def test_line_reports_of_several_arrivals_equal_batch_reports(spark, tmp_path):
    """Three arrivals out of order; each report equals the batch report over what has arrived, and leaves nothing else."""
    import time
    from datetime import datetime, timezone
    from pathlib import Path
    from zoneinfo import ZoneInfo

    import pyarrow.parquet as pq

    from linepareto import session
    from linepareto.plans import driver_line as d
    from linepareto.plans.report import line_report
    from linepareto.sources import driver_data
    from linepareto.sources.tables import LineTables
    from linepareto.streaming.runs import start_line_reports

    folder = "/root/testdata/sf0.001"
    whole = pq.read_table(f"{folder}/lineitem.parquet").sort_by("l_partkey")
    log = tmp_path / "log"
    log.mkdir()
    third = whole.num_rows // 3
    for k in range(3):
        pq.write_table(whole.slice(k * third, third if k < 2 else None), log / f"part-{k}.parquet")
        time.sleep(0.05)
    stream = spark.readStream.schema(driver_data.BASE_SCHEMAS["lineitem"]).option("maxFilesPerTrigger", 1).parquet(str(log))
    before = set(Path(session._root(spark)).glob("run-*"))
    target = str(tmp_path / "out")
    start_line_reports(driver_data.param_records(stream), lambda s: d.tables(s, folder), d.ARRIVALS_LINE, target).awaitTermination()
    assert set(Path(session._root(spark)).glob("run-*")) == before

    for batch in (0, 2):
        arrived = spark.read.schema(driver_data.BASE_SCHEMAS["lineitem"]).parquet(*[str(log / f"part-{k}.parquet") for k in range(batch + 1)])
        own = whole.slice(batch * third, third if batch < 2 else None)
        newest = max(own["l_shipdate"].to_pylist()).replace(tzinfo=ZoneInfo("America/Chicago")).astimezone(timezone.utc)
        t = d.tables(spark, folder)
        now = LineTables(jobs=t.jobs, param_records=driver_data.param_records(arrived), alarms=t.alarms, genealogy=t.genealogy,
                         work_element_names=t.work_element_names, child_records=t.child_records)
        wanted = line_report(now, d.ARRIVALS_LINE, newest)
        got = spark.read.parquet(f"{target}/reports/batch={batch}").select(wanted.columns)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, wanted.collect())) and got.count() > 30


def test_sketches_are_near_the_exact_counts(spark, tmp_path):
    """20,000 units of one hot source and a few of another, over windows of one, four and eight hours, batch and stream."""
    from pyspark.sql import functions as F

    from linepareto.operators.windows import SKETCH_ERROR, hourly_sketches, sketched_units, sliding_units
    from linepareto.streaming.counts import stream_sketched_units
    from linepareto.streaming.runs import run_available

    rows = spark.range(60_000).select(
        F.when(F.col("id") % 10 == 0, "B").otherwise("A").alias("source"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, cast(id % 11 as int), 0, cast(id % 3600 as int))").alias("at"),
        F.when(F.col("id") % 10 == 0, F.concat(F.lit("u"), F.col("id") % 50)).otherwise(
            F.concat(F.lit("u"), F.col("id") % 20_000)).alias("unit")).unionByName(
        spark.sql("SELECT 'A' AS source, timestamp_ntz'2024-01-01 02:00:00' AS at, CAST(NULL AS STRING) AS unit"))
    sketches = hourly_sketches(rows, "at", ["source"], "unit")
    for hours in (1, 4, 8):
        exact = {(r.window_start, r.source): r.n for r in sliding_units(rows, "at", ["source"], "unit", hours).collect()}
        about = {(r.window_start, r.source): r.n for r in sketched_units(sketches, ["source"], hours).collect()}
        assert exact.keys() == about.keys() and max(exact.values()) > 4000
        assert all(abs(about[k] - n) <= (SKETCH_ERROR * n if k[1] == "A" else 0) for k, n in exact.items())
    rows.write.parquet(str(tmp_path / "rows"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "rows"))
    got = run_available(stream_sketched_units(stream, "at", ["source"], "unit", 4), str(tmp_path / "out")).collect()
    exact = {(r.window_start, r.source): r.n for r in sliding_units(rows, "at", ["source"], "unit", 4).collect()}
    assert len(got) > 10 and all(abs(r.n - exact[r.window_start, r.source]) <= SKETCH_ERROR * r.n for r in got)


def test_a_day_of_partials_is_one_file(spark, tmp_path):
    """However many tasks reduced the batch."""
    from linepareto.plans import driver_line as d
    from linepareto.streaming.runs import start_line_reports

    log = str(tmp_path / "log")
    spark.range(2000).selectExpr(
        "id AS l_orderkey", "id AS l_partkey", "id % 10 AS l_suppkey", "CAST(id % 7 + 1 AS int) AS l_linenumber", "49D AS l_quantity",
        "90000D AS l_extendedprice", "0.1D AS l_discount", "0.08D AS l_tax", "'R' AS l_returnflag", "'F' AS l_linestatus",
        "timestamp_ntz'1998-06-01 00:30:00' + make_dt_interval(CAST(id % 5 AS int)) AS l_shipdate").write.parquet(log)
    stream = spark.readStream.schema(driver_data.BASE_SCHEMAS["lineitem"]).parquet(log)
    target = tmp_path / "out"
    start_line_reports(driver_data.param_records(stream), lambda s: d.tables(s, FOLDER), d.ARRIVALS_LINE, str(target)).awaitTermination()
    days = list((target / "partials" / "batch=0").glob("day=*"))
    assert len(days) == 5 and all(len(list(day.glob("*.parquet"))) == 1 for day in days)
