from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from linepareto.functions.times import (
    after_local, hour_floor, lookback_start, plant_time, since, since_local)
from linepareto.plans.config import STATOR_LINE

TZ = "America/Chicago"


def instants(spark, first, last, minutes, kind):
    step = F.expr(f"INTERVAL {minutes} MINUTES")
    spans = spark.range(1).select(F.explode(F.sequence(
        F.lit(first).cast("timestamp"), F.lit(last).cast("timestamp"), step)).alias("u"))
    return spans.withColumn("u", F.col("u").cast(kind))


@pytest.mark.parametrize("day", ["2025-11-02", "2025-03-09", "2025-07-01"])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("clock", ["00:00", "00:30", "01:00", "01:30", "01:45", "02:00", "02:30", "03:00"])
def test_threshold_on_bare_column_equals_converted_column(spark, day, kind, clock):
    rows = instants(spark, f"{day} 00:00:00", f"{day} 20:00:00", 5, kind)
    start = datetime.fromisoformat(f"{day} {clock}")
    kept = rows.filter(after_local(F.col("u"), start, TZ, kind == "timestamp_ntz"))
    wanted = rows.filter(plant_time(rows, "u", TZ) > F.lit(str(start)).cast("timestamp_ntz"))
    assert sorted(kept.collect()) == sorted(wanted.collect())
    assert kept.count() > 0


def test_fold_both_instants_share_one_clock_time(spark):
    rows = spark.createDataFrame([("2025-11-02 06:30:00",), ("2025-11-02 07:30:00",)], ["u"])
    rows = rows.select(F.col("u").cast("timestamp").alias("u"))
    local = [str(r[0]) for r in rows.select(plant_time(rows, "u", TZ).cast("string")).collect()]
    assert local == ["2025-11-02 01:30:00"] * 2


def test_since_is_strict_and_open_ended(spark):
    rows = spark.createDataFrame(
        [("2024-01-01 10:00:00",), ("2024-01-01 10:00:01",), ("2030-01-01 00:00:00",)], ["t"]
    ).select(F.col("t").cast("timestamp_ntz").alias("t"))
    as_of = datetime(2024, 1, 1, 11, 40)
    assert since(rows, "t", as_of, 1).count() == 2
    assert since(rows, "t", as_of, 1, upper=datetime(2024, 1, 1, 12)).count() == 1


def test_lookback_start_is_top_of_hour():
    assert lookback_start(datetime(2024, 1, 1, 0, 59, 59), 4) == datetime(2023, 12, 31, 20)


def test_hour_floor_has_no_zone(spark):
    rows = spark.range(1).select(hour_floor(F.lit("2024-01-01 10:59:00").cast("timestamp_ntz")).alias("h"))
    assert dict(rows.dtypes) == {"h": "timestamp_ntz"}
    assert rows.first().h == datetime(2024, 1, 1, 10)


@pytest.mark.parametrize("local_hour, names", [
    (0, ["hourly"]), (1, ["hourly", "mid_shift"]), (5, ["hourly", "shift_end"]),
    (11, ["hourly", "mid_shift"]), (15, ["hourly", "shift_end"]), (23, ["hourly"])])
def test_gate_follows_plant_hour(local_hour, names):
    as_of = datetime(2024, 1, 10, tzinfo=timezone.utc) + timedelta(hours=6 + local_hour, minutes=30)
    assert [r.name for r in STATOR_LINE.due(as_of)] == names


def test_one_clock_for_gate_and_thresholds():
    starts = STATOR_LINE.starts(datetime(2024, 1, 10, 11, 20, tzinfo=timezone.utc))
    assert starts == {"hourly": datetime(2024, 1, 10, 4), "shift_end": datetime(2024, 1, 9, 21)}


def test_local_threshold_is_pushed_to_the_scan(spark, plan, tmp_path):
    path = str(tmp_path / "alarms")
    instants(spark, "2025-07-01 00:00:00", "2025-07-01 05:00:00", 30, "timestamp").write.parquet(path)
    kept = since_local(spark.read.parquet(path), "u", TZ, datetime(2025, 6, 30, 23, 10), 1)
    pushed = [x for x in plan(kept).splitlines() if "PushedFilters" in x][0]
    assert "GreaterThan(u,2025-07-01" in pushed
