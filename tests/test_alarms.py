import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from linepareto.operators import alarms as al

SCHEMA = """event_id bigint, alarm_source string, activated_at timestamp_ntz, cleared_at timestamp_ntz,
 alarm_priority_desc string, alarm_description string"""
T0 = datetime(2024, 1, 1, 10)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def alarm(number, seconds, clears=None, source="L-050", text="A", priority="high"):
    return (number, source, T0 + timedelta(seconds=seconds),
            None if clears is None else T0 + timedelta(seconds=clears), priority, text)


def counted(spark, rows, text="A"):
    found = al.debounce(frame(spark, rows)).filter(F.col("alarm_description") == text)
    return sorted(r.event_id for r in found.collect())


def test_alarm_after_one_never_cleared_counts(spark):
    assert counted(spark, [alarm(1, 0), alarm(2, 5, 6)]) == [1, 2]


@pytest.mark.parametrize("seconds, ids", [(40, [1]), (40.001, [1, 2])])
def test_gap_is_strict(spark, seconds, ids):
    assert counted(spark, [alarm(1, 0, 10), alarm(2, seconds, 50)]) == ids


def test_alarm_of_another_description_resets_the_gap(spark):
    rows = [alarm(1, 0, 1), alarm(2, 100, 200, text="B"), alarm(3, 210, 211)]
    assert counted(spark, rows) == [1]


def test_ties_are_ordered_by_event(spark):
    assert counted(spark, [alarm(2, 0, 500), alarm(1, 0, 1), alarm(3, 40, 41)]) == [1]


@pytest.fixture(scope="module")
def busy(spark):
    """One source with a third of all alarms, gaps from none to days, slices left empty."""
    rng = random.Random(3)
    rows, seconds = [], 0.0
    for i in range(2500):
        seconds += rng.choice([0, 0.5, 20, 35, 59, 61, 400, 3600, 100000 if i % 50 == 0 else 1])
        source = "S0" if i % 3 == 0 else f"S{rng.randint(1, 6)}"
        clears = None if rng.random() < 0.1 else seconds + rng.choice([0, 1, 30, 90, 5000, 200000])
        rows.append(alarm(i, seconds, clears, source, rng.choice("AB"), rng.choice(["high", "critical", "low"])))
    rng.shuffle(rows)
    return rows


def lagged(rows):
    """Plain per-source order: (event, previous activation, previous clear time)."""
    last, out = {}, {}
    for r in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        out[r[0]] = last.get(r[1], (None, None))
        last[r[1]] = (r[2], r[3])
    return out


@pytest.mark.parametrize("slices", [(), (3600,), (60, 86_400), (10, 3600, 604_800)])
def test_sliced_order_equals_plain_order(spark, busy, slices):
    got = al.with_prev_cleared(frame(spark, busy), slices).collect()
    assert len(got) == len(busy)
    assert {r.event_id: (r.prev_activated_at, r.prev_cleared_at) for r in got} == lagged(busy)


def test_one_pass_over_lookbacks_equals_a_debounce_each(spark, busy):
    df = frame(spark, busy)
    starts = {"a": T0 + timedelta(hours=400), "b": T0 + timedelta(hours=100), "c": T0 - timedelta(hours=1)}
    flags = al.debounced_flags(df.withColumn("prev_activated_at", F.lit(None).cast("timestamp_ntz")), starts, "UTC")
    assert set(flags) == set(starts)
    ordered = al.with_prev_cleared(al.alarm_scope(df, "s", ("high", "critical"), min(starts.values())))
    once = al.count_flags(ordered, al.debounced_flags(ordered, starts, "UTC")).first().asDict()
    each = {name: al.debounce(al.alarm_scope(df, "S", ("high", "critical"), start)).count()
            for name, start in starts.items()}
    assert once == each
    assert len(set(each.values())) == 3


def test_scope_by_source_priority_and_time(spark):
    rows = [alarm(1, 0), alarm(2, 10, priority="low"), alarm(3, 20, source="x-060"), alarm(4, -1)]
    kept = al.alarm_scope(frame(spark, rows), "l-05", ("high", "critical"), T0 - timedelta(seconds=1))
    assert sorted(r.event_id for r in kept.collect()) == [1]


def test_empty_input_zero_row_or_none(spark):
    none = frame(spark, [])
    assert [tuple(r) for r in al.count_alarms(al.debounce(none), "050", "P", keep_empty=True).collect()] == [
        (0, "050", "P")]
    assert al.count_alarms(none, "060", "Weld").collect() == []
    assert al.count_by_key(none, "050").collect() == []


def test_count_by_key(spark):
    rows = [alarm(1, 0, text="Gripper work Key [ G1 ]"), alarm(2, 1, text="Gripper work Key [G1]"),
            alarm(3, 2, text="Gripper work")]
    got = {(r.station_name, r.parameter_name): r.fail_count for r in al.count_by_key(frame(spark, rows), "050").collect()}
    assert got == {("050", "G1"): 2, ("050", ""): 1}


def test_works_without_event_numbers(spark):
    df = frame(spark, [alarm(1, 0, 1), alarm(2, 10, 11), alarm(3, 100, 101)]).drop("event_id")
    assert al.debounce(df).count() == 2


def test_no_task_orders_a_whole_source(spark, busy, plan):
    text = plan(al.with_prev_cleared(frame(spark, busy)))
    windows = [x for x in text.splitlines() if x.startswith("Arguments") and "windowspecdefinition(alarm_source" in x]
    fine = [x for x in windows if "activated_at" in x]
    assert fine and all("_slice2" in x.split("activated_at")[0] + x for x in fine)


def test_alarms_without_source_or_time_have_predecessors(spark):
    from pyspark.sql import Window

    rows = [("S", None), ("S", "2024-01-01 00:00:05"), (None, "2024-01-01 00:00:01"), (None, "2024-01-01 00:01:20"),
            (None, "2024-01-03 00:00:00"), (None, None), ("S", "2024-01-02 00:00:06")]
    for kind in ("timestamp_ntz", "timestamp"):
        df = spark.createDataFrame([(i, s, t) for i, (s, t) in enumerate(rows)], "event_id int, alarm_source string, t string")
        df = df.select("event_id", "alarm_source", F.col("t").cast(kind).alias("activated_at"),
                       (F.col("t").cast(kind) + F.expr("INTERVAL 10 seconds")).alias("cleared_at"),
                       F.lit("d").alias("alarm_description"))
        plain = df.withColumn("p", F.lag("cleared_at").over(Window.partitionBy("alarm_source").orderBy("activated_at", "event_id")))
        expected = {r.event_id: r.p for r in plain.collect()}
        assert {r.event_id: r.prev_cleared_at for r in al.with_prev_cleared(df).collect()} == expected


def test_debounce_scans_the_log_once(spark, plan, tmp_path, monkeypatch):
    from linepareto.operators import alarms as al

    path = str(tmp_path / "alarms")
    spark.range(50).selectExpr("concat('s', id % 3) AS alarm_source", "timestamp_seconds(id * 20) AS activated_at",
                               "timestamp_seconds(id * 20 + 5) AS cleared_at", "'x' AS alarm_description").write.parquet(path)
    scanned, settle = [], al.settle
    monkeypatch.setattr(al, "settle", lambda df, purpose: scanned.append(plan(df)) or settle(df, purpose))
    found = al.debounce(spark.read.parquet(path), "1 minute")
    assert len(scanned) == 1 and path in scanned[0] and path not in plan(found)
    assert found.count() == 3
