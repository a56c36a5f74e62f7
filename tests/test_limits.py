import random

import pytest
from pyspark.sql import functions as F

from linepareto.operators import limits as lim
from linepareto.operators.limits import Limit, LimitCheck, check_violations, for_variant, limit_violations
from linepareto.plans import limit_values as values

SCHEMA = """product_serial string, station_name string, parameter_name string, work_location_id int,
 work_location_name string, parameter_value_raw string, parameter_value_num double,
 overall_process_status string, recorded_at timestamp_ntz"""

ALL = values.VISION_065 + values.VISION_100 + values.ELECTRICAL_110 + values.ELECTRICAL_210


def records(spark, rows):
    return (spark.createDataFrame(rows, SCHEMA.replace("timestamp_ntz", "string"))
            .withColumn("recorded_at", F.col("recorded_at").cast("timestamp_ntz")))


def row(serial, station, name, raw, location=1, status="NOK"):
    try:
        number = None if raw is None else float(raw)
    except ValueError:
        number = None
    return (serial, station, name, location, f"{location:02d}", raw, number, status, "2024-01-01 00:00:00")


def serials(df):
    return sorted(r.product_serial for r in df.select("product_serial").collect())


def test_pass_band_is_inclusive_and_text_that_is_no_number_passes(spark):
    name = "Value Height Pin X"
    rows = [row("low", "065", name, "38.5"), row("at_lo", "065", name, "39"), row("at_hi", "065", name, "47"),
            row("high", "065", name, "47.5"), row("text", "065", name, "PT0"), row("null", "065", name, None),
            row("other", "066", name, "1")]
    assert serials(limit_violations(records(spark, rows), values.VISION_065)) == ["high", "low"]


def test_record_two_limits_apply_to_is_kept_once(spark):
    limits = (Limit("1", "eq", "Some defect", None, 0, 1), Limit("1", "ilike", "%DEFECT%", None, 0, 2))
    rows = [row("a", "1", "Some defect", "3"), row("b", "1", "other Defect", "1.5"), row("c", "1", "Some defect", "1.5")]
    assert serials(limit_violations(records(spark, rows), limits)) == ["a", "c"]


def test_nonzero_limit_and_case_insensitive_name(spark):
    rows = [row("a", "100", "value label id", "1"), row("b", "100", "Value Label ID", "0"),
            row("c", "100", "Value Label ID", "-1"), row("d", "100", "Value Label ID x", "1")]
    assert serials(limit_violations(records(spark, rows), values.VISION_100)) == ["a", "c"]


def test_location_scope_by_id_and_by_name(spark):
    name = "Humidity Value"
    rows = [row("in", "210", name, "101", 2), row("out", "210", name, "101", 1),
            row("both", "210", "AmbientTemperature Value", "51", 1)]
    for location in ("id", "name"):
        found = limit_violations(records(spark, rows), values.ELECTRICAL_210, "num", "NOK", location)
        assert serials(found) == ["both", "in"]


def test_status_is_required_where_the_check_says_so(spark):
    rows = [row("ok", "110", "Humidity Value", "101", status="OK"), row("nok", "110", "Humidity Value", "101")]
    assert serials(limit_violations(records(spark, rows), values.ELECTRICAL_110, "num", "NOK")) == ["nok"]
    assert serials(limit_violations(records(spark, rows), values.ELECTRICAL_110, "num")) == ["nok", "ok"]


def test_variant_replaces_its_base_limit(spark):
    limits = values.VISION_065 + values.VISION_065_SUMMARY
    rows = [row("mid", "065", "Value Angle 2 Pin X", "0"), row("at", "065", "Value Angle 2 Pin X", "-45"),
            row("other", "065", "Value Height Pin X", "1")]
    df = records(spark, rows)
    assert serials(limit_violations(df, for_variant(limits))) == ["other"]
    assert serials(limit_violations(df, for_variant(limits, values.SUMMARY_VARIANT))) == ["mid", "other"]
    assert len(for_variant(limits, values.SUMMARY_VARIANT)) == len(values.VISION_065)


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(7)
    names = sorted({x.pattern.strip("%") for x in ALL}) + ["a Defect here", "value label od pins grayscale"]
    rows = []
    for i in range(5000):
        limit = rng.choice(ALL)
        name = limit.pattern.strip("%") if rng.random() < 0.7 else rng.choice(names)
        near = rng.choice([limit.lo, limit.hi, limit.lo - 1, limit.hi + 1, (limit.lo + limit.hi) / 2])
        raw = rng.choice([repr(float(near)), repr(float(near)), "n/a", None])
        # a third of all rows at one station
        station = "065" if i % 3 == 0 else limit.station_name
        rows.append(row(f"s{i}", station, name, raw, rng.choice([1, 2, 3]), rng.choice(["OK", "NOK"])))
    return records(spark, rows).cache()


def brute_force(df, checks):
    found = []
    for r in df.collect():
        hit = False
        for check in checks:
            if check.status and r.overall_process_status != check.status:
                continue
            value = r.parameter_value_num
            for x in check.limits:
                pattern = x.pattern.lower()
                named = (r.parameter_name == x.pattern if x.match_mode == "eq" else
                         pattern.strip("%") in r.parameter_name.lower() if "%" in pattern else
                         pattern == r.parameter_name.lower())
                at = x.work_location_id is None or x.work_location_id == r.work_location_id
                hit |= (x.station_name == r.station_name and named and at and value is not None
                        and (value < x.lo or value > x.hi))
        if hit:
            found.append(r.product_serial)
    return sorted(found)


CHECKS = [LimitCheck(values.VISION_065), LimitCheck(values.VISION_100),
          LimitCheck(values.ELECTRICAL_110, "num", "NOK"), LimitCheck(values.ELECTRICAL_210, "num", "NOK", "name")]


def test_several_checks_in_one_scan_equal_brute_force(spark, mixed):
    expected = brute_force(mixed, CHECKS)
    assert len(expected) > 300
    assert serials(check_violations(mixed, CHECKS)) == expected


@pytest.mark.parametrize("local, patterns", [(0, 200), (10_000, 0)])
def test_large_sets_take_other_ways_to_the_same_rows(spark, mixed, monkeypatch, local, patterns):
    monkeypatch.setattr(lim, "MAX_LOCAL_LIMITS", local)
    monkeypatch.setattr(lim, "MAX_PATTERNS", patterns)
    assert serials(check_violations(mixed, CHECKS)) == brute_force(mixed, CHECKS)


def limit_table(spark, limits):
    from linepareto import schemas
    rows = [tuple(x._replace(lo=lim._float(x.lo), hi=lim._float(x.hi))) for x in limits]
    return spark.createDataFrame(rows, schemas.LIMITS)


def test_limits_table_joins_by_shuffle_without_broadcast(spark, mixed, plan):
    checks = [LimitCheck(ALL, "raw")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        found = limit_violations(mixed, limit_table(spark, ALL))
        assert serials(found) == brute_force(mixed, checks)
        assert "Broadcast" not in plan(found)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_one_sided_limits_variants_and_location_zero_alike_for_tuples_and_tables(spark):
    limits = (Limit("1", "eq", "A", None, None, 5.0), Limit("1", "eq", "B", 0, 1.0, None), Limit("1", "ilike", "%c%", 2, 0.0, 9.0),
              Limit("1", "eq", "D", None, -10.0, 100.0), Limit("1", "eq", "D", 0, -10.0, 10.0, "summary"))
    rows = [row("a", "1", "A", "6"), row("a0", "1", "A", "-99"), row("b", "1", "B", "0"), row("b0", "1", "B", "99"),
            row("c", "1", "xCx", "10", 2), row("c0", "1", "xCx", "10", 1), row("d", "1", "D", "50"), row("d0", "1", "D", "5"),
            row("loose", "X1", "A", "6")]
    df, table = records(spark, rows), limit_table(spark, limits)
    for value in ("raw", "num"):
        for kind in (limits, table):
            assert serials(limit_violations(df, kind, value)) == ["a", "b", "c"]
            assert serials(limit_violations(df, kind, value, variant="summary")) == ["a", "b", "c", "d"]
            assert serials(limit_violations(df, kind, value, status="OK")) == []
            assert serials(limit_violations(df, kind, value, loose_stations=True)) == ["a", "b", "c", "loose"]


def test_no_limits_find_nothing(spark):
    df = records(spark, [row("a", "1", "A", "6")])
    assert serials(limit_violations(df, ())) == [] and serials(limit_violations(df, limit_table(spark, ()))) == []


def test_exact_limits_are_a_hash_join_on_station_and_parameter(spark, plan, tmp_path):
    path = str(tmp_path / "records")
    records(spark, [row("a", "110", "Humidity Value", "101")]).write.parquet(path)
    text = plan(limit_violations(spark.read.parquet(path), values.ELECTRICAL_110, "num", "NOK"))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert "Left keys [2]: [station_name" in text
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(limit_violations(spark.read.parquet(path), ALL, "num"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    pushed = [x for x in text.splitlines() if "PushedFilters" in x][0]
    assert all(part in pushed for part in (
        "EqualTo(station_name,110)", "In(parameter_name", "EqualTo(overall_process_status,NOK)",
        "GreaterThan(parameter_value_num"))


def test_mixed_limits_never_nest_loops(spark, mixed, plan):
    text = plan(check_violations(mixed, CHECKS))
    assert "BroadcastHashJoin" in text and "NestedLoop" not in text and "Cartesian" not in text


def test_stations_with_a_limited_one_in_their_name(spark):
    name = "Value Height Pin X"
    rows = [row("a", "065", name, "1"), row("b", "X065-2", name, "1"), row("c", "650", name, "1"),
            row("d", "110-065", name, "1"), row("e", "110-065", "Humidity Value", "101")]
    for limits, found in ((values.VISION_065, ["a", "b", "d"]),
                          (values.VISION_065 + values.ELECTRICAL_110, ["a", "b", "d", "e"])):
        assert serials(check_violations(records(spark, rows), [LimitCheck(limits)], True)) == found
    pattern = (Limit("065", "ilike", "%height%", None, 39, 47),)
    assert serials(check_violations(records(spark, rows), [LimitCheck(pattern)], True)) == ["a", "b", "d"]


def test_loose_stations_join_on_names_at_any_size(spark, mixed, monkeypatch):
    local = serials(check_violations(mixed, CHECKS, True))
    monkeypatch.setattr(lim, "MAX_LOCAL_LIMITS", 3)
    assert serials(check_violations(mixed, CHECKS, True)) == local


def test_limits_of_one_scope_are_one_band():
    limits = (Limit("1", "eq", "A", None, 0, 10), Limit("1", "eq", "A", 0, None, 5), Limit("1", "eq", "A", 2, 1, None),
              Limit("1", "eq", "A", None, -3, None))
    bands = lim.collapsed([LimitCheck(limits, "num")])
    assert [(x.work_location_id, x.lo, x.hi) for x in bands] == [(None, 0.0, 5.0), (2, 1.0, None)]


@pytest.mark.parametrize("loose", [False, True])
def test_small_limits_table_leaves_the_log_where_it_is(spark, mixed, plan, tmp_path, loose):
    mixed.write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    found = limit_violations(log, limit_table(spark, ALL), loose_stations=loose)
    text = plan(found)
    assert "hashpartitioning" not in text and text.count("Scan parquet") == 2 * 1  # the node and its details
    assert serials(found) == serials(limit_violations(mixed, ALL, loose_stations=loose))


def test_hot_pair_of_a_large_table_is_spread(spark, mixed, monkeypatch, plan):
    """A third of all rows are of one station; above the bound every pair of 100 rows is hot."""
    monkeypatch.setattr(lim, "MAX_LOCAL_LIMITS", 5)
    monkeypatch.setattr(lim, "HOT_ROWS", 100)
    found = limit_violations(mixed, limit_table(spark, ALL))
    assert "_salt" in plan(found)
    assert serials(found) == brute_force(mixed, [LimitCheck(ALL)])
    assert serials(check_violations(mixed, CHECKS)) == brute_force(mixed, CHECKS)
    assert serials(check_violations(mixed, CHECKS, True)) == serials(check_violations(mixed, CHECKS, True))


def test_many_limits_on_a_stream(spark, mixed, tmp_path):
    """Exact bands and patterns against the batch result."""
    from linepareto.streaming.runs import run_available
    mixed.write.parquet(str(tmp_path / "log"))
    stream = spark.readStream.schema(mixed.schema).parquet(str(tmp_path / "log"))
    found = run_available(check_violations(stream, CHECKS), str(tmp_path / "out"))
    assert serials(found) == brute_force(mixed, CHECKS)


@pytest.mark.parametrize("loose", [False, True])
def test_every_size_gives_the_same_loose_and_exact_rows(spark, mixed, monkeypatch, loose):
    expected = serials(check_violations(mixed, CHECKS, loose))
    for name, number in (("MAX_PATTERNS", 0), ("MAX_LOCAL_LIMITS", 3)):
        with monkeypatch.context() as patch:
            patch.setattr(lim, name, number)
            assert serials(check_violations(mixed, CHECKS, loose)) == expected
