from datetime import datetime

import pytest
from pyspark.sql import functions as F

from linepareto.functions.times import after
from linepareto.operators.units import (
    count_units, fails_by_parameter, fails_multi_lookback, nonzero, scope, unique_failed_units)
from linepareto.plans import driver_line

LOOKBACKS = {"short": datetime(2001, 3, 1), "mid": datetime(1999, 9, 1), "long": datetime(1996, 1, 1)}


@pytest.fixture(scope="module")
def rows(spark):
    return driver_line.tables(spark, "/root/testdata/sf0.001").param_records


def test_one_pass_equals_a_query_per_lookback(spark, rows):
    by = ("station_name", "parameter_name")
    one_pass = {(r.lookback, r.station_name, r.parameter_name): r.fail_count
                for r in count_units(rows, "recorded_at", LOOKBACKS, by).collect()}
    separate = {(name, r.station_name, r.parameter_name): r.fail_count
                for name, start in LOOKBACKS.items()
                for r in fails_by_parameter(rows.filter(after(F.col("recorded_at"), start)), by).collect()}
    assert one_pass == separate


def test_one_pass_needs_no_expand(spark, rows, plan):
    assert "Expand" not in plan(fails_multi_lookback(rows, "recorded_at", LOOKBACKS, ["station_name"]))


def test_null_units_do_not_count(spark):
    df = spark.createDataFrame([("a", "x", "2024-01-01"), (None, "x", "2024-01-02"), (None, "y", "2024-01-02")],
                               "product_serial string, station_name string, t string")
    df = df.withColumn("t", F.col("t").cast("timestamp_ntz"))
    got = count_units(df, "t", {"all": datetime(2000, 1, 1)}, ["station_name"]).collect()
    assert [tuple(r) for r in got] == [("x", "all", 1)]


def test_hot_group_is_split_by_unit(spark, rows, plan):
    text = plan(fails_by_parameter(rows))
    assert "hashpartitioning(station_name" in text and "product_serial" in text.split("hashpartitioning(")[1]


def test_scope_and_unique_units(spark):
    df = spark.createDataFrame([("a", "1", "p", "X"), ("a", "1", "q", "X"), ("b", "1", "p", "Y")],
                               "product_serial string, station_name string, parameter_name string, line string")
    assert unique_failed_units(scope(df, line=None)).first().n == 2
    assert unique_failed_units(scope(df, line="X")).first().n == 1
    assert nonzero(fails_by_parameter(df)).count() == 2
