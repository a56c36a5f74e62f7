"""Every registered query against its SQL counterpart on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
import oracle_texts
from linepareto.plans import driver_line

FOLDER = os.environ.get("PARITY_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def assert_same(spark, duck, name):
    got = entry.queries()[name](spark, FOLDER)
    expected = duck.sql(entry.oracle_sql()[name])
    columns = sorted(got.columns)
    assert columns == sorted(expected.columns)
    rows = [tuple(r) for r in got.select(*columns).collect()]
    wanted = duck.sql(f"SELECT {', '.join(columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
    assert sorted(map(repr, rows)) == sorted(map(repr, wanted))


def test_every_query_has_an_oracle():
    assert set(driver_line.queries()) == set(oracle_texts.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(driver_line.queries()))
def test_parity(spark, duck, name):
    assert_same(spark, duck, name)


@pytest.mark.parametrize("name", ["alarm_local_time", "alarm_debounced", "lookback_by_parameter",
                                  "sliding_units", "windowed_units", "stream_units", "due_reports",
                                  "lookback_origin"])
def test_parity_in_another_session_zone(spark, duck, name):
    spark.conf.set("spark.sql.session.timeZone", "America/Chicago")
    try:
        assert_same(spark, duck, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_entry(spark):
    assert entry.entry(spark).count() > 0
