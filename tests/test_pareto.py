from linepareto.operators import pareto


def counts(spark, rows):
    return spark.createDataFrame(rows, "fail_count bigint, station_name string, parameter_name string")


def test_combined_unites_by_name_and_drops_zero(spark):
    alarms = spark.createDataFrame([(3, "060", "Weld"), (0, "080", "Laser")],
                                   "fail_count bigint, station_name string, alarm_description string")
    got = pareto.combined([counts(spark, [(2, "040", "Force"), (0, "050", "Plate")]), alarms])
    assert got.columns == ["fail_count", "station_name", "parameter_name"]
    assert sorted(map(tuple, got.collect())) == [(2, "040", "Force"), (3, "060", "Weld")]


def test_order_by_count_then_ties(spark):
    rows = counts(spark, [(1, "b", "x"), (5, "a", "y"), (1, "a", "z"), (1, "a", "b")])
    got = [tuple(r) for r in pareto.by_count(rows, "station_name", "parameter_name").collect()]
    assert got == [(5, "a", "y"), (1, "a", "b"), (1, "a", "z"), (1, "b", "x")]


def test_order_by_numeric_station_text_last(spark):
    rows = counts(spark, [(1, "100", ""), (1, "040", ""), (1, "text", ""), (1, "065", ""), (9, "210", "")])
    got = [r.station_name for r in pareto.by_count_and_station(rows, "parameter_name").collect()]
    assert got == ["210", "040", "065", "100", "text"]


def test_override_replaces_only_named_stations(spark):
    rows = counts(spark, [(4, "210", "a"), (5, "210", "b"), (3, "060", "a")])
    unique = spark.createDataFrame([(4, "210"), (7, "999")], "n bigint, station_name string")
    got = {r.station_name: r.fail_count for r in pareto.station_pareto(rows, unique).collect()}
    assert got == {"210": 4, "060": 3}
    got = {r.station_name: r.fail_count for r in pareto.station_pareto(rows).collect()}
    assert got == {"210": 9, "060": 3}


def test_row_without_station_is_left_out(spark):
    rows = counts(spark, [(4, None, "a"), (5, "210", "b")])
    assert [tuple(r) for r in pareto.station_pareto(rows).collect()] == [("210", 5)]
