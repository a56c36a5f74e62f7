import pytest
from pyspark.sql import functions as F, types as T

from linepareto import schemas
from linepareto.sources import tables


def empty(spark, schema):
    return spark.createDataFrame([], schema)


def test_path_is_read_in_declared_order(spark, tmp_path):
    path = str(tmp_path / "jobs")
    columns = list(reversed(schemas.JOBS.names))
    empty(spark, schemas.JOBS).select(*columns).withColumn("more", F.lit(1)).write.parquet(path)
    got = tables.jobs(spark, path)
    assert got.schema.names == schemas.JOBS.names


def test_missing_column_and_wrong_type_are_reported(spark, tmp_path):
    path = str(tmp_path / "genealogy")
    bad = empty(spark, schemas.GENEALOGY).drop("consumed_at").withColumn("line_name", F.lit(1))
    bad.write.parquet(path)
    with pytest.raises(tables.SchemaMismatch, match="line_name: int, not string; consumed_at: missing"):
        tables.genealogy(spark, path)


def test_plant_column_names_are_renamed(spark, tmp_path):
    path = str(tmp_path / "names")
    empty(spark, T.StructType([T.StructField("DELMIA_WE_Name", T.StringType()),
                               T.StructField("Hairpins_In_Welded_Pin_Pair", T.StringType())])).write.parquet(path)
    assert tables.work_element_names(spark, path).columns == ["work_element", "pin_pair"]
    path = str(tmp_path / "alarms")
    empty(spark, schemas.ALARMS).withColumnRenamed("alarm_source", "alarm_source_scada_short_name").write.parquet(path)
    assert tables.alarms(spark, path).columns == schemas.ALARMS.names


def test_relations_are_read_when_used(spark):
    read = []

    def load():
        read.append(1)
        return empty(spark, schemas.PARAM_RECORDS)

    relations = tables.LineTables(param_records=load)
    assert not read
    assert relations.child_records is relations.param_records
    assert read == [1]
    with pytest.raises(TypeError):
        tables.LineTables(other=load)


def test_all_five_from_catalog_views(spark):
    names = {"jobs": schemas.JOBS, "param_records": schemas.PARAM_RECORDS, "alarms": schemas.ALARMS,
             "genealogy": schemas.GENEALOGY, "work_element_names": schemas.WORK_ELEMENT_NAMES}
    for name, schema in names.items():
        empty(spark, schema).createOrReplaceTempView(f"v_{name}")
    relations = tables.line_tables(spark, {name: f"v_{name}" for name in names}, "table")
    assert {name: getattr(relations, name).schema.names for name in names} == {
        name: schema.names for name, schema in names.items()}


def test_lookback_opens_only_the_days_it_reaches(spark, tmp_path, plan):
    from datetime import datetime

    from linepareto.operators.alarms import alarm_scope
    from linepareto.plans import families
    from linepareto.plans.config import STATOR_LINE
    from linepareto.sources.layout import write_by_day

    days = spark.range(48).selectExpr("timestamp'2024-01-01 00:30:00Z' + make_dt_interval(0, cast(id as int)) AS at")

    def logged(schema, ts, **values):
        kind = schema[ts].dataType
        columns = [F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) if f.name != ts
                   else F.col("at").cast(kind).alias(ts) for f in schema.fields]
        return days.select(*columns)

    records, alarms = str(tmp_path / "records"), str(tmp_path / "alarms")
    write_by_day(logged(schemas.PARAM_RECORDS, "recorded_at", line_name="STTR01", station_name="040",
                        parameter_name="Force process value", parameter_id=2, product_serial="P",
                        overall_process_status="NOK"), "recorded_at", records)
    write_by_day(logged(schemas.ALARMS, "activated_at", alarm_source="STTR01-060", alarm_priority_desc="high"),
                 "activated_at", alarms)
    source = tables.LineTables(param_records=tables.param_records(spark, records),
                               alarms=tables.alarms(spark, alarms))
    start = {"all": datetime(2024, 1, 2, 12)}
    found = families.force_fails(source, STATOR_LINE, start)
    assert [r.fail_count for r in found.collect()] == [1]
    pruned = [x for x in plan(found).splitlines() if "PartitionFilters" in x][0]
    assert "log_day" in pruned and "2024-01-02" in pruned
    kept = alarm_scope(source.alarms, "060", ("high",), start["all"], "America/Chicago")
    assert kept.count() == 6  # 18:30 to 23:30 UTC is 12:30 to 17:30 at the plant
    assert "2024-01-01" in [x for x in plan(kept).splitlines() if "PartitionFilters" in x][0]


def test_clustered_log_skips_row_groups(spark, plan, tmp_path):
    """Limits on raw values reach the scan as comparisons, and few row groups hold what they ask for."""
    from pathlib import Path

    import pyarrow.parquet as pq
    from pyspark.sql import functions as F

    from linepareto import schemas
    from linepareto.operators.limits import Limit, limit_violations
    from linepareto.sources import tables
    from linepareto.sources.layout import NUMBER, write_by_day, write_clustered

    raw = F.when(F.col("id") % 97 == 0, "n/a").otherwise((F.col("id") % 500 / 10).cast("string"))
    made = {"product_serial": F.col("id").cast("string"), "line_name": F.lit("L"),
            "station_name": F.when(F.col("id") % 3 == 0, "010").otherwise(F.concat(F.lit("0"), (F.col("id") % 7 + 2) * 10)),
            "parameter_name": F.concat(F.lit("P"), F.col("id") % 5), "parameter_value_raw": raw,
            "recorded_at": F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id % 3 as int), 0, 0, cast(id as int))")}
    log = spark.range(30_000).select(*[made.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.PARAM_RECORDS])
    write_by_day(log, "recorded_at", str(tmp_path / "plain"))
    write_clustered(log, "recorded_at", str(tmp_path / "sorted"), **{"parquet.block.size": "16384", "parquet.page.size": "2048",
                                                                    "parquet.page.size.row.check.min": "10"})
    limits = (Limit("030", "eq", "P1", None, 1, 49), Limit("030", "eq", "P2", None, None, 45))
    found = {}
    for name in ("plain", "sorted"):
        read = tables.param_records(spark, str(tmp_path / name))
        found[name] = limit_violations(read, limits)
        assert (NUMBER in read.columns) == (name == "sorted")
    key = ["product_serial", "parameter_name", "parameter_value_raw"]
    assert sorted(found["sorted"].select(key).collect()) == sorted(found["plain"].select(key).collect()) != []
    pushed = [line for line in plan(found["sorted"]).split("\n") if "PushedFilters" in line][0]
    assert f"GreaterThan({NUMBER},45.0)" in pushed and "EqualTo(station_name,030)" in pushed
    groups = [pq.ParquetFile(f).metadata.row_group(g) for f in Path(tmp_path / "sorted").rglob("*.parquet")
              for g in range(pq.ParquetFile(f).metadata.num_row_groups)]
    at = schemas.PARAM_RECORDS.fieldNames().index("station_name")
    asked = [g for g in groups if g.column(at).statistics.min <= "030" <= g.column(at).statistics.max]
    assert len(asked) <= 0.4 * len(groups)
