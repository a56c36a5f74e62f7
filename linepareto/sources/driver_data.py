"""The five source relations derived from the order/event tables in a Parquet folder.

An order is a unit, a line item is a station visit with four measured parameters and a child
part built in, an event is an alarm, a part is a child part and a supplier a work element.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from linepareto.sources.tables import LineTables

Reader = Callable[[str], DataFrame]

# Columns of the base tables; declared, so that no job has to read footers first.
BASE_SCHEMAS = {
    "lineitem": """l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,
        l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE,
        l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ""",
    "orders": """o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,
        o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING""",
    "part": """p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT,
        p_retailprice DOUBLE""",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "events": """event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING,
        value DOUBLE, props STRING""",
}


def folder_reader(spark: SparkSession, folder: str) -> Reader:
    return lambda name: spark.read.schema(BASE_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def stream_reader(spark: SparkSession, folder: str, max_files: int | None = None) -> Reader:
    """The same tables as file streams."""
    def read(name: str) -> DataFrame:
        stream = spark.readStream.schema(BASE_SCHEMAS[name])
        if max_files:
            stream = stream.option("maxFilesPerTrigger", max_files)
        # a glob, so that the table may be one file as well as a folder of files
        return stream.parquet(f"{folder}/{name[:-1]}[{name[-1]}].parquet")

    return read


def param_records(lineitem: DataFrame) -> DataFrame:
    measured = ((1, "Quantity Value", "l_quantity"), (2, "Discount Value", "l_discount"),
                (3, "Tax Value", "l_tax"), (4, "Price defect Value", "l_extendedprice"))
    parameters = F.inline(F.array(*[
        F.struct(F.lit(number).alias("parameter_id"), F.lit(name).alias("parameter_name"),
                 F.col(column).alias("parameter_value_num")) for number, name, column in measured]))
    location = F.col("l_linenumber") % 2 + 1
    tall = lineitem.select(
        F.col("l_orderkey").alias("product_serial"),
        F.lit("SHOP1").alias("shop_name"), F.lit("LINE1").alias("line_name"),
        F.lpad((F.col("l_linenumber") * 10).cast("string"), 3, "0").alias("station_name"),
        location.alias("work_location_id"),
        F.lpad(location.cast("string"), 2, "0").alias("work_location_name"),
        F.when(F.col("l_returnflag") == "R", "NOK").otherwise("OK").alias("overall_process_status"),
        F.when(F.col("l_linestatus") == "F", "FAIL").otherwise("PASS").alias("result_status"),
        F.col("l_shipdate").alias("recorded_at"),
        F.col("l_suppkey").alias("work_element"),
        parameters)
    return tall.withColumn("parameter_value_raw", F.col("parameter_value_num").cast("string"))


def jobs(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_custkey").alias("product_serial"),
        F.lit("SHOP1").alias("shop_name"), F.lit("LINE1").alias("line_name"),
        F.lit("020").alias("station_name"), F.col("o_orderpriority").alias("work_location_desc"),
        F.when(F.col("o_orderkey") % 2 == 0, "02").otherwise("01").alias("work_location_name"),
        F.when(F.col("o_orderstatus") == "F", "NOK").otherwise("OK").alias("job_status"),
        F.col("o_orderdate").alias("started_at"))


def alarms(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    source = F.concat(F.lit("LINE1-0"), (50 + 10 * (F.col("user_id") % 4)).cast("string"),
                      F.lit("-U"), (F.col("user_id") % 8).cast("string"))
    open_for = F.expr("cast(floor(value * 60) AS int) * INTERVAL '1' SECOND")
    gripper = F.concat(F.lit("Gripper not in work pos Key [ G"),
                       (F.col("event_id") % 7).cast("string"), F.lit(" ]"))
    return events.select(
        "event_id", source.alias("alarm_source"), F.col("ts").alias("activated_at"),
        F.when(F.col("event_id") % 17 != 0, F.col("ts") + open_for).alias("cleared_at"),
        F.when(kind == "error", "critical").when(kind == "view", "low").otherwise("high")
        .alias("alarm_priority_desc"),
        F.when(kind == "error", "Assembly error : plate Task[301]").when(kind == "purchase", gripper)
        .when(kind == "signup", "Laser: General error").otherwise("Other").alias("alarm_description"))


def genealogy(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.col("l_orderkey").alias("product_serial"), F.col("l_partkey").alias("scanned_child_serial"),
        F.lit("SHOP1").alias("shop_name"), F.lit("LINE1").alias("line_name"),
        F.when(F.col("l_linenumber") == 1, "STACK").otherwise("PIN").alias("scanned_child_part"),
        F.col("l_shipdate").alias("consumed_at"))


def child_records(part: DataFrame) -> DataFrame:
    station = F.concat(F.lit("030-"), (F.col("p_size") % 4 + 1).cast("string"))
    spool = F.concat(F.lit("SPOOL-A "), F.col("p_brand"))

    def record(name, value):
        return F.struct(F.lit(name).alias("parameter_name"), value.alias("parameter_value_raw"))

    nest = record("Nest", F.col("p_size").cast("string"))
    batches = [record("Wire Batch 1", spool), record("Wire BATCH 2", spool)]
    records = F.when(F.col("p_type").isin("SMALL", "MEDIUM"), F.array(nest, *batches)).otherwise(F.array(nest))
    return part.select(
        F.col("p_partkey").alias("product_serial"), F.lit("SHOP1").alias("shop_name"),
        F.lit("LINE1").alias("line_name"), station.alias("station_name"), F.inline(records))


def work_element_names(supplier: DataFrame) -> DataFrame:
    nation = F.col("s_nationkey").cast("string")
    pair = F.concat(F.lit("P"), F.lpad(nation, 4, "0"), F.lit(" in & Q"),
                    F.lpad((F.col("s_suppkey") % 5).cast("string"), 4, "0"), F.lit(" out"))
    return supplier.filter(F.col("s_acctbal") > 0).select(
        F.col("s_suppkey").alias("work_element"),
        F.when(F.col("s_suppkey") % 10 == 0, F.concat(F.lit("SOLO"), nation)).otherwise(pair).alias("pin_pair"))


def line_tables(read: Reader) -> LineTables:
    """All source relations; `read` yields a base table by name."""
    return LineTables(
        jobs=lambda: jobs(read("orders")),
        param_records=lambda: param_records(read("lineitem")),
        alarms=lambda: alarms(read("events")),
        genealogy=lambda: genealogy(read("lineitem")),
        work_element_names=lambda: work_element_names(read("supplier")),
        child_records=lambda: child_records(read("part")))
