"""The stator line's report on hand-made rows."""

import json
from datetime import datetime, timedelta, timezone

import pytest

from linepareto import schemas
from linepareto.plans import families, report
from linepareto.plans.config import STATOR_LINE
from linepareto.sources.tables import LineTables

AS_OF = datetime(2024, 1, 10, 11, 20, tzinfo=timezone.utc)  # 05:20 at the plant: hourly and shift end
HOUR, SHIFT = datetime(2024, 1, 10, 4, 30), datetime(2024, 1, 9, 23, 0)  # inside both / shift only
OLD = datetime(2024, 1, 9, 21, 0)  # exactly at the shift's threshold: outside


def frame(spark, schema, rows, **common):
    full = [{**dict.fromkeys(schema.names), **common, **r} for r in rows]
    return spark.createDataFrame([tuple(r[c] for c in schema.names) for r in full], schema)


def record(serial, station, name, value, at=HOUR, **more):
    number = None
    try:
        number = float(value)
    except ValueError:
        pass
    return {"product_serial": serial, "station_name": station, "parameter_name": name, "recorded_at": at,
            "parameter_value_raw": value, "parameter_value_num": number, "overall_process_status": "NOK",
            "work_location_id": 1, "work_location_name": "01"} | more


def utc(local):
    return local + timedelta(hours=6)


def alarm(station, at, text, clears=10, unit="U1", priority="high"):
    activated = utc(at).replace(tzinfo=timezone.utc)
    return {"alarm_source": f"DU02-STTR01-{station}-{unit}", "activated_at": activated,
            "cleared_at": None if clears is None else activated + timedelta(seconds=clears),
            "alarm_priority_desc": priority, "alarm_description": text}


@pytest.fixture(scope="module")
def tables(spark):
    line = {"shop_name": "DU02", "line_name": "STTR01"}
    job = {"station_name": "020", "work_location_name": "02", "job_status": "NOK", "work_location_desc": "Insertion"}
    jobs = frame(spark, schemas.JOBS, [
        {"product_serial": "A", "started_at": HOUR}, {"product_serial": "A", "started_at": SHIFT},
        {"product_serial": "B", "started_at": SHIFT}, {"product_serial": "C", "started_at": OLD},
        {"product_serial": "D", "started_at": HOUR, "job_status": "OK"},
        {"product_serial": "E", "started_at": HOUR, "shop_name": "XX"}], **(line | job))
    force = {"parameter_id": 2}
    records = frame(spark, schemas.PARAM_RECORDS, [
        record("A", "040", "Force process value", "1", **force),
        record("A", "040", "Force process value", "1", SHIFT, **force),
        record("B", "040", "Force process value", "1", SHIFT, **force),
        record("C", "040", "Force process value", "1", parameter_id=1),
        record("A", "050", "Twist", "1", result_status="FAIL"),
        record("A", "065", "Value Height Pin X", "38", overall_process_status="OK", work_element="W1"),
        record("A", "065", "Value Height Pin X", "no reading"),
        record("A", "065-R", "Value Height Pin X", "1", work_element="W1"),  # by pin type only
        record("B", "065", "Value Angle 2 Pin X", "10", SHIFT, work_element="W1"),
        record("B", "065", "Value Level Difference", "0.7", SHIFT, work_element="W2"),
        record("A", "100", "Edge DEFECT size", "0.5"),
        record("A", "110", "Humidity Value", "101"),
        record("B", "110", "Humidity Value", "101", overall_process_status="OK"),
        record("A", "210", "PartTemperature Value", "101"), record("A", "210", "Pdiv HvAc Value", "1"),
        record("B", "210", "PartTemperature Value", "-1"),
        record("B", "210", "Pdiv UV Value", "1"),  # limited at the other location only
        record("H1", "030-1", "Nest", "7", OLD), record("H2", "030-2", "Nest", "8", OLD),
        record("H1", "030-1", "Wire Batch 1", "x pt00237846-c y", OLD),
        record("H1", "030-1", "Wire batch 2", "PT00237846-C", OLD),
    ], **line)
    alarms = frame(spark, schemas.ALARMS, [
        alarm("050", HOUR, "Assembly error: Task[301]"),
        alarm("050", HOUR + timedelta(seconds=20), "Assembly error: Task[301]"),  # 10 s after the clear
        alarm("050", HOUR + timedelta(seconds=90), "assembly error x task[301]"),
        alarm("050", SHIFT, "Assembly error: Task[301]", clears=7 * 3600),  # clears after the one at HOUR
        alarm("050", HOUR, "Gripper not in work position Key [ G7 ]", unit="U2"),
        alarm("050", HOUR, "Gripper not in work position", unit="U2", priority="low"),
        alarm("060", SHIFT, "Assembly error : weld"), alarm("060", HOUR, "Assembly error: weld"),
        alarm("080", HOUR, "Assembly error : weld"), alarm("080", HOUR, "LASER: general error 7"),
    ])
    genealogy = frame(spark, schemas.GENEALOGY, [
        {"product_serial": p, "scanned_child_serial": c, "scanned_child_part": part}
        for p, c, part in [("A", "H1", "PIN"), ("A", "H2", "PIN"), ("A", "S1", "PT00237854-C"),
                           ("B", "H2", "PIN"), ("B", "S2", "PT00237854-C"), ("B", "S3", "PT00237854-C")]], **line)
    names = frame(spark, schemas.WORK_ELEMENT_NAMES, [{"work_element": "W1", "pin_pair": "U1-L2 x & V3-L4 y"}])
    return LineTables(jobs=jobs, param_records=records, alarms=alarms, genealogy=genealogy, work_element_names=names)


@pytest.fixture(scope="module")
def lines(tables):
    return report.in_report_order(report.line_report(tables, STATOR_LINE, AS_OF)).collect()


def section(lines, name, number):
    return [(r.fail_count, r.station_name, r.detail) for r in lines
            if r.report == name and r.section_no == number and r.body_json is not None]


def test_titles_and_order(lines):
    titles = [(r.report, r.section_no, r.title) for r in lines if r.body_json is None]
    assert titles == [
        ("hourly", 1, "Fail count by Parameter: 2024-01-10 04:00 to 05:00"),
        ("hourly", 2, "Fails by Station Pareto:"), ("hourly", 3, "Fails by Hairpin Station:"),
        ("hourly", 4, "Fails by Hairpin Type:"),
        ("shift_end", 0, "Shift Summary (Last Shift)"),
        ("shift_end", 1, "Fail count by Parameter: 2024-01-09 21:00 to 2024-01-10 05:00"),
        ("shift_end", 2, "Fails by Station Pareto:"), ("shift_end", 3, "Fails by Hairpin Station:"),
        ("shift_end", 4, None)]
    keys = [(r.report_no, r.section_no, r.body_json is not None, -(r.fail_count or 0)) for r in lines]
    assert keys == sorted(keys)


HOURLY = [(1, "020", "Insertion"), (1, "040", "Force process value"), (2, "050", "Twisting Check Plate Fails"),
          (1, "050", "G7"), (1, "065", "Value Height Pin X"), (1, "080", "Bad Cuts/Welding Fail"),
          (1, "080", "Laser: General Error"), (1, "100", "Edge DEFECT size"), (1, "110", "Humidity Value"),
          (2, "210", "PartTemperature Value"), (1, "210", "Pdiv HvAc Value")]
# the alarm before the shift's second one clears late, so that one does not count in the shift
SHIFT_END = [(2, "020", "Insertion"), (2, "040", "Force process value"), (2, "050", "Twisting Check Plate Fails"),
             (1, "050", "G7"), (1, "060", "Bad Cuts/Welding Fail"), (1, "065", "Value Height Pin X"),
             (1, "065", "Value Level Difference"), (1, "080", "Bad Cuts/Welding Fail"),
             (1, "080", "Laser: General Error"), (1, "100", "Edge DEFECT size"), (1, "110", "Humidity Value"),
             (2, "210", "PartTemperature Value"), (1, "210", "Pdiv HvAc Value")]


@pytest.mark.parametrize("name, expected", [("hourly", HOURLY), ("shift_end", SHIFT_END)])
def test_by_parameter(lines, name, expected):
    assert sorted(section(lines, name, 1)) == sorted(expected)


def test_station_pareto_counts_units_once_where_asked(lines):
    got = {station: n for n, station, _ in section(lines, "hourly", 2)}
    assert got == {"020": 1, "040": 1, "050": 3, "065": 1, "080": 2, "100": 1, "110": 1, "210": 2}


def test_station_pareto_without_override_sums(tables):
    starts = STATOR_LINE.starts(AS_OF)
    got = {r.station_name: r.fail_count for r in
           families.by_station(tables, STATOR_LINE, starts, unique=False).filter("lookback = 'hourly'").collect()}
    assert got["210"] == 3


def test_by_origin(lines):
    # H1 has two spool records, so its joined rows double; B has two stack parts
    assert sorted(section(lines, "hourly", 3)) == [
        (1, "040", "030-2"), (1, "050", "030-1"), (1, "050", "030-2"), (1, "065", "030-1"), (1, "065", "030-2"),
        (2, "040", "030-1")]
    # the longer report's own limit makes B's angle a violation as well
    assert sorted(section(lines, "shift_end", 3)) == [
        (1, "050", "030-1"), (1, "050", "030-2"), (1, "065", "030-1"), (2, "065", "030-2"),
        (4, "040", "030-1"), (4, "040", "030-2")]


def test_by_pin_type_uses_the_base_limits_and_drops_unnamed(lines):
    expected = [(1, station, f"{origin} / U1-L2 & V3-L4")
                for station in ("065", "065-R") for origin in ("030-1", "030-2")]
    assert sorted(section(lines, "hourly", 4)) == expected
    assert sorted(section(lines, "shift_end", 4)) == expected


def test_body_is_json(lines):
    body = [json.loads(r.body_json) for r in lines if r.report == "hourly" and r.section_no == 4 and r.body_json]
    assert len(body) == 4 and body[0] == {"fail_count": 1, "station_name": "065", "origin": "030-1", "pin_type": "U1-L2 & V3-L4"}


def test_mid_shift_has_no_pin_types(tables):
    titles = report.section_titles(STATOR_LINE, datetime(2024, 1, 10, 7, 5, tzinfo=timezone.utc))
    assert [(r[1], r[2]) for r in titles if r[0] == 2] == [("mid_shift", n) for n in (0, 1, 2, 3)]


def test_empty_tables_give_titles_only(spark):
    none = LineTables(jobs=frame(spark, schemas.JOBS, []), param_records=frame(spark, schemas.PARAM_RECORDS, []),
                      alarms=frame(spark, schemas.ALARMS, []), genealogy=frame(spark, schemas.GENEALOGY, []),
                      work_element_names=frame(spark, schemas.WORK_ELEMENT_NAMES, []))
    got = report.line_report(none, STATOR_LINE, AS_OF).collect()
    assert len(got) == 9 and all(r.body_json is None for r in got)


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_delivery_keeps_reading_order(spark, tables, lines, tmp_path, fmt):
    path = str(tmp_path / fmt)
    report.deliver(report.line_report(tables, STATOR_LINE, AS_OF), path, fmt)
    back = spark.read.format(fmt).load(path)
    assert back.count() == len(lines)
    assert back.filter("body_json IS NULL").count() == 9


def scans_of(plans, file):
    return sum(1 for text in plans for line in text.split("\n") if line.startswith("Location:") and f"/{file}.parquet" in line)


def test_report_reads_every_log_once(spark, monkeypatch):
    """Scans planned for a report, settled tables included: the log and, from the same file, the genealogy."""
    import contextlib
    import io

    from linepareto.operators import settle as settling
    from linepareto.plans import driver_line, families, scans

    plans = []

    def keep(df):
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            df.explain("formatted")
        plans.append(out.getvalue())

    def settle(df, purpose):
        keep(df)
        return settling.settle(df, purpose)

    from linepareto.operators import genealogy
    for module in (families, scans, report, genealogy):
        monkeypatch.setattr(module, "settle", settle)
    keep(report.line_report(driver_line.tables(spark, "/root/testdata/sf0.001"), driver_line.LINE, driver_line.AS_OF))
    got = {name: scans_of(plans, name) for name in ("lineitem", "events", "part", "orders", "supplier")}
    assert got == {"lineitem": 2, "events": 1, "part": 1, "orders": 1, "supplier": 1}


def test_lists_with_too_many_limits_are_scanned_apart(spark, tables, lines, monkeypatch):
    from linepareto.operators import limits
    monkeypatch.setattr(limits, "MAX_LOCAL_LIMITS", 2)
    again = report.in_report_order(report.line_report(tables, STATOR_LINE, AS_OF)).collect()
    assert again == lines


def test_tagged_lists_equal_their_own_scans(spark):
    from linepareto.plans import driver_line as d
    from linepareto.plans import scans as sc

    t = d.tables(spark, "/root/testdata/sf0.001")
    shared = sc.Scans(t, d.LINE, d.SEVERAL, {sc.FORCE, sc.LIMITS})
    for name, own in ((sc.FORCE, families.force_fails), (sc.LIMITS, families.limit_fails)):
        assert sorted(shared.units(name).collect()) == sorted(own(t, d.LINE, d.SEVERAL).select(*shared.units(name).columns).collect())


def test_nothing_is_left_of_a_delivered_report(spark, tables, lines, tmp_path):
    from pathlib import Path

    from linepareto import session

    root = Path(session._root(spark))
    before = set(root.glob("*"))
    report.deliver_line_report(tables, STATOR_LINE, AS_OF, str(tmp_path / "now"), "parquet")
    assert set(root.glob("*")) == before
    assert spark.read.parquet(str(tmp_path / "now")).count() == len(lines)
    with pytest.raises(ZeroDivisionError), session.run(spark):
        session.shared_folder(spark, "x")
        spark.range(3).write.parquet(session.shared_folder(spark, "x"))
        1 / 0
    assert set(root.glob("*")) == before


def test_failed_delivery_leaves_the_earlier_report(spark, tmp_path):
    from pyspark.sql import functions as F

    path = tmp_path / "now"
    columns = "1 AS report_no", "1 AS section_no", "'020' AS station_name", "'x' AS detail"
    for n in (1, 2):
        report.deliver(spark.range(1).selectExpr(*columns, f"{n} AS fail_count"), str(path), "parquet")
        assert spark.read.parquet(str(path)).first().fail_count == n
    with pytest.raises(Exception, match="stop"):
        report.deliver(spark.range(1).selectExpr(*columns).withColumn("fail_count", F.raise_error(F.lit("stop")).cast("int")),
                       str(path), "parquet")
    assert [p.name for p in tmp_path.iterdir()] == ["now"]
    assert spark.read.parquet(str(path)).first().fail_count == 2
