"""SQL counterparts of the registered queries, over the base tables alone.

Written in the plain form (EXISTS over limits, full join chains, LAG per source), not in the
reduced form the Spark side uses, so that a match says something.
"""

from __future__ import annotations

import re

VIEWS = {
    "param_records": """
SELECT l_orderkey AS product_serial, 'SHOP1' AS shop_name, 'LINE1' AS line_name,
       lpad(cast(l_linenumber * 10 AS varchar), 3, '0') AS station_name,
       l_linenumber % 2 + 1 AS work_location_id,
       lpad(cast(l_linenumber % 2 + 1 AS varchar), 2, '0') AS work_location_name,
       p.parameter_id, p.parameter_name,
       CASE p.parameter_id WHEN 1 THEN l_quantity WHEN 2 THEN l_discount WHEN 3 THEN l_tax
            ELSE l_extendedprice END AS parameter_value_num,
       cast(CASE p.parameter_id WHEN 1 THEN l_quantity WHEN 2 THEN l_discount WHEN 3 THEN l_tax
            ELSE l_extendedprice END AS varchar) AS parameter_value_raw,
       CASE l_returnflag WHEN 'R' THEN 'NOK' ELSE 'OK' END AS overall_process_status,
       CASE l_linestatus WHEN 'F' THEN 'FAIL' ELSE 'PASS' END AS result_status,
       l_shipdate AS recorded_at, l_suppkey AS work_element
FROM lineitem, (VALUES (1, 'Quantity Value'), (2, 'Discount Value'), (3, 'Tax Value'),
                       (4, 'Price defect Value')) AS p(parameter_id, parameter_name)""",
    "jobs": """
SELECT o_custkey AS product_serial, 'SHOP1' AS shop_name, 'LINE1' AS line_name,
       '020' AS station_name, o_orderpriority AS work_location_desc,
       CASE WHEN o_orderkey % 2 = 0 THEN '02' ELSE '01' END AS work_location_name,
       CASE o_orderstatus WHEN 'F' THEN 'NOK' ELSE 'OK' END AS job_status, o_orderdate AS started_at
FROM orders""",
    "alarms": """
SELECT event_id, 'LINE1-0' || cast(50 + 10 * (user_id % 4) AS varchar) || '-U'
         || cast(user_id % 8 AS varchar) AS alarm_source,
       ts AS activated_at, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Chicago' AS activated_local,
       CASE WHEN event_id % 17 = 0 THEN NULL
            ELSE ts + cast(floor(value * 60) AS int) * INTERVAL '1' SECOND END AS cleared_at,
       CASE event_type WHEN 'error' THEN 'critical' WHEN 'view' THEN 'low' ELSE 'high' END
         AS alarm_priority_desc,
       CASE event_type WHEN 'error' THEN 'Assembly error : plate Task[301]'
            WHEN 'purchase' THEN 'Gripper not in work pos Key [ G' || cast(event_id % 7 AS varchar) || ' ]'
            WHEN 'signup' THEN 'Laser: General error' ELSE 'Other' END AS alarm_description
FROM events""",
    "genealogy": """
SELECT l_orderkey AS product_serial, l_partkey AS scanned_child_serial,
       CASE WHEN l_linenumber = 1 THEN 'STACK' ELSE 'PIN' END AS scanned_child_part
FROM lineitem""",
    "child_records": """
SELECT p_partkey AS product_serial, '030-' || cast(p_size % 4 + 1 AS varchar) AS station_name,
       'Nest' AS parameter_name, cast(p_size AS varchar) AS parameter_value_raw
FROM part
UNION ALL
SELECT p_partkey, '030-' || cast(p_size % 4 + 1 AS varchar), b.n, 'SPOOL-A ' || p_brand
FROM part, (VALUES ('Wire Batch 1'), ('Wire BATCH 2')) AS b(n) WHERE p_type IN ('SMALL', 'MEDIUM')""",
    "work_element_names": """
SELECT s_suppkey AS work_element,
       CASE WHEN s_suppkey % 10 = 0 THEN 'SOLO' || cast(s_nationkey AS varchar)
            ELSE 'P' || lpad(cast(s_nationkey AS varchar), 4, '0') || ' in & Q'
                 || lpad(cast(s_suppkey % 5 AS varchar), 4, '0') || ' out' END AS pin_pair
FROM supplier WHERE s_acctbal > 0""",
}

# station, mode, pattern, location (0: any), lo, hi
VISION = """('020','eq','Quantity Value',0,3e0,48e0), ('020','eq','Discount Value',0,0e0,0.09e0),
 ('030','eq','Tax Value',0,0.01e0,0.07e0), ('040','ilike','%DEFECT%',0,1000e0,100000e0)"""
VISION_SUMMARY = VISION.replace("0.01e0,0.07e0", "0.01e0,0.01e0")
ELECTRICAL = """('050','eq','Quantity Value',2,5e0,45e0), ('050','eq','Tax Value',2,0e0,0.07e0),
 ('070','eq','Tax Value',0,0e0,0e0)"""
LOCATED = """('060','eq','Quantity Value',1,4e0,47e0), ('060','eq','Discount Value',2,0e0,0.05e0)"""
ALL = f"{VISION}, {ELECTRICAL}, {LOCATED}"
SUMMARY = f"{VISION_SUMMARY}, {ELECTRICAL}, {LOCATED}"
ONE_SIDED = "('010','eq','Quantity Value',0,NULL,45e0), ('010','ilike','%tax%',0,0.01e0,NULL)"
LOOSE = """('0','eq','Tax Value',0,0e0,0.07e0), ('2','ilike','%DEFECT%',0,1000e0,90000e0),
 ('5','eq','Quantity Value',2,5e0,45e0)"""
PATTERNS = """('010','ilike','%value%',0,0e0,50000e0), ('040','ilike','%DEFECT%',0,1000e0,100000e0),
 ('050','ilike','tax VALUE',0,0e0,0e0), ('070','ilike','Discount value',0,0e0,0e0)"""

START = "1996-01-01 00:00:00"
SEVERAL = {"n_short": "2001-03-01 00:00:00", "n_mid": "1999-09-01 00:00:00", "n_shift": START}
ALARM_START = "2024-01-03 06:00:00"
ALARM_SEVERAL = {"n_short": "2024-01-29 06:00:00", "n_mid": "2024-01-15 07:00:00", "n_shift": ALARM_START}
PRIORITY = "alarm_priority_desc IN ('high', 'critical')"
RAW, NUM = "TRY_CAST(r.parameter_value_raw AS double)", "r.parameter_value_num"


def _views(sql: str) -> str:
    """Prefix the derived relations a text names."""
    used = [name for name in VIEWS if re.search(rf"\b{name}\b", sql)]
    return "WITH " + ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in used) + "\n" + sql


def _lim(limits: str, value: str = RAW, by_name: bool = False, loose: bool = False) -> str:
    here = ("r.work_location_name = lpad(cast(l.loc AS varchar), 2, '0')" if by_name
            else "r.work_location_id = l.loc")
    station = "r.station_name ILIKE '%' || l.station || '%'" if loose else "r.station_name = l.station"
    return f"""EXISTS (SELECT 1 FROM (VALUES {limits}) AS l(station, mode, pattern, loc, lo, hi)
 WHERE {station} AND ((l.mode = 'eq' AND r.parameter_name = l.pattern)
   OR (l.mode = 'ilike' AND r.parameter_name ILIKE l.pattern))
 AND (l.loc = 0 OR {here}) AND ({value} < l.lo OR {value} > l.hi))"""


def _fails(where: str, start: str = START, by: str = "station_name, parameter_name") -> str:
    return f"""SELECT count(DISTINCT product_serial) AS fail_count, {by} FROM param_records r
WHERE line_name = 'LINE1' AND recorded_at > TIMESTAMP '{start}' AND {where} GROUP BY {by}"""


def _jobs(start: str = START) -> str:
    return f"""SELECT count(DISTINCT product_serial) AS fail_count, station_name,
 work_location_desc AS parameter_name FROM jobs WHERE shop_name = 'SHOP1' AND station_name = '020'
 AND started_at > TIMESTAMP '{start}' AND work_location_name = '02' AND job_status = 'NOK'
 GROUP BY station_name, work_location_desc"""


def _force(start: str = START) -> str:
    return _fails("station_name = '040' AND parameter_name = 'Quantity Value' AND parameter_id = 1"
                  " AND overall_process_status = 'NOK'", start)


def _checks(start: str = START) -> str:
    nok = "overall_process_status = 'NOK'"
    return _fails(f"({_lim(VISION)} OR ({nok} AND {_lim(f'{ELECTRICAL}, {LOCATED}', NUM)}))", start)


def _unique(start: str = START) -> str:
    inner = _fails(f"overall_process_status = 'NOK' AND {_lim(LOCATED, NUM, True)}", start, "station_name")
    return f"SELECT fail_count AS n, station_name FROM ({inner}) q"


def _alarm_rows(source: str, start: str) -> str:
    return f"""SELECT * FROM alarms WHERE alarm_source ILIKE '%{source}%'
 AND activated_local > TIMESTAMP '{start}' AND {PRIORITY}"""


def _lagged(source: str, start: str) -> str:
    return f"""SELECT *, lag(cleared_at) OVER (PARTITION BY alarm_source ORDER BY activated_at, event_id)
 AS prev_cleared_at FROM ({_alarm_rows(source, start)}) a"""


GAP = "(activated_at > prev_cleared_at + INTERVAL '30' SECOND OR prev_cleared_at IS NULL)"


def _plate(start: str = ALARM_START) -> str:
    return f"""SELECT count(*) AS fail_count, '050' AS station_name, 'Check plate' AS parameter_name
FROM ({_lagged('LINE1-050', start)}) b WHERE {GAP} AND alarm_description ILIKE '%Assembly error%Task[301]%'"""


def _gripper(start: str = ALARM_START) -> str:
    key = "trim(split_part(alarm_description, 'Key', 2), ' []')"
    return f"""SELECT count(*) AS fail_count, '050' AS station_name, {key} AS parameter_name
FROM ({_alarm_rows('LINE1-050', start)}) b WHERE alarm_description ILIKE '%Gripper%work%' GROUP BY {key}"""


def _labelled(station: str, text: str, label: str, start: str) -> str:
    return f"""SELECT count(*) AS fail_count, '{station}' AS station_name, '{label}' AS alarm_description
FROM ({_alarm_rows(f'LINE1-{station}', start)}) b WHERE alarm_description ILIKE '%{text}%' HAVING count(*) > 0"""


def _weld(start: str = ALARM_START) -> str:
    return " UNION ALL ".join(_labelled(*rule, start) for rule in (
        ("060", "Assembly error :", "Weld fail"), ("080", "Assembly error :", "Weld fail"),
        ("080", "Laser: General error", "Laser")))


NEST = "c.parameter_name = 'Nest' AND c.station_name LIKE '030%'"
BUILT = f"""JOIN genealogy built ON built.product_serial = failed.product_serial
 JOIN child_records c ON c.product_serial = built.scanned_child_serial AND {NEST}"""


def _units_by_origin(failing: str, extra: str = "", names: str = "") -> str:
    """Failed units with a stack part, by the station a child part of theirs came from."""
    return f"""SELECT count(DISTINCT failed.product_serial) AS fail_count, failed.station_name, c.station_name AS origin{extra}
 FROM ({failing}) failed {BUILT} {names}
 WHERE EXISTS (SELECT 1 FROM genealogy s WHERE s.product_serial = failed.product_serial AND s.scanned_child_part = 'STACK')
 GROUP BY ALL"""


def _rows_by_origin(failing: str) -> str:
    """Every failed record, edge and child record once for each stack part and each spool record (at least once)."""
    return f"""SELECT cast(sum(stacks * greatest(spools, 1)) AS bigint) AS fail_count, station_name, origin FROM (
 SELECT failed.station_name, c.station_name AS origin,
  (SELECT count(*) FROM genealogy s WHERE s.product_serial = failed.product_serial AND s.scanned_child_part = 'STACK') AS stacks,
  (SELECT count(*) FROM child_records w WHERE w.product_serial = c.product_serial AND w.parameter_name ILIKE '%batch%'
    AND w.parameter_value_raw ILIKE '%spool-a%') AS spools
 FROM ({failing}) failed {BUILT}) combined WHERE stacks > 0 GROUP BY station_name, origin"""


def _origin_rows(start: str = START) -> str:
    return _rows_by_origin(f"""SELECT product_serial, station_name FROM param_records
 WHERE overall_process_status = 'NOK' AND parameter_id = 1 AND parameter_name = 'Quantity Value'
 AND station_name ILIKE '%040%' AND recorded_at > TIMESTAMP '{start}'""")


def _origin_status(start: str = START) -> str:
    return _units_by_origin(f"""SELECT product_serial, station_name FROM param_records WHERE result_status = 'FAIL'
 AND station_name ILIKE '%050%' AND recorded_at > TIMESTAMP '{start}'""")


def _traced(start: str, limits: str, loose: bool = False) -> str:
    return f"""SELECT DISTINCT product_serial, station_name, parameter_name, recorded_at, work_element
 FROM param_records r WHERE recorded_at > TIMESTAMP '{start}' AND {_lim(limits, loose=loose)}"""


def _origin_limits(start: str = START, limits: str = ALL) -> str:
    return _units_by_origin(_traced(start, limits))


SHORT = "left(pin_pair, 5) || ' & ' || substring(pin_pair, position('&' IN pin_pair) + 2, 5)"


def _pins(start: str = START) -> str:
    return _units_by_origin(_traced(start, ALL, True), f", {SHORT} AS pin_type",
                            "JOIN work_element_names named ON named.work_element = failed.work_element")


def _origins(start: str = START, limits: str = ALL) -> str:
    return f"{_origin_rows(start)} UNION ALL {_origin_status(start)} UNION ALL {_origin_limits(start, limits)}"


def _by_parameter(start: str = START, alarm_start: str = START) -> str:
    parts = [_jobs(start), _force(start), _checks(start), _plate(alarm_start), _gripper(alarm_start),
             _weld(alarm_start)]
    union = " UNION ALL ".join(
        f"SELECT fail_count, station_name, {'alarm_description' if p is parts[-1] else 'parameter_name'}"
        f" AS parameter_name FROM ({p}) q{i}" for i, p in enumerate(parts))
    return f"SELECT fail_count, station_name, parameter_name FROM ({union}) c WHERE fail_count > 0"


def _by_station(start: str = START, unique: bool = True) -> str:
    sums = f"""SELECT station_name, cast(sum(fail_count) AS bigint) AS fail_count
 FROM ({_by_parameter(start, start)}) c WHERE station_name IS NOT NULL GROUP BY station_name"""
    if not unique:
        return sums
    return f"""SELECT s.station_name, coalesce(u.n, s.fail_count) AS fail_count FROM ({sums}) s
 LEFT JOIN ({_unique(start)}) u ON s.station_name = u.station_name"""


def _spans(of_start, several: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS lookback, * FROM ({of_start(start)}) q_{name}"
                              for name, start in several.items())


def _wide_debounced() -> str:
    counts = " UNION ALL ".join(f"""SELECT '{name}' AS lookback, alarm_source, count(*) AS n
 FROM ({_lagged('LINE1-050', start)}) b WHERE {GAP} GROUP BY alarm_source"""
                                for name, start in ALARM_SEVERAL.items())
    cols = ", ".join(f"cast(coalesce(sum(n) FILTER (WHERE lookback = '{name}'), 0) AS bigint) AS {name}"
                     for name in ALARM_SEVERAL)
    return f"SELECT alarm_source, {cols} FROM ({counts}) c GROUP BY alarm_source"


def _sections(reports, headings: dict[str, str]) -> str:
    """Reports `(name, start, from and to of the title as SQL, limits, pin types)` in order."""
    rows, parts = [], []
    for no, (name, start, span, limits, pins) in enumerate(reports, start=1):
        heading = headings.get(name)
        rows += [f"({no}, '{name}', 0, '{heading}')"] if heading else []
        rows += [f"({no}, '{name}', 1, 'Fail count by Parameter: ' || {span})",
                 f"({no}, '{name}', 2, 'Fails by Station Pareto:')",
                 f"({no}, '{name}', 3, 'Fails by Hairpin Station:')"]
        rows += [f"({no}, '{name}', 4, {'NULL' if heading else chr(39) + 'Fails by Hairpin Type:' + chr(39)})"] if pins else []
        sections = [(1, _by_parameter(start, start), ["parameter_name"]), (2, _by_station(start), []),
                    (3, _origins(start, limits), ["origin"])] + [(4, _pins(start), ["origin", "pin_type"])] * pins
        for section, sql, details in sections:
            detail = " || ' / ' || ".join(details) or "''"
            body = ", ".join(f"'{c}', {c}" for c in ["fail_count", "station_name", *details])
            parts.append(f"""SELECT {no}, '{name}', {section}, NULL, fail_count, station_name, {detail},
 cast(json_object({body}) AS varchar) FROM ({sql}) s{no}{section}""")
    titles = f"""SELECT report_no, report, section_no, title, NULL::bigint AS fail_count,
 NULL::varchar AS station_name, NULL::varchar AS detail, NULL::varchar AS body_json
 FROM (VALUES {', '.join(rows)}) AS t(report_no, report, section_no, title)"""
    return " UNION ALL ".join([titles, *parts])


HEADINGS = {"mid_shift": "Mid-Shift Summary", "shift_end": "Shift Summary (Last Shift)"}


def _shift_end(hourly: str, shift: str) -> str:
    """Report as of 2024-01-31 05:20 plant time: hourly and shift end."""
    until = {hourly: "05:00", shift: "2024-01-31 05:00"}
    return _sections([(name, start, f"'{start[:16]} to {until[start]}'", limits, True)
                      for name, start, limits in (("hourly", hourly, ALL), ("shift_end", shift, SUMMARY))], HEADINGS)


def _arrivals() -> str:
    """All reports as of the newest measurement: one, two and four years of 365 days."""
    reports, starts = [], {}
    for name, years, limits, pins in (("hourly", 1, ALL, True), ("mid_shift", 2, SUMMARY, False), ("shift_end", 4, SUMMARY, True)):
        marker = f"2{years}00-01-01 00:00:00"  # stands for a threshold that the tables give
        starts[marker] = f"(SELECT date_trunc('hour', max(recorded_at) - INTERVAL {years * 365 * 24} HOUR) FROM param_records)"
        until = "%H:00" if name == "hourly" else "%Y-%m-%d %H:00"
        span = (f"strftime(TIMESTAMP '{marker}', '%Y-%m-%d %H:00') || ' to ' || "
                f"strftime((SELECT max(recorded_at) FROM param_records), '{until}')")
        reports.append((name, marker, span, limits, pins))
    sql = _sections(reports, HEADINGS)
    for marker, start in starts.items():
        sql = sql.replace(f"TIMESTAMP '{marker}'", start)
    return sql


def _closed(width: int) -> str:
    return f"""window_start + INTERVAL {width} HOUR <= (SELECT date_trunc('milliseconds', max(ts))
 - INTERVAL 1 HOUR FROM events)"""


TUMBLING = """SELECT date_trunc('hour', activated_at) AS window_start, alarm_source,
 count(DISTINCT alarm_description) AS n FROM alarms GROUP BY 1, 2"""
SLIDING = """SELECT window_start, alarm_source, count(DISTINCT alarm_description) AS n
FROM (SELECT alarm_source, alarm_description, unnest(generate_series(
        date_trunc('hour', activated_at) - INTERVAL 7 HOUR, date_trunc('hour', activated_at),
        INTERVAL 1 HOUR)) AS window_start FROM alarms) u GROUP BY window_start, alarm_source"""


def oracle_sql() -> dict[str, str]:
    nok = "overall_process_status = 'NOK'"
    hours = ", ".join(f"cast({test} AS int) AS {name}" for name, test in (
        ("hourly", "true"), ("mid_shift", "local_hour IN (1, 11)"), ("shift_end", "local_hour IN (5, 15)")))
    lookbacks = ", ".join(f"""count(DISTINCT CASE WHEN recorded_at > TIMESTAMP '{start}'
 THEN product_serial END) AS {name}""" for name, start in SEVERAL.items())
    texts = {
        "station_job_fails": _jobs(),
        "status_fails": _force(),
        "limit_violations_by_parameter": _fails(f"{nok} AND {_lim(ALL)}"),
        "limit_violations_unfiltered_status": _fails(_lim(ALL)),
        "limit_violations_numeric": _fails(f"{nok} AND {_lim(ALL, NUM)}"),
        "limit_violations_by_location": _fails(_lim(f"{ELECTRICAL}, {LOCATED}", NUM)),
        "limit_violations_patterns": _fails(_lim(PATTERNS)),
        "limit_violations_variant": _fails(_lim(SUMMARY)),
        "limit_violations_table": _fails(_lim(f"{SUMMARY}, {ONE_SIDED}")),
        "limit_violations_loose": _fails(_lim(LOOSE, loose=True)),
        "limit_violations_one_scan": _checks(),
        "unique_failed_units": _unique(),
        "alarm_count_constant_group": _labelled("060", "Assembly error :", "Weld fail", ALARM_START),
        "alarm_weld_and_laser": _weld(),
        "alarm_debounced": _plate(),
        "alarm_by_extracted_key": _gripper(),
        "alarm_debounced_and_keys": f"{_plate()} UNION ALL {_gripper()}",
        "alarm_local_time": f"""SELECT date_trunc('hour', activated_local) AS local_hour, count(*) AS n
 FROM alarms WHERE activated_local > TIMESTAMP '{ALARM_START}' GROUP BY 1""",
        "origin_rowcount": _origin_rows(),
        "origin_units_status": _origin_status(),
        "origin_units_limits": _origin_limits(),
        "origin_units_shuffled": _origin_limits(),
        "origin_rowcount_colocated": _origin_rows(),
        "origin_units_colocated": _origin_limits(),
        "pin_type_units": _pins(),
        "pin_type_units_colocated": _pins(),
        "origin_pareto": _origins(),
        "short_pair_names": f"SELECT {SHORT} AS pin_type, count(*) AS n FROM work_element_names GROUP BY 1",
        "combined_pareto": _by_parameter(),
        "station_pareto_sum": _by_station(unique=False),
        "station_pareto_override": _by_station(),
        "lookback_1_4_8": f"""SELECT station_name, {lookbacks} FROM param_records r
 WHERE recorded_at > TIMESTAMP '{START}' AND {_lim(ALL)} GROUP BY station_name""",
        "lookback_by_parameter": _spans(lambda start: _fails(_lim(ALL), start), SEVERAL),
        "lookback_origin": _spans(_origin_rows, SEVERAL),
        "lookback_debounced": _wide_debounced(),
        "windowed_units": TUMBLING.replace("window_start", "hour_start"),
        "sliding_units": SLIDING,
        "due_reports": f"""SELECT local_hour, n, {hours} FROM (SELECT cast(hour(activated_local) AS int)
 AS local_hour, count(*) AS n FROM alarms GROUP BY 1) h""",
        "report_sections": _shift_end("2000-02-06 05:00:00", "1996-02-07 05:00:00"),
        "report_sections_alarms": _shift_end("2024-01-25 05:00:00", "2024-01-04 05:00:00"),
        "stream_units": f"SELECT * FROM ({TUMBLING}) w WHERE {_closed(1)}",
        "sketched_units": SLIDING,  # exact for as few units as these windows have
        "stream_sketches": f"SELECT * FROM ({SLIDING}) w WHERE {_closed(8)}",
        "stream_sliding_units": f"SELECT * FROM ({SLIDING}) w WHERE {_closed(8)}",
        "stream_debounced": f"""SELECT alarm_source, count(*) AS n FROM (SELECT *, lag(cleared_at) OVER
 (PARTITION BY alarm_source ORDER BY activated_at, event_id) AS prev_cleared_at FROM alarms) b
 WHERE {GAP} GROUP BY alarm_source""",
        "stream_limit_check": f"""SELECT count(DISTINCT product_serial) AS fail_count, station_name,
 parameter_name FROM param_records r WHERE {_lim(ALL)} GROUP BY station_name, parameter_name""",
        "stream_line_report": _arrivals(),
        "stream_report": f"""SELECT 1 AS report_no, 'jobs' AS report, 1 AS section_no, fail_count,
 station_name, parameter_name AS detail FROM (SELECT count(DISTINCT product_serial) AS fail_count,
 station_name, work_location_desc AS parameter_name FROM jobs WHERE shop_name = 'SHOP1'
 AND work_location_name = '02' AND job_status = 'NOK'
 AND started_at > (SELECT max(o_orderdate) - INTERVAL 4 YEAR FROM orders) GROUP BY ALL) q""",
    }
    return {name: _views(sql) for name, sql in texts.items()}
