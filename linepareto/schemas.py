"""Declared schemas of the five source tables.

Plant-local times are `timestamp_ntz`; alarm times are UTC instants.
"""

from pyspark.sql import types as T

_S, _I, _D = T.StringType(), T.IntegerType(), T.DoubleType()
_LOCAL, _UTC = T.TimestampNTZType(), T.TimestampType()


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


JOBS = _schema(
    ("product_serial", _S), ("shop_name", _S), ("line_name", _S), ("station_name", _S),
    ("work_location_name", _S), ("work_location_desc", _S), ("job_status", _S),
    ("started_at", _LOCAL),
)

PARAM_RECORDS = _schema(
    ("product_serial", _S), ("product_part", _S), ("shop_name", _S), ("line_name", _S),
    ("station_name", _S), ("work_location_id", _I), ("work_location_name", _S),
    ("work_element", _S), ("parameter_id", _I), ("parameter_name", _S),
    ("parameter_value_raw", _S), ("parameter_value_num", _D),
    ("overall_process_status", _S), ("result_status", _S), ("recorded_at", _LOCAL),
)

ALARMS = _schema(
    ("alarm_source", _S), ("activated_at", _UTC), ("cleared_at", _UTC),
    ("alarm_priority_desc", _S), ("alarm_description", _S),
)

GENEALOGY = _schema(
    ("product_serial", _S), ("scanned_child_serial", _S), ("scanned_child_part", _S),
    ("product_part_desc", _S), ("child_part_desc", _S), ("scanned_child_data", _S),
    ("shop_name", _S), ("line_name", _S), ("consumed_at", _LOCAL),
)

WORK_ELEMENT_NAMES = _schema(("work_element", _S), ("pin_pair", _S))

LIMITS = _schema(
    ("station_name", _S), ("match_mode", _S), ("pattern", _S), ("work_location_id", _I),
    ("lo", _D), ("hi", _D), ("variant", _S),
)
