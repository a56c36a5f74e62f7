"""What a report counts: one `LineConfig` per line, and the reports with their lookbacks."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from typing import NamedTuple

from linepareto.functions.times import lookback_start, to_local
from linepareto.operators.limits import LimitCheck
from linepareto.plans import limit_values as values


class AlarmRule(NamedTuple):
    """Alarms whose source and description contain these texts (wildcards allowed)."""

    station: str
    source: str
    description: str
    label: str | None = None  # None: labelled by the key in the description


class StatusCheck(NamedTuple):
    station: str
    parameter: str
    parameter_id: int


class Report(NamedTuple):
    name: str
    hours: int
    gate: tuple[int, ...]  # plant hours the report is due in; empty: always
    heading: str | None
    pin_types: bool
    variant: str | None


@dataclass(frozen=True)
class LineConfig:
    shop: str
    line: str
    plant_tz: str
    fail_status: str
    fail_result: str
    priorities: tuple[str, ...]
    gap: str
    job_station: str
    job_location: str
    force: StatusCheck
    plate: AlarmRule
    gripper: AlarmRule
    weld: tuple[AlarmRule, ...]
    checks: tuple[LimitCheck, ...]
    unique_check: LimitCheck
    child_prefix: str
    child_parameter: str
    stack_parts: tuple[str, ...]
    spool_parameter: str
    spool_value: str
    traced_status_station: str
    traced_check: LimitCheck
    reports: tuple[Report, ...]

    def due(self, as_of: datetime) -> tuple[Report, ...]:
        """Reports due at an instant, by the plant's clock."""
        hour = to_local(as_of, self.plant_tz).hour
        return tuple(r for r in self.reports if not r.gate or hour in r.gate)

    def starts(self, as_of: datetime) -> dict[str, datetime]:
        """Lookback thresholds of the reports due, in plant time."""
        local = to_local(as_of, self.plant_tz)
        return {r.name: lookback_start(local, r.hours) for r in self.due(as_of)}


# The reports with lookback hours, the plant hours they are due in and headings.
REPORTS = (
    Report("hourly", 1, (), None, True, None),
    Report("mid_shift", 4, (1, 11), "Mid-Shift Summary", False, values.SUMMARY_VARIANT),
    Report("shift_end", 8, (5, 15), "Shift Summary (Last Shift)", True, values.SUMMARY_VARIANT),
)

# Section titles in report order.
SECTION_TITLES = (
    "Fail count by Parameter:",
    "Fails by Station Pareto:",
    "Fails by Hairpin Station:",
    "Fails by Hairpin Type:",
)

# The scope, stations, parts, alarm texts and labels of the stator line.
STATOR_LINE = LineConfig(
    shop="DU02",
    line="STTR01",
    plant_tz="America/Chicago",
    fail_status="NOK",
    fail_result="FAIL",
    priorities=("high", "critical"),
    gap="30 seconds",
    job_station="020",
    job_location="02",
    force=StatusCheck("040", "Force process value", 2),
    plate=AlarmRule("050", "STTR01-050", "Assembly error%Task[301]", "Twisting Check Plate Fails"),
    gripper=AlarmRule("050", "STTR01-050", "Gripper%work"),
    weld=(
        AlarmRule("060", "STTR01-060", "Assembly error :", "Bad Cuts/Welding Fail"),
        AlarmRule("080", "STTR01-080", "Assembly error :", "Bad Cuts/Welding Fail"),
        AlarmRule("080", "STTR01-080", "Laser: General error", "Laser: General Error"),
    ),
    checks=(
        LimitCheck(values.VISION_065, "raw"),
        LimitCheck(values.VISION_100, "raw"),
        LimitCheck(values.ELECTRICAL_110, "num", "NOK"),
        LimitCheck(values.ELECTRICAL_210, "num", "NOK", "id"),
    ),
    unique_check=LimitCheck(values.ELECTRICAL_210, "num", "NOK", "name"),
    child_prefix="030",
    child_parameter="Nest",
    stack_parts=("PT00237854-C",),
    spool_parameter="batch",
    spool_value="PT00237846-C",
    traced_status_station="050",
    traced_check=LimitCheck(values.VISION_065 + values.VISION_065_SUMMARY, "raw"),
    reports=REPORTS,
)
