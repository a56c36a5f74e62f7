"""What the lists of a report share: every log is read once, whatever the number of lists.

Each record of the measurement log is tagged with the lists it counts in and reduced to one row per
list, station, parameter, work element and unit. Alarms of any rule, the genealogy of all failing units
and the records of their children are each taken from one scan as well.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping
from dataclasses import dataclass, field
from datetime import datetime
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, functions as F

from linepareto.functions.text import icontains
from linepareto.functions.times import after, local_literal
from linepareto.operators import alarms as al, genealogy as gen, limits as lim
from linepareto.operators.limits import LimitCheck, for_variant
from linepareto.operators.pareto import stack
from linepareto.operators.settle import Settled, dealt_out, settle
from linepareto.operators.units import BY_PARAMETER, count_units, scope
from linepareto.plans.config import LineConfig
from linepareto.sources.layout import NUMBER, from_day, once
from linepareto.sources.tables import LineTables

Lookbacks = Mapping[str, datetime]

# Lists read off the measurement log; the traced limits are one list per variant.
FORCE, LIMITS, UNIQUE, FORCE_ROWS, RESULT, TRACED, PINS = "force", "limits", "unique", "force rows", "result", "traced", "pins"
BY_PARAMETER_LISTS, ORIGIN_LISTS = frozenset({FORCE, LIMITS}), frozenset({FORCE_ROWS, RESULT, TRACED})

_KEPT = ("station_name", "parameter_name", "work_element", "product_serial", "recorded_at")
_GROUP = ("list", *_KEPT[:-1])


def on_line(tables: LineTables, cfg: LineConfig, lookbacks: Lookbacks) -> DataFrame:
    """The line's measurements of the widest lookback."""
    start = min(lookbacks.values())
    recent = from_day(tables.param_records, start).filter(after(F.col("recorded_at"), start))
    return scope(recent, line_name=cfg.line)


def force_failed(cfg: LineConfig, exact: bool) -> Column:
    """A failed force check: at its station, or at any with that one in its name."""
    station = F.col("station_name") == cfg.force.station if exact else icontains(F.col("station_name"), cfg.force.station)
    return (station & (F.col("parameter_name") == cfg.force.parameter) & (F.col("parameter_id") == cfg.force.parameter_id)
            & (F.col("overall_process_status") == cfg.fail_status))


def result_failed(cfg: LineConfig) -> Column:
    return icontains(F.col("station_name"), cfg.traced_status_station) & (F.col("result_status") == cfg.fail_result)


def traced_check(cfg: LineConfig, variant: str | None = None) -> LimitCheck:
    return cfg.traced_check._replace(limits=for_variant(cfg.traced_check.limits, variant))


def by_variant(cfg: LineConfig, lookbacks: Lookbacks) -> dict[str | None, dict[str, datetime]]:
    """Lookbacks by the limits variant their report uses."""
    of_report = {r.name: r.variant for r in cfg.reports}
    found: dict[str | None, dict[str, datetime]] = {}
    for name, start in lookbacks.items():
        found.setdefault(of_report.get(name), {})[name] = start
    return found


def alarm_matches(cfg: LineConfig) -> Column:
    """Alarms of any rule; those of the check plate whatever they describe, since they reset its gap."""
    rules = [icontains(F.col("alarm_source"), rule.source) & icontains(F.col("alarm_description"), rule.description)
             for rule in (cfg.gripper, *cfg.weld)]
    return reduce(lambda a, b: a | b, rules, icontains(F.col("alarm_source"), cfg.plate.source))


@dataclass(frozen=True)
class Scans:
    """The settled relations that `lists` over these lookbacks are read off, each computed when first asked for."""

    tables: LineTables
    cfg: LineConfig
    lookbacks: Lookbacks
    lists: Collection[str]
    pin_lookbacks: Lookbacks = field(default_factory=dict)

    @cached_property
    def variants(self) -> dict[str, tuple[str | None, dict[str, datetime]]]:
        """Lists of traced limits: their variant and the lookbacks that count with it."""
        return {f"{TRACED} {variant or 'base'}": (variant, starts)
                for variant, starts in by_variant(self.cfg, self.lookbacks).items()}

    def _conditions(self, records: DataFrame) -> tuple[dict[str, Column], dict[str, tuple], Column]:
        """The list conditions on a record, lists with too many limits to be tested in place, and what any list needs."""
        cfg = self.cfg
        plain = {FORCE: force_failed(cfg, True), FORCE_ROWS: force_failed(cfg, False), RESULT: result_failed(cfg)}
        found = {name: condition for name, condition in plain.items() if name in self.lists}
        checked = {LIMITS: (cfg.checks, False), UNIQUE: ([cfg.unique_check], False), PINS: ([traced_check(cfg)], True)}
        checked = {name: check for name, check in checked.items() if name in self.lists}
        if TRACED in self.lists:
            checked |= {name: ([traced_check(cfg, variant)], False) for name, (variant, _) in self.variants.items()}
        apart, needed, tested = {}, list(found.values()), {False: [], True: []}
        for name, (checks, loose) in checked.items():
            condition = lim.violation(records, checks, loose)
            if condition is None:
                apart[name] = (checks, loose)
            else:
                found[name] = condition & (F.col("shop_name") == cfg.shop) if name == PINS else condition
                tested[loose] += checks
        if tested[True]:  # limits of any station with theirs in its name: nearly every record may be outside
            return found, apart, F.lit(True)
        number = NUMBER if NUMBER in records.columns else None
        needed += [lim.might_violate(lim.collapsed(set(tested[False])), raw=number)] * bool(tested[False])
        return found, apart, reduce(lambda a, b: a | b, needed, F.lit(False))

    def tagged(self, records: DataFrame) -> DataFrame:
        """(list and what is kept) for every list a record counts in."""
        conditions, apart, needed = self._conditions(records)
        lists = F.array(*[F.when(condition, F.lit(name)) for name, condition in conditions.items()])
        possible = records.filter(needed)
        if PINS in self.lists:  # much to test per record; by unit, so that the groups below need no second shuffle
            possible = dealt_out(possible, "product_serial")
        tested = lim.measured(possible).select(*_KEPT, lists.alias("lists"))
        # outer, so that the tags are not computed a second time to see whether there are any
        found = [tested.select(*_KEPT, F.explode_outer("lists").alias("list")).filter("list IS NOT NULL")] * bool(conditions)
        for name, (checks, loose) in apart.items():
            own = scope(records, shop_name=self.cfg.shop) if name == PINS else records
            found.append(lim.check_violations(own, checks, loose).select(*_KEPT, F.lit(name).alias("list")))
        return stack(found)

    @cached_property
    def failures(self) -> Settled:
        """(list, station_name, parameter_name, work_element, product_serial, newest, and rows per lookback)."""
        records = on_line(self.tables, self.cfg, {**self.lookbacks, **self.pin_lookbacks})
        rows = [F.count_if(after(F.col("recorded_at"), start)).alias(f"rows_{name}") for name, start in self.lookbacks.items()]
        return settle(self.tagged(records).groupBy(*_GROUP).agg(F.max("recorded_at").alias("newest"), *rows), "failures")

    def units(self, name: str, by=BY_PARAMETER) -> DataFrame:
        """Distinct units of a list per lookback and group."""
        return count_units(self.failures.df.filter(F.col("list") == name), "newest", self.lookbacks, by)

    def failing_rows(self) -> DataFrame:
        """As `genealogy.failing_rows` for the force check."""
        return self.failures.df.filter(F.col("list") == FORCE_ROWS).groupBy(
            F.col("product_serial").alias("parent"), "station_name").agg(
            *[F.sum(f"rows_{name}").alias(name) for name in self.lookbacks])

    def failing_units(self) -> DataFrame:
        """As `genealogy.failing_units` for all traced lists, with their `list`; work elements of pins only."""
        traced = self.failures.df.filter(F.col("list").isin(RESULT, PINS, *self.variants))
        element = F.when(F.col("list") == PINS, F.col("work_element"))
        return traced.groupBy(F.col("product_serial").alias("parent"), "station_name", "list", element.alias("work_element")).agg(
            F.max("newest").alias("newest"))

    @cached_property
    def alarms(self) -> DataFrame:
        """Alarms of any rule in the widest lookback."""
        recent = al.alarm_scope(self.tables.alarms, "", self.cfg.priorities, min(self.lookbacks.values()), self.cfg.plant_tz)
        return settle(recent.filter(alarm_matches(self.cfg)), "alarms").df

    def children(self, built: gen.Links) -> tuple[DataFrame, DataFrame]:
        """Origins and spools of the children in `built`."""
        cfg = self.cfg
        records = scope(once(self.tables.child_records), shop_name=cfg.shop, line_name=cfg.line)
        parts = gen.child_parts(records, cfg.child_prefix, cfg.child_parameter, cfg.spool_parameter, cfg.spool_value)
        kept = settle(gen.near(parts, built), "children").df
        return kept.filter("has_origin").select("child", "origin"), kept.filter("has_spool").select("child")


def hourly_partials(records: DataFrame, cfg: LineConfig) -> DataFrame:
    """Records of one arrival reduced per list, group, unit and hour: `newest`, `rows`, the `hour` and its `day`.

    An hour holds what is later than its start, up to its end, as lookbacks that start on the hour do.
    """
    every = {report.name: datetime.min for report in cfg.reports}
    scans = Scans(LineTables(), cfg, every, BY_PARAMETER_LISTS | ORIGIN_LISTS | {UNIQUE, PINS}, every)
    hour = F.date_trunc("hour", F.col("recorded_at") - F.expr("INTERVAL 1 MICROSECOND")).cast("timestamp_ntz")
    return (scans.tagged(scope(records, line_name=cfg.line).filter("recorded_at IS NOT NULL"))
            .groupBy(*_GROUP, hour.alias("hour")).agg(F.max("recorded_at").alias("newest"), F.count("*").alias("rows"))
            .withColumn("day", F.to_date("hour")))


@dataclass(frozen=True)
class MergedScans(Scans):
    """The same read off hourly partials; the measurement log is not read at all."""

    partials: DataFrame | None = None

    @cached_property
    def failures(self) -> Settled:
        start = min({**self.lookbacks, **self.pin_lookbacks}.values())
        recent = self.partials.filter((F.col("day") >= F.lit(start.date())) & (F.col("hour") >= local_literal(start)))
        rows = [F.coalesce(F.sum(F.when(F.col("hour") >= local_literal(since), F.col("rows"))), F.lit(0)).alias(f"rows_{name}")
                for name, since in self.lookbacks.items()]
        return settle(recent.groupBy(*_GROUP).agg(F.max("newest").alias("newest"), *rows), "failures")
