"""The report's queries. Each counts one kind of failure for all lookbacks in one pass.

Every function takes the source tables, the line's configuration and the lookbacks (name to
plant-time threshold) and returns `(lookback, fail_count, ...)` rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from linepareto.functions.text import icontains
from linepareto.operators import alarms as al, genealogy as gen, pareto
from linepareto.operators.limits import check_violations, status_fails
from linepareto.operators.settle import MAX_BROADCAST_KEYS, Settled, settle, together
from linepareto.operators.units import BY_PARAMETER, count_units, nonzero, scope, tall
from linepareto.plans.config import AlarmRule, LineConfig
from linepareto.plans.scans import (
    BY_PARAMETER_LISTS, FORCE, LIMITS, ORIGIN_LISTS, PINS, RESULT, UNIQUE, Scans, force_failed, on_line, result_failed, traced_check)
from linepareto.sources.layout import SPREAD, from_day, once
from linepareto.sources.tables import LineTables

Lookbacks = Mapping[str, datetime]


def job_fails(tables: LineTables, cfg: LineConfig, lookbacks: Lookbacks) -> DataFrame:
    """Units whose job failed at the first station, by work location."""
    jobs = from_day(tables.jobs, min(lookbacks.values()))
    failed = scope(jobs, shop_name=cfg.shop, line_name=cfg.line, station_name=cfg.job_station,
                   work_location_name=cfg.job_location, job_status=cfg.fail_status)
    return count_units(failed.withColumnRenamed("work_location_desc", "parameter_name"),
                       "started_at", lookbacks)


def force_fails(tables: LineTables, cfg: LineConfig, lookbacks: Lookbacks) -> DataFrame:
    """Units that failed the force check by status."""
    failed = status_fails(on_line(tables, cfg, lookbacks), *cfg.force, cfg.fail_status)
    return count_units(failed, "recorded_at", lookbacks)


def limit_fails(tables: LineTables, cfg: LineConfig, lookbacks: Lookbacks) -> DataFrame:
    """Units outside a limit, by station and parameter; all stations in one scan."""
    failed = check_violations(on_line(tables, cfg, lookbacks), cfg.checks)
    return count_units(failed, "recorded_at", lookbacks)


def _scoped(tables: LineTables, cfg: LineConfig, rule: AlarmRule, lookbacks: Lookbacks, scans: Scans | None) -> DataFrame:
    if scans is not None:
        return scans.alarms.filter(icontains(F.col("alarm_source"), rule.source))
    return al.alarm_scope(tables.alarms, rule.source, cfg.priorities, min(lookbacks.values()), cfg.plant_tz)


def plate_fails(tables: LineTables, cfg: LineConfig, lookbacks: Lookbacks, scans: Scans | None = None) -> DataFrame:
    """Debounced alarms of the check plate; a zero row per lookback without any."""
    ordered = al.with_prev_cleared(_scoped(tables, cfg, cfg.plate, lookbacks, scans), settled=scans is not None)
    flags = al.debounced_flags(ordered, lookbacks, cfg.plant_tz, cfg.gap)
    matching = ordered.filter(icontains(F.col("alarm_description"), cfg.plate.description))
    wide = al.count_flags(matching, flags).select(
        "*", F.lit(cfg.plate.station).alias("station_name"), F.lit(cfg.plate.label).alias("parameter_name"))
    return tall(wide, list(lookbacks), BY_PARAMETER, keep_zero=True)


def gripper_fails(tables: LineTables, cfg: LineConfig, lookbacks: Lookbacks, scans: Scans | None = None) -> DataFrame:
    """Gripper alarms by the key in their description."""
    found = _scoped(tables, cfg, cfg.gripper, lookbacks, scans).filter(
        icontains(F.col("alarm_description"), cfg.gripper.description))
    flags = al.lookback_flags(tables.alarms, lookbacks, cfg.plant_tz)
    keyed = found.select("activated_at", F.lit(cfg.gripper.station).alias("station_name"),
                         al.key_after(F.col("alarm_description")).alias("parameter_name"))
    return tall(al.count_flags(keyed, flags, BY_PARAMETER), list(lookbacks), BY_PARAMETER)


def weld_fails(tables: LineTables, cfg: LineConfig, lookbacks: Lookbacks, scans: Scans | None = None) -> DataFrame:
    """Alarms per weld and laser rule; all rules in one scan."""
    rules = [(rule, icontains(F.col("alarm_source"), rule.source)
              & icontains(F.col("alarm_description"), rule.description)) for rule in cfg.weld]
    flags = al.lookback_flags(tables.alarms, lookbacks, cfg.plant_tz)
    kept = F.lit(False)
    for _, matches in rules:
        kept = kept | matches
    alarms = scans.alarms if scans is not None else al.alarm_scope(
        tables.alarms, "", cfg.priorities, min(lookbacks.values()), cfg.plant_tz)
    found = alarms.filter(kept)
    counts = {(number, name): F.count_if(matches & flag).alias(f"n{number}_{name}")
              for number, (_, matches) in enumerate(rules) for name, flag in flags.items()}
    rows = [F.struct(F.lit(name).alias("lookback"), F.col(f"n{number}_{name}").alias("fail_count"),
                     F.lit(cfg.weld[number].station).alias("station_name"),
                     F.lit(cfg.weld[number].label).alias("alarm_description"))
            for number, name in counts]
    return nonzero(found.agg(*counts.values()).select(F.inline(F.array(*rows))))


def _children(tables: LineTables, cfg: LineConfig) -> DataFrame:
    return scope(once(tables.child_records), shop_name=cfg.shop, line_name=cfg.line)


def _colocated(tables: LineTables) -> bool:
    """Whether genealogy and child records were written by `write_colocated`."""
    return SPREAD in tables.genealogy.columns and SPREAD in tables.child_records.columns


def _in_place(tables: LineTables, cfg: LineConfig, parents: Settled, max_keys: int = MAX_BROADCAST_KEYS) -> tuple[gen.Links, DataFrame, DataFrame]:
    """Links, origins and spools in their buckets."""
    records = scope(tables.child_records, shop_name=cfg.shop, line_name=cfg.line)
    built = gen.in_place(scope(tables.genealogy, line_name=cfg.line), parents, cfg.stack_parts, SPREAD, cfg.shop, max_keys)
    return (built, gen.child_origins(records, cfg.child_prefix, cfg.child_parameter, SPREAD),
            gen.wire_spools(records, cfg.child_prefix, cfg.spool_parameter, cfg.spool_value, SPREAD))


def _origins(tables: LineTables, cfg: LineConfig, built: gen.Links, max_keys: int = MAX_BROADCAST_KEYS) -> DataFrame:
    origins = gen.child_origins(_children(tables, cfg), cfg.child_prefix, cfg.child_parameter)
    return gen.near(origins, built, max_keys)


def _spools(tables: LineTables, cfg: LineConfig, built: gen.Links) -> DataFrame:
    spools = gen.wire_spools(_children(tables, cfg), cfg.child_prefix, cfg.spool_parameter, cfg.spool_value)
    return gen.near(spools, built)


def _links(tables: LineTables, cfg: LineConfig, parents: Settled, max_keys: int = MAX_BROADCAST_KEYS) -> gen.Links:
    return gen.links(scope(tables.genealogy, line_name=cfg.line), parents, cfg.stack_parts, cfg.shop, max_keys)


def _failed_limits(tables: LineTables, cfg: LineConfig, lookbacks: Lookbacks, variant: str | None) -> DataFrame:
    return check_violations(on_line(tables, cfg, lookbacks), [traced_check(cfg, variant)])


def _failed_pins(tables: LineTables, cfg: LineConfig, lookbacks: Lookbacks) -> DataFrame:
    """Records outside a limit at any station that has the limited one in its name."""
    records = scope(on_line(tables, cfg, lookbacks), shop_name=cfg.shop)
    return check_violations(records, [traced_check(cfg)], loose_stations=True)


def force_fails_by_origin(tables: LineTables, cfg: LineConfig, lookbacks: Lookbacks) -> DataFrame:
    """Force-check failures by origin of the child parts, counted in joined rows."""
    failed = on_line(tables, cfg, lookbacks).filter(force_failed(cfg, exact=False))
    failing = settle(gen.failing_rows(failed, lookbacks), "failing")
    if _colocated(tables):
        return gen.origin_rows_in_place(failing.df, *_in_place(tables, cfg, failing), list(lookbacks), SPREAD)
    built = _links(tables, cfg, failing)
    return gen.origin_rows(failing.df, built, _origins(tables, cfg, built), _spools(tables, cfg, built),
                           list(lookbacks))


def _units_by_origin(tables: LineTables, cfg: LineConfig, failed: DataFrame, lookbacks: Lookbacks,
                     max_keys: int = MAX_BROADCAST_KEYS) -> DataFrame:
    failing = settle(gen.failing_units(failed, lookbacks), "failing")
    if _colocated(tables):
        built, origins, _ = _in_place(tables, cfg, failing, max_keys)
        return gen.origin_units_in_place(failing.df, built, origins, lookbacks, SPREAD)
    built = _links(tables, cfg, failing, max_keys)
    return gen.origin_units(failing.df, built, _origins(tables, cfg, built, max_keys), lookbacks)


def result_fails_by_origin(tables: LineTables, cfg: LineConfig, lookbacks: Lookbacks) -> DataFrame:
    """Units failed by result at one station, by origin of their child parts."""
    return _units_by_origin(tables, cfg, on_line(tables, cfg, lookbacks).filter(result_failed(cfg)), lookbacks)


def limit_fails_by_origin(tables: LineTables, cfg: LineConfig, lookbacks: Lookbacks, variant: str | None = None,
                          max_keys: int = MAX_BROADCAST_KEYS) -> DataFrame:
    """Units outside a limit, by origin of their child parts."""
    return _units_by_origin(tables, cfg, _failed_limits(tables, cfg, lookbacks, variant), lookbacks, max_keys)


def limit_fails_by_pin_type(tables: LineTables, cfg: LineConfig, lookbacks: Lookbacks) -> DataFrame:
    """Units outside a limit, by origin and by the pin pair that was measured."""
    failing = settle(gen.failing_units(_failed_pins(tables, cfg, lookbacks), lookbacks, ["work_element"]),
                     "failing")
    typed = gen.with_pin_type(failing, tables.work_element_names)
    if _colocated(tables):
        built, origins, _ = _in_place(tables, cfg, failing)
        return gen.origin_units_in_place(typed, built, origins, lookbacks, SPREAD, ["pin_type"], cfg.shop)
    built = _links(tables, cfg, failing)
    return gen.origin_units(typed, built, _origins(tables, cfg, built), lookbacks, ["pin_type"], cfg.shop)


def by_origin_and_pin_type(tables: LineTables, cfg: LineConfig, lookbacks: Lookbacks, pin_lookbacks: Lookbacks,
                           scans: Scans | None = None) -> tuple[DataFrame, DataFrame | None]:
    """The list by origin and, if asked for, the one by pin type; they share one pass over every log.

    All failing units are found first; a `list` column tells what they failed by.
    """
    if scans is None:
        scans = Scans(tables, cfg, lookbacks, ORIGIN_LISTS | ({PINS} if pin_lookbacks else set()), pin_lookbacks)
    scans.failures  # before what is read off it
    units, force = together(lambda: settle(scans.failing_units(), "failing"), lambda: settle(scans.failing_rows(), "failing"))
    parents = units.df.select("parent").union(force.df.select("parent"))
    built = _links(tables, cfg, Settled(parents, units.size + force.size))
    origins, spools = scans.children(built)
    met = settle(gen.met_origins(built, origins), "met").df if pin_lookbacks else None  # else read once

    counted = gen.origin_units(units.df.filter(F.col("list") != PINS), built, origins, lookbacks, ["list"], met=met)
    wanted = (F.col("list") == RESULT)
    for name, (_, starts) in scans.variants.items():
        wanted |= (F.col("list") == name) & F.col("lookback").isin(*starts)
    by_force = gen.origin_rows(force.df, gen.around(built, force), origins, spools, list(lookbacks))
    lists = pareto.stack([by_force, counted.filter(wanted).drop("list")])
    if not pin_lookbacks:
        return lists, None
    typed = gen.with_pin_type(Settled(units.df.filter(F.col("list") == PINS), units.size), tables.work_element_names)
    return lists, gen.origin_units(typed, built, origins, pin_lookbacks, ["pin_type"], cfg.shop, met=met)


def by_parameter(tables: LineTables, cfg: LineConfig, lookbacks: Lookbacks, scans: Scans | None = None) -> DataFrame:
    """The combined list of all failures by station and parameter or alarm."""
    scans = scans or Scans(tables, cfg, lookbacks, BY_PARAMETER_LISTS)
    together(lambda: scans.failures, lambda: scans.alarms)
    alarms = [family(tables, cfg, lookbacks, scans) for family in (plate_fails, gripper_fails, weld_fails)]
    return pareto.combined([job_fails(tables, cfg, lookbacks), scans.units(FORCE), *alarms, scans.units(LIMITS)])


def by_station(tables: LineTables, cfg: LineConfig, lookbacks: Lookbacks, unique: bool = True,
               counted: DataFrame | None = None, scans: Scans | None = None) -> DataFrame:
    """The station Pareto, unless `unique` is off with distinct units where they are counted.

    `counted` is the list of `by_parameter` where it is at hand.
    """
    scans = scans or Scans(tables, cfg, lookbacks, BY_PARAMETER_LISTS | ({UNIQUE} if unique else set()))
    if counted is None:
        counted = by_parameter(tables, cfg, lookbacks, scans)
    override = scans.units(UNIQUE, ("station_name",)).withColumnRenamed("fail_count", "n") if unique else None
    return pareto.station_pareto(counted, override)


def by_origin(tables: LineTables, cfg: LineConfig, lookbacks: Lookbacks) -> DataFrame:
    """The three origin lists in one; each lookback with its report's limits."""
    return by_origin_and_pin_type(tables, cfg, lookbacks, {})[0]
