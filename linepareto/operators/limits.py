"""Limit violations: measurement records against a table of limits.

A limit names a station, a parameter (exactly or by pattern), optionally a work location,
and an inclusive pass band, open on a side without a bound. A record violates if any limit that
applies to it is exceeded; so limits of one scope are one *band*, from the largest lower to the smallest
upper bound. Whether a record violates is a condition, never a join that adds or drops rows, so
several lists of limits can be told apart in one scan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from linepareto import schemas
from linepareto.operators.settle import settle
from linepareto.operators.skew import HOT_ROWS, hot_keys, spread_join
from linepareto.sources.layout import NUMBER

# Bands up to this number are broadcast; more are joined by shuffle.
MAX_LOCAL_LIMITS = 10_000
# Stations up to this number are told apart in the condition a scan prunes on.
MAX_STATIONS = 30
# Bands with a pattern up to this number are written into the predicate; more are resolved to names first.
MAX_PATTERNS = 200


class Limit(NamedTuple):
    station_name: str
    match_mode: str  # 'eq' or 'ilike'
    pattern: str
    work_location_id: int | None  # None or 0: any location
    lo: float | None  # None: no bound on this side
    hi: float | None
    variant: str | None = None


def for_variant(limits: Sequence[Limit], variant: str | None = None) -> tuple[Limit, ...]:
    """The base limits, those of `variant` in place of the ones they redefine, as base limits."""
    def scope(limit):
        return (*limit[:3], limit.work_location_id or None)

    special = [x for x in limits if x.variant is not None and x.variant == variant]
    replaced = {scope(x) for x in special}
    return tuple([x for x in limits if x.variant is None and scope(x) not in replaced]
                 + [x._replace(variant=None) for x in special])


class LimitCheck(NamedTuple):
    """Limits with how they are applied."""

    limits: tuple[Limit, ...]
    value: str = "raw"  # the text ('raw') or the numeric ('num') column
    status: str | None = None  # overall status a record needs; None: any
    location: str = "id"  # a limit's work location against the record's 'id' or two-digit 'name'


class Band(NamedTuple):
    """All limits of one scope as one."""

    station_name: str
    match_mode: str
    pattern: str
    work_location_id: int | None
    value: str
    status: str | None
    location: str
    lo: float | None
    hi: float | None


_SCOPE = ("station_name", "match_mode", "pattern", "work_location_id")
_CHECK = ("value", "status", "location")
_COLUMNS = tuple(f"_{name}" for name in Band._fields)
_TESTED = ("_work_location_id", "_value", "_status", "_location", "_lo", "_hi")  # what is left once the names match
BANDS = """_station_name string, _match_mode string, _pattern string, _work_location_id int, _value string, _status string,
 _location string, _lo double, _hi double"""


def collapsed(checks: Sequence[LimitCheck]) -> list[Band]:
    """The limits as bands; work location 0 is any, as null is."""
    sides: dict[tuple, tuple[list, list]] = {}
    for check in checks:
        for x in check.limits:
            place = x.work_location_id or None
            scope = (x.station_name, x.match_mode, x.pattern, place, check.value, check.status,
                     check.location if place else "id")
            low, high = sides.setdefault(scope, ([], []))
            low += [] if x.lo is None else [float(x.lo)]
            high += [] if x.hi is None else [float(x.hi)]
    return [Band(*scope, max(low, default=None), min(high, default=None)) for scope, (low, high) in sides.items()]


def _float(bound: float | None) -> float | None:
    return None if bound is None else float(bound)


def bands_frame(spark: SparkSession, bands: Sequence[Band]) -> DataFrame:
    """Local bands as a relation."""
    return spark.createDataFrame([tuple(band) for band in bands], BANDS)


def table_bands(limits: DataFrame, check: LimitCheck, variant: str | None = None) -> DataFrame:
    """The bands of a limits table: base rows, those that `variant` redefines replaced."""
    own = limits.select(*schemas.LIMITS.names).withColumn("work_location_id", F.nullif("work_location_id", F.lit(0)))
    chosen = own.filter("variant IS NULL")
    if variant is not None:
        special = own.filter(F.col("variant") == variant)
        scopes = special.select(*[F.col(c).alias(f"_{c}") for c in _SCOPE]).distinct()
        same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in _SCOPE])
        chosen = chosen.join(scopes, same, "left_anti").union(special)
    sides = chosen.groupBy(*_SCOPE).agg(F.max("lo").alias("_lo"), F.min("hi").alias("_hi"))
    return sides.select(*[F.col(c).alias(f"_{c}") for c in _SCOPE],
                        *[F.lit(getattr(check, c)).alias(f"_{c}") for c in _CHECK], "_lo", "_hi")


def might_violate(bands: Sequence[Band], loose: bool = False, raw: str | None = None) -> Column:
    """A necessary condition in plain comparisons, for the scan to prune on; `raw` is a column with the text as a number."""
    def one(value: str, status: str | None) -> Column:
        own = [x for x in bands if (x.value, x.status) == (value, status)]
        stations = sorted({x.station_name for x in own})
        possible = _any(_at_station(s, True) for s in stations) if loose else F.col("station_name").isin(stations)
        if status is not None:
            possible &= F.col("overall_process_status") == status
        if all(x.match_mode == "eq" for x in own):
            possible &= F.col("parameter_name").isin(sorted({x.pattern for x in own}))
        elif loose:
            possible &= _any(_named(own))
        if not loose and 1 < len(stations) <= MAX_STATIONS:
            possible &= _any(_at_station(s, False) & _any(_named([x for x in own if x.station_name == s])) for s in stations)
        number = "parameter_value_num" if value == "num" else raw
        if number is not None:
            number = F.col(number)
            low, high = [x.lo for x in own if x.lo is not None], [x.hi for x in own if x.hi is not None]
            possible &= _any([number < max(low)] * bool(low) + [number > min(high)] * bool(high))
        return possible

    return _any(one(*kind) for kind in sorted({(x.value, x.status) for x in bands}, key=repr))


def _named(bands: Sequence[Band]) -> list[Column]:
    exact, patterns = ({x.pattern for x in bands if (x.match_mode == "eq") == same} for same in (True, False))
    return [F.col("parameter_name").isin(sorted(exact))] * bool(exact) + [F.col("parameter_name").ilike(x) for x in sorted(patterns)]


def _any(conditions) -> Column:
    conditions = list(conditions)
    return reduce(lambda a, b: a | b, conditions) if conditions else F.lit(False)


def _at_station(name: str, loose: bool) -> Column:
    if loose:
        return F.contains(F.lower("station_name"), F.lit(name.lower()))
    return F.col("station_name") == name


def _located(location: str, limit_location: Column, record: Callable[[str], Column] = F.col) -> Column:
    if location == "id":
        return record("work_location_id") == limit_location
    return record("work_location_name") == F.lpad(limit_location.cast("string"), 2, "0")


def _predicate(bands: Sequence[Band], loose: bool) -> Column:
    """Bands as one predicate: constant patterns are compiled once, and a value is read only where one matches."""
    violated = []
    for band in bands:
        value = F.col("_measured" if band.value == "raw" else "parameter_value_num")
        name = F.col("parameter_name")
        applies = _at_station(band.station_name, loose) & (
            name == band.pattern if band.match_mode == "eq" else name.ilike(band.pattern))
        if band.work_location_id:
            applies &= _located(band.location, F.lit(band.work_location_id))
        if band.status is not None:
            applies &= F.col("overall_process_status") == band.status
        sides = [value < band.lo] * (band.lo is not None) + [value > band.hi] * (band.hi is not None)
        violated.append(applies & _any(sides))
    return F.coalesce(_any(violated), F.lit(False))


def _exceeded(record: Callable[[str], Column], band: Callable[[str], Column], values: set[str], locations: set[str]) -> Column:
    """Is a record outside a band whose names match? `values` and `locations` are the kinds in use."""
    def outside(column: str) -> Column:
        below, above = record(column) < band("_lo"), record(column) > band("_hi")
        return F.coalesce(below, F.lit(False)) | F.coalesce(above, F.lit(False))

    columns = {"raw": "_measured", "num": "parameter_value_num"}
    number = _choose({kind: outside(columns[kind]) for kind in values}, band("_value"))
    here = _choose({kind: _located(kind, band("_work_location_id"), record) for kind in locations}, band("_location"))
    return (number & (band("_work_location_id").isNull() | F.coalesce(here, F.lit(False)))
            & (band("_status").isNull() | F.coalesce(record("overall_process_status") == band("_status"), F.lit(False))))


def _choose(options: dict[str, Column], chosen: Column) -> Column:
    """The option `chosen` names; a plain one if there is only one."""
    (first, one), *rest = options.items()
    return F.when(chosen == first, one).otherwise(rest[0][1]) if rest else one


def _resolved(names: DataFrame, bands: DataFrame, loose: bool) -> DataFrame:
    """Bands by exact station and parameter: every band once for each pair of `names` that it applies to.

    The log's distinct names are few against it; a pattern is tested once per pair, not per record.
    """
    exact, patterns = bands.filter("_match_mode = 'eq'"), bands.filter("_match_mode <> 'eq'")
    named = F.like(F.lower("parameter_name"), F.lower("_pattern"))
    pairs = names.select("station_name", "parameter_name")
    if not loose:
        found = pairs.join(patterns, (F.col("station_name") == F.col("_station_name")) & named)
        return found.select("station_name", "parameter_name", *_TESTED).union(exact.select("_station_name", "_pattern", *_TESTED))
    # stations' names within each other: a nested loop over distinct names of stations, few on both sides
    near = pairs.select("station_name").distinct().join(
        bands.select("_station_name").distinct(), F.contains(F.lower("station_name"), F.lower("_station_name")))
    by_pattern = patterns.join(near, "_station_name").join(pairs, "station_name").filter(named)
    return by_pattern.select("station_name", "parameter_name", *_TESTED).union(
        exact.join(near, "_station_name").select("station_name", "_pattern", *_TESTED))


def _spread(records: DataFrame, bands: DataFrame, values: set[str], locations: set[str]) -> DataFrame:
    """Records outside a band of their exact station and parameter, joined by shuffle.

    A pair with a large share of the log is spread over several tasks; its bands are one row.
    """
    def pair(station: str, parameter: str) -> Column:
        return F.concat(F.col(station), F.lit("\0"), F.col(parameter)).alias("_pair")

    station, name, *_ = bands.columns
    by_pair = bands.select(pair(station, name), *_TESTED).groupBy("_pair").agg(F.collect_list(F.struct(*_TESTED)).alias("_bands"))
    marked = records.select("*", pair("station_name", "parameter_name"))
    hot = settle(hot_keys(marked, "_pair", HOT_ROWS), "hot-pairs")
    if hot.size:
        joined = spread_join(marked, by_pair, "_pair", ["product_serial", "recorded_at"], hot.df)
    else:
        joined = marked.join(by_pair, "_pair")
    outside = F.exists("_bands", lambda band: _exceeded(F.col, band.getField, values, locations))
    return joined.filter(outside).drop("_pair", "_bands", "_measured")


def violation(records: DataFrame, checks: Sequence[LimitCheck] | Sequence[Band], loose: bool = False) -> Column | None:
    """Whether a record of `measured(records)` is outside a band that applies to it; never null.

    None where there are more bands than can be tested in place. Bands are broadcast, their number being
    known, and looked up by station and parameter (with `loose` stations by parameter alone); those
    with a pattern are a predicate beside it.
    """
    bands = _bands_of(checks)
    exact = [band for band in bands if band.match_mode == "eq"]
    patterns = [band for band in bands if band.match_mode != "eq"]
    if len(exact) > MAX_LOCAL_LIMITS or len(patterns) > MAX_PATTERNS:
        return None
    if not exact:
        return _predicate(patterns, loose)
    found = _broadcast_bands(records, exact).where(_meets(lambda column: F.col(column).outer(), exact, loose)).exists()
    return found | _predicate(patterns, loose) if patterns else found


def _broadcast_bands(records: DataFrame, exact: Sequence[Band]) -> DataFrame:
    return F.broadcast(bands_frame(records.sparkSession, exact))


def _meets(record: Callable[[str], Column], exact: Sequence[Band], loose: bool) -> Column:
    """Is a record outside the band beside it, which names its parameter and station?"""
    station = record("station_name")
    here = F.contains(F.lower(station), F.lower("_station_name")) if loose else station == F.col("_station_name")
    return here & (record("parameter_name") == F.col("_pattern")) & _exceeded(
        record, F.col, {band.value for band in exact}, {band.location for band in exact})


def _bands_of(checks: Sequence[LimitCheck] | Sequence[Band]) -> list[Band]:
    return list(checks) if all(isinstance(x, Band) for x in checks) else collapsed(checks)


def measured(records: DataFrame) -> DataFrame:
    """Records with the text value as a number in `_measured`; null where it is none."""
    number = F.col(NUMBER) if NUMBER in records.columns else F.col("parameter_value_raw").try_cast("double")
    return records.withColumn("_measured", number)


def _outside(records: DataFrame, bands: list[Band], loose: bool) -> DataFrame:
    """Records outside one of these bands."""
    if not bands:
        return records.filter(F.lit(False))
    if len(bands) <= MAX_LOCAL_LIMITS:
        records = records.filter(might_violate(bands, loose, NUMBER if NUMBER in records.columns else None))
    values, locations = {band.value for band in bands}, {band.location for band in bands}
    tested = measured(records) if "raw" in values else records
    if len(bands) <= MAX_LOCAL_LIMITS and all(band.match_mode == "eq" for band in bands):
        return tested.join(_broadcast_bands(records, bands), _meets(F.col, bands, loose), "left_semi").drop("_measured")
    condition = violation(records, bands, loose)
    if condition is not None:
        return tested.filter(condition).drop("_measured")
    if records.isStreaming:
        raise ValueError(f"a stream takes up to {MAX_LOCAL_LIMITS} limits and {MAX_PATTERNS} patterns, not {len(bands)}")
    frame = bands_frame(records.sparkSession, bands)
    return _spread(tested, _resolved(_names(records, bands, loose), frame, loose), values, locations)


def _names(records: DataFrame, bands: Sequence[Band] | None, loose: bool) -> DataFrame:
    """The distinct stations and parameters of the log, settled; none where no band needs them."""
    pairs = records.select("station_name", "parameter_name")
    if bands is not None and not loose and all(band.match_mode == "eq" for band in bands):
        return pairs.filter(F.lit(False))
    return settle(pairs.distinct(), "names").df


def check_violations(records: DataFrame, checks: Sequence[LimitCheck], loose_stations: bool = False) -> DataFrame:
    """Records outside a limit that applies to them, for several checks in one scan.

    The text value counts where it is a number and is never a violation elsewhere. With
    `loose_stations` a limit applies to all stations with its own in their name. Up to MAX_LOCAL_LIMITS bands
    the log is not shuffled; more (batch only) are joined by shuffle, patterns resolved to the log's names.
    """
    return _outside(records, collapsed(checks), loose_stations)


def _broadcasts(spark: SparkSession) -> bool:
    return not spark.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-")


def limit_violations(records: DataFrame, limits: Sequence[Limit] | DataFrame, value: str = "raw",
                     status: str | None = None, location: str = "id", variant: str | None = None,
                     loose_stations: bool = False) -> DataFrame:
    """Records outside a limit that applies to them: the base limits, or those of `variant` in their place.

    The bands of a limits table are counted first: few are taken as local ones are, unless the session has
    broadcasts switched off; more (batch only) are joined by shuffle.
    """
    check = LimitCheck((), value, status, location)
    if not isinstance(limits, DataFrame):
        return check_violations(records, [check._replace(limits=for_variant(limits, variant))], loose_stations)
    bands = table_bands(limits, check, variant)
    if _broadcasts(records.sparkSession):
        few = bands.limit(MAX_LOCAL_LIMITS + 1).collect()  # no more than that many rows
        if len(few) <= MAX_LOCAL_LIMITS:
            return _outside(records, [Band(*row) for row in few], loose_stations)
    if status is not None:
        records = records.filter(F.col("overall_process_status") == status)
    pairs = _resolved(_names(records, None, loose_stations), bands, loose_stations)
    return _spread(measured(records), pairs, {value}, {location})


def status_fails(records: DataFrame, station: str, parameter: str, parameter_id: int,
                 status: str) -> DataFrame:
    """Records of one parameter that failed by status, whatever their value."""
    return records.filter(
        (F.col("station_name") == station) & (F.col("parameter_name") == parameter)
        & (F.col("parameter_id") == parameter_id) & (F.col("overall_process_status") == status))
