"""Failures traced through parent/child genealogy to where a child part came from.

All reports share one chain: failing parents, kept if a stack part was built into them, joined
with their children and those with the children's records. Failing parents are few against the
history of the genealogy, so the big scans are filtered by them in place, without a shuffle: few
parents by their set, many by a Bloom filter of it, and only what passes is shuffled. Each input
is reduced to one row per key before it is joined, carrying its multiplicity where rows are
counted; hot parents and hot children (a batch shared by many units) are spread over several
tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from linepareto.functions.text import icontains, short_pair_name
from linepareto.functions.times import after
from linepareto.operators.skew import HOT_ROWS, hot_keys, spread_join
from linepareto.operators.settle import MAX_BROADCAST_KEYS, Settled, narrow, settle, thin
from linepareto.operators.units import scope, tall


def child_origins(records: DataFrame, station_prefix: str, parameter: str, *more: str) -> DataFrame:
    """`(child, origin)` of the child parts' records, with the columns `more`."""
    return (records.filter(F.col("station_name").like(f"{station_prefix}%")
                           & (F.col("parameter_name") == parameter))
            .select(F.col("product_serial").alias("child"), F.col("station_name").alias("origin"), *more))


def _holds_spool(parameter: str, value: str) -> Column:
    return icontains(F.col("parameter_name"), parameter) & icontains(F.col("parameter_value_raw"), value)


def wire_spools(records: DataFrame, station_prefix: str, parameter: str, value: str, *more: str) -> DataFrame:
    """Children with a record of the given spool, with the columns `more`."""
    return (records.filter(F.col("station_name").like(f"{station_prefix}%") & _holds_spool(parameter, value))
            .select(F.col("product_serial").alias("child"), *more))


def child_parts(records: DataFrame, station_prefix: str, parameter: str, spool_parameter: str, spool_value: str) -> DataFrame:
    """Both in one scan: `(child, origin, has_origin, has_spool)`."""
    origin = F.coalesce(F.col("parameter_name") == parameter, F.lit(False))
    spool = F.coalesce(_holds_spool(spool_parameter, spool_value), F.lit(False))
    return records.filter(F.col("station_name").like(f"{station_prefix}%") & (origin | spool)).select(
        F.col("product_serial").alias("child"), F.col("station_name").alias("origin"), origin.alias("has_origin"),
        spool.alias("has_spool"))


def failing_units(failing: DataFrame, lookbacks: Mapping[str, datetime],
                  extra: Sequence[str] = ()) -> DataFrame:
    """Newest failure per parent, station and `extra` column: `(parent, station_name, …, newest)`."""
    recent = failing.filter(after(F.col("recorded_at"), min(lookbacks.values())))
    return (recent.groupBy(F.col("product_serial").alias("parent"), "station_name", *extra)
            .agg(F.max("recorded_at").alias("newest")))


def failing_rows(failing: DataFrame, lookbacks: Mapping[str, datetime]) -> DataFrame:
    """Failing records per parent and station, one column per lookback."""
    recent = failing.filter(after(F.col("recorded_at"), min(lookbacks.values())))
    return (recent.groupBy(F.col("product_serial").alias("parent"), "station_name")
            .agg(*[F.count_if(after(F.col("recorded_at"), start)).alias(name)
                   for name, start in lookbacks.items()]))


class Links(NamedTuple):
    """Genealogy around failing parents."""

    edges: DataFrame  # (parent, child), once per scan
    stacks: DataFrame  # (parent, shop_name) a stack part was built into, once per scan
    size: int  # number of genealogy rows


def links(genealogy: DataFrame, parents: Settled, parts: Sequence[str], shop: str | None = None,
          max_keys: int = MAX_BROADCAST_KEYS) -> Links:
    """Edges (of one shop, if given) and stack scans of the failing `parents`, read in one pass.

    The genealogy is filtered where it is read and settled: the joins after this read it several
    times. Of more than `max_keys` parents a few others' rows are kept as well; the joins drop them.
    """
    rows = genealogy.select(F.col("product_serial").alias("parent"),
                            F.col("scanned_child_serial").alias("child"), "shop_name",
                            F.col("scanned_child_part").isin(*parts).alias("_stack"))
    rows, size = settle(_filtered(rows, "parent", parents, max_keys), "genealogy")
    return Links(scope(rows, shop_name=shop).select("parent", "child"),
                 rows.filter("_stack").select("parent", "shop_name"), size)


def _filtered(big: DataFrame, key: str, keys: Settled, max_keys: int) -> DataFrame:
    return narrow(big, key, keys.df) if keys.size <= max_keys else thin(big, key, keys.df, keys.size)


def around(built: Links, parents: Settled, max_keys: int = MAX_BROADCAST_KEYS) -> Links:
    """`built` with the edges of some of its parents; of more than `max_keys` a few others' as well."""
    return built._replace(edges=_filtered(built.edges, "parent", parents, max_keys))


def near(records: DataFrame, built: Links, max_keys: int = MAX_BROADCAST_KEYS) -> DataFrame:
    """Records of the children in `built`; of more than `max_keys` a few others as well."""
    return _filtered(records, "child", Settled(built.edges, built.size), max_keys)


def _chain(failing: DataFrame, edges: DataFrame, seeds: DataFrame, built: Links,
           min_hot_rows: int) -> DataFrame:
    if built.size < min_hot_rows:  # no key can be hot
        return edges.join(failing, "parent").join(seeds, "child")
    hot_parents = hot_keys(built.edges, "parent", min_hot_rows)
    hot_children = hot_keys(built.edges, "child", min_hot_rows)
    traced = spread_join(edges, failing, "parent", ["child"], hot_parents)
    return spread_join(traced, seeds, "child", ["parent"], hot_children)


def met_origins(built: Links, origins: DataFrame, min_hot_rows: int = HOT_ROWS) -> DataFrame:
    """`(parent, origin)` of the parents in `built` and where their children came from, each once."""
    seeds = origins.distinct()
    if built.size < min_hot_rows:  # no child can be hot
        met = built.edges.join(seeds, "child")
    else:
        met = spread_join(built.edges, seeds, "child", ["parent"], hot_keys(built.edges, "child", min_hot_rows))
    return met.select("parent", "origin").distinct()


def origin_units(failing: DataFrame, built: Links, origins: DataFrame, lookbacks: Mapping[str, datetime],
                 extra: Sequence[str] = (), stack_shop: str | None = None,
                 min_hot_rows: int = HOT_ROWS, met: DataFrame | None = None) -> DataFrame:
    """Distinct failing parents per (lookback, station, origin and `extra` columns).

    `failing` is from `failing_units`. Spools do not appear: an outer join cannot change a
    distinct count. Lists that share the genealogy share `met_origins` as well: a parent meets its
    origins, not each of its children, so no parent can be hot.
    """
    groups = ["station_name", "origin", *extra]
    met = met_origins(built, origins, min_hot_rows) if met is None else met
    stacks = scope(built.stacks, shop_name=stack_shop).select("parent").distinct()
    stacked = failing.join(stacks, "parent", "left_semi")
    if extra:  # several failing units may have got the same one
        stacked = stacked.groupBy("parent", "station_name", *extra).agg(F.max("newest").alias("newest"))
    wide = stacked.join(met, "parent").groupBy(*groups).agg(
        *[F.count_if(after(F.col("newest"), start)).alias(name) for name, start in lookbacks.items()])
    return tall(wide, list(lookbacks), groups)


def origin_rows(failing: DataFrame, built: Links, origins: DataFrame, spools: DataFrame,
                lookbacks: Sequence[str], stack_shop: str | None = None,
                min_hot_rows: int = HOT_ROWS) -> DataFrame:
    """Joined rows per (lookback, station, origin): every combination of edge, failing record,
    stack scan, child record and spool record counts.

    `failing` is from `failing_rows`. The combinations are not built: each input is counted per
    key and the counts multiplied.
    """
    stacks = (scope(built.stacks, shop_name=stack_shop).groupBy("parent")
              .agg(F.count("*").alias("_stacks")))
    edges = built.edges.groupBy("parent", "child").agg(F.count("*").alias("_links"))
    per_spool = spools.groupBy("child").agg(F.count("*").alias("_spools"))
    seeds = (origins.groupBy("child", "origin").agg(F.count("*").alias("_records"))
             .join(per_spool, "child", "left")
             .select("child", "origin",
                     (F.col("_records") * F.coalesce("_spools", F.lit(1))).alias("_weight")))
    traced = _chain(failing.join(stacks, "parent"), edges, seeds, built, min_hot_rows)
    fan_out = F.col("_links") * F.col("_stacks") * F.col("_weight")
    wide = traced.groupBy("station_name", "origin").agg(
        *[F.sum(F.col(name) * fan_out).alias(name) for name in lookbacks])
    return tall(wide, list(lookbacks), ["station_name", "origin"])


def in_place(genealogy: DataFrame, parents: Settled, parts: Sequence[str], spread: str, shop: str | None = None,
             max_keys: int = MAX_BROADCAST_KEYS) -> Links:
    """As `links`, for a genealogy bucketed by child and `spread`: not settled, so that it stays in its buckets.

    `edges` has `spread` beside the child. The genealogy is read once for the edges and once, two columns of it,
    for the stacks.
    """
    rows = genealogy.select(F.col("product_serial").alias("parent"), F.col("scanned_child_serial").alias("child"),
                            "shop_name", spread, F.col("scanned_child_part").isin(*parts).alias("_stack"))
    rows = _filtered(rows, "parent", parents, max_keys)
    return Links(scope(rows, shop_name=shop).filter("child IS NOT NULL").select("parent", "child", spread),
                 rows.filter("_stack").select("parent", "shop_name"), 0)


def origin_units_in_place(failing: DataFrame, built: Links, origins: DataFrame, lookbacks: Mapping[str, datetime],
                          spread: str, extra: Sequence[str] = (), stack_shop: str | None = None) -> DataFrame:
    """As `origin_units`, for links from `in_place` and origins with `spread` in the same buckets.

    Edges meet origins in their bucket, without a shuffle; what is shuffled after that has one row
    per parent and origin, so no parent can be hot.
    """
    groups = ["station_name", "origin", *extra]
    met = built.edges.distinct().join(origins.distinct(), ["child", spread]).select("parent", "origin").distinct()
    stacks = scope(built.stacks, shop_name=stack_shop).select("parent").distinct()
    stacked = failing.join(stacks, "parent", "left_semi")
    if extra:  # several failing units may have got the same one
        stacked = stacked.groupBy("parent", "station_name", *extra).agg(F.max("newest").alias("newest"))
    wide = stacked.join(met, "parent").groupBy(*groups).agg(
        *[F.count_if(after(F.col("newest"), start)).alias(name) for name, start in lookbacks.items()])
    return tall(wide, list(lookbacks), groups)


def origin_rows_in_place(failing: DataFrame, built: Links, origins: DataFrame, spools: DataFrame,
                         lookbacks: Sequence[str], spread: str) -> DataFrame:
    """As `origin_rows`, for links from `in_place`, origins and spools with `spread` in the same buckets."""
    key = ["child", spread]
    edges = built.edges.groupBy("parent", *key).agg(F.count("*").alias("_links"))
    per_spool = spools.groupBy(*key).agg(F.count("*").alias("_spools"))
    seeds = origins.groupBy(*key, "origin").agg(F.count("*").alias("_records")).join(per_spool, key, "left")
    weight = F.col("_links") * F.col("_records") * F.coalesce("_spools", F.lit(1))
    met = edges.join(seeds, key).groupBy("parent", "origin").agg(F.sum(weight).alias("_weight"))
    stacks = built.stacks.groupBy("parent").agg(F.count("*").alias("_stacks"))
    fan_out = F.col("_stacks") * F.col("_weight")
    wide = failing.join(stacks, "parent").join(met, "parent").groupBy("station_name", "origin").agg(
        *[F.sum(F.col(name) * fan_out).alias(name) for name in lookbacks])
    return tall(wide, list(lookbacks), ["station_name", "origin"])


def with_pin_type(failing: Settled, names: DataFrame, min_hot_rows: int = HOT_ROWS) -> DataFrame:
    """Replace the work element of `failing_units` by its short pin-pair name.

    Units whose element has no name drop.
    """
    named = names.select("work_element", short_pair_name(F.col("pin_pair")).alias("pin_type"))
    if failing.size < min_hot_rows:  # no work element can be hot
        typed = failing.df.join(named, "work_element")
    else:
        hot = hot_keys(failing.df, "work_element", min_hot_rows)
        typed = spread_join(failing.df, named, "work_element", ["parent", "station_name"], hot)
    return typed.drop("work_element")
