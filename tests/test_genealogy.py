import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from linepareto.operators import genealogy as gen
from linepareto.operators.settle import settle
from linepareto.operators.skew import hot_keys, spread_join, spread_lookup

T0 = datetime(2024, 1, 1)
LOOKBACKS = {"short": T0 + timedelta(hours=80), "long": T0 - timedelta(hours=1)}
PARTS = ("STACK",)


def make(spark, failing, genealogy, children):
    return (spark.createDataFrame(failing, """product_serial string, station_name string,
              recorded_at timestamp_ntz, work_element string"""),
            spark.createDataFrame(genealogy, """product_serial string, scanned_child_serial string,
              scanned_child_part string, shop_name string"""),
            spark.createDataFrame(children, """product_serial string, station_name string,
              parameter_name string, parameter_value_raw string"""))


def run(spark, failing, genealogy, children, max_keys, min_hot_rows, rows):
    origins = gen.child_origins(children, "030", "Nest")
    if rows:
        fails = settle(gen.failing_rows(failing, LOOKBACKS), "failing")
        built = gen.links(genealogy, fails, PARTS, "DU", max_keys)
        spools = gen.wire_spools(children, "030", "batch", "spool-a")
        found = gen.origin_rows(fails.df, built, gen.near(origins, built, max_keys),
                                gen.near(spools, built, max_keys), list(LOOKBACKS), None, min_hot_rows)
    else:
        fails = settle(gen.failing_units(failing, LOOKBACKS), "failing")
        built = gen.links(genealogy, fails, PARTS, "DU", max_keys)
        found = gen.origin_units(fails.df, built, gen.near(origins, built, max_keys), LOOKBACKS,
                                 (), None, min_hot_rows)
    return {(r.lookback, r.station_name, r.origin): r.fail_count for r in found.collect()}


def brute_force(failing, genealogy, children, rows):
    f, g, c = failing.toPandas(), genealogy.toPandas(), children.toPandas()
    nest = c[c.station_name.str.startswith("030") & (c.parameter_name == "Nest")]
    nest = nest[["product_serial", "station_name"]].set_axis(["child", "origin"], axis=1)
    spool = c[c.station_name.str.startswith("030") & c.parameter_name.str.lower().str.contains("batch")
              & c.parameter_value_raw.str.lower().str.contains("spool-a")]
    spool = spool[["product_serial"]].set_axis(["child"], axis=1).assign(spool=1)
    edge = g[g.shop_name == "DU"][["product_serial", "scanned_child_serial"]].set_axis(["parent", "child"], axis=1)
    stack = g[g.scanned_child_part == "STACK"][["product_serial"]].set_axis(["parent"], axis=1).assign(stack=1)
    f = f.rename(columns={"product_serial": "parent"})
    j = nest.merge(edge, on="child").merge(f, on="parent").merge(stack, on="parent").merge(spool, on="child", how="left")
    out = {}
    for name, start in LOOKBACKS.items():
        groups = j[j.recorded_at > start].groupby(["station_name", "origin"]).parent
        for key, n in (groups.size() if rows else groups.nunique()).items():
            out[(name, *key)] = n
    return out


def test_fan_out_counts_rows_or_units(spark):
    data = make(spark, [("P", "040", T0, "w")],
                [("P", "C", "PIN", "DU"), ("P", "S1", "STACK", "DU"), ("P", "S2", "STACK", "DU")],
                [("C", "030-1", "Nest", "1"), ("C", "030-1", "Batch 1", "x SPOOL-A"), ("C", "030-1", "batch 2", "spool-a")])
    assert run(spark, *data, 10, 100, True) == {("long", "040", "030-1"): 4}
    assert run(spark, *data, 10, 100, False) == {("long", "040", "030-1"): 1}


@pytest.fixture(scope="module")
def skewed(spark):
    """One batch child in a third of the edges, one parent with a third, one pair scanned often."""
    rng = random.Random(11)
    parents = [f"P{i}" for i in range(120)]
    kids = [f"C{i}" for i in range(60)]
    edges = []
    for i in range(1200):
        parent = "P0" if i % 3 == 0 else rng.choice(parents)
        child = "C0" if i % 3 == 1 else rng.choice(kids)
        edges.append((parent, child, rng.choice(["PIN", "PIN", "STACK"]), rng.choice(["DU", "DU", "XX"])))
    edges += [("P1", "C1", "PIN", "DU")] * 300 + [(p, None, "PIN", "DU") for p in parents[:5]]
    failing = [(rng.choice(parents[:70]), rng.choice(["040", "050"]), T0 + timedelta(hours=rng.randint(0, 100)),
                f"w{rng.randint(0, 5)}") for _ in range(400)]
    children = [(c, f"030-{rng.randint(1, 3)}", rng.choice(["Nest", "Nest", "Wire Batch 1", "BATCH 2", "other"]),
                 rng.choice(["SPOOL-A 1", "spool-b", "x spool-a"])) for c in kids for _ in range(rng.randint(1, 5))]
    return make(spark, failing, edges, children)


@pytest.mark.parametrize("rows", [True, False])
@pytest.mark.parametrize("max_keys, min_hot_rows", [
    (10_000, 10_000),  # few failing parents, nothing hot: narrowed scans, plain joins
    (10_000, 5),       # narrowed, hot keys spread
    (0, 5),            # many failing parents: shuffled joins, hot keys spread
    (0, 10_000)])
def test_every_way_gives_the_full_join(spark, skewed, rows, max_keys, min_hot_rows):
    expected = brute_force(*skewed, rows)
    assert len(expected) == 12
    assert run(spark, *skewed, max_keys, min_hot_rows, rows) == expected


def test_hot_keys_are_found_and_spread(spark, skewed):
    edges = skewed[1].select(F.col("product_serial").alias("parent"), F.col("scanned_child_serial").alias("child"))
    hot = {r.child for r in hot_keys(edges, "child", min_rows=100).collect()}
    assert hot == {"C0", "C1"}
    weights = edges.select("child").distinct().na.drop().withColumn("w", F.length("child"))
    joined = spread_join(edges, weights, "child", ["parent"], hot_keys(edges, "child", 100))
    assert sorted(joined.collect()) == sorted(edges.join(weights, "child").select(*joined.columns).collect())


def test_spread_lookup_equals_join(spark, skewed, plan):
    failing = skewed[0]
    names = spark.createDataFrame([(f"w{i}", f"n{i}") for i in range(4)], "element string, name string")
    found = spread_lookup(failing, names, {"work_element": "element"}, ["product_serial", "recorded_at"])
    wanted = failing.join(names, failing.work_element == names.element)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))


def test_few_failing_parents_filter_the_scan_without_shuffling_it(spark, tmp_path, plan):
    from linepareto.operators.settle import narrow

    path = str(tmp_path / "genealogy")
    spark.range(1000).selectExpr("cast(id as string) AS parent", "cast(id % 7 as string) AS child").write.parquet(path)
    keys = settle(spark.createDataFrame([("1",), ("2",), ("2",)], "parent string"), "keys")
    assert keys.size == keys.df.count() == 3
    narrowed = narrow(spark.read.parquet(path), "parent", keys.df)
    assert narrowed.count() == 2
    text = plan(narrowed)
    big_side = text.split("BroadcastExchange")[0]
    assert "BroadcastHashJoin LeftSemi" in text and "Exchange hashpartitioning" not in big_side


@pytest.mark.parametrize("min_hot_rows", [1, 10_000])
def test_pin_types_drop_units_without_a_name(spark, skewed, min_hot_rows):
    names = spark.createDataFrame([("w1", "U1-L2 xx & V3-L4 yy"), ("w2", None)], "work_element string, pin_pair string")
    failing = settle(gen.failing_units(skewed[0], LOOKBACKS, ["work_element"]), "failing")
    typed = gen.with_pin_type(failing, names, min_hot_rows)
    by_type = {r.pin_type: r["count"] for r in typed.groupBy("pin_type").count().collect()}
    pairs = skewed[0].toPandas().drop_duplicates(["product_serial", "station_name", "work_element"]).work_element
    assert by_type == {"U1-L2 & V3-L4": (pairs == "w1").sum(), None: (pairs == "w2").sum()}


def test_many_failing_parents_thin_the_scan_without_shuffling_it(spark, tmp_path, plan):
    from linepareto.operators.settle import thin

    path = str(tmp_path / "genealogy")
    spark.range(40_000).selectExpr("cast(id as string) AS parent", "cast(id % 7 as string) AS child").write.parquet(path)
    keys = settle(spark.range(0, 4000, 2).selectExpr("cast(id as string) AS parent"), "keys")
    thinned = thin(spark.read.parquet(path), "parent", keys.df, keys.size)
    found = {r.parent for r in thinned.collect()}
    assert {r.parent for r in keys.df.collect()} <= found and len(found) < 2000 + 0.1 * 40_000
    text = plan(thinned)
    assert "BroadcastHashJoin LeftSemi" in text and "Exchange hashpartitioning" not in text.split("BroadcastExchange")[0].split("HashAggregate")[0]
    assert thin(spark.read.parquet(path), "parent", keys.df.filter("false"), 0).isEmpty()


def test_no_way_shuffles_the_whole_genealogy(spark, tmp_path, monkeypatch, plan):
    """What is settled of the genealogy is a filtered scan, for few parents and for many."""
    path = str(tmp_path / "genealogy")
    spark.range(1000).selectExpr("cast(id as string) AS product_serial", "cast(id % 7 as string) AS scanned_child_serial",
                                 "'STACK' AS scanned_child_part", "'DU' AS shop_name").write.parquet(path)
    parents = settle(spark.createDataFrame([("1",), ("2",)], "parent string"), "parents")
    plans = []
    monkeypatch.setattr(gen, "settle", lambda df, purpose: plans.append(plan(df)) or settle(df, purpose))
    for max_keys in (10, 0):
        assert 2 <= gen.links(spark.read.parquet(path), parents, PARTS, "DU", max_keys).size < 100
    assert len(plans) == 2
    for text in plans:
        assert "BroadcastHashJoin LeftSemi" in text and "SortMergeJoin" not in text and "ShuffledHashJoin" not in text


def test_a_parent_meets_its_origins_once(spark, monkeypatch):
    """Whatever number of children they came with, and for all lists of a report."""
    from linepareto.plans import driver_line as d
    from linepareto.plans.report import line_report

    edges = spark.createDataFrame([("p", f"c{k % 50}") for k in range(200)] + [("q", "c1"), ("q", None), (None, "c2")],
                                  "parent string, child string")
    origins = spark.createDataFrame([(f"c{k}", f"030-{k % 2}") for k in range(50)] * 3, "child string, origin string")
    for min_hot_rows in (20, 10_000):
        met = gen.met_origins(gen.Links(edges, edges, 203), origins, min_hot_rows).filter("parent IS NOT NULL")
        assert sorted(map(tuple, met.collect())) == [("p", "030-0"), ("p", "030-1"), ("q", "030-1")]

    calls, plain = [], gen.met_origins
    monkeypatch.setattr(gen, "met_origins", lambda *a: calls.append(a) or plain(*a))
    assert line_report(d.tables(spark, "/root/testdata/sf0.001"), d.LINE, d.AS_OF).count() > 0 and len(calls) == 1
