"""Nearest neighbours: recall, exact scores and order against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from linepareto.llm import hash_forest

SCHEMA = "vec_id long, embedding array<float>, label int, x int, code string"


def brute(rows, every, k):
    out = {}
    for q, v in rows:
        if q % every == 0:
            best = sorted((-float(np.dot(np.float64(v), np.float64(w))), i) for i, w in rows if i != q)[:k]
            out[q] = [(i, -s) for s, i in best]
    return out


def got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall_on_random_vectors(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(6000, 64)) * rng.uniform(0.5, 2, size=(6000, 1))
    rows = [(i, v) for i, v in enumerate(x.astype(np.float32).tolist())]
    df = spark.createDataFrame([(i, v, 0, 1, "a") for i, v in rows], SCHEMA)
    vectors = hash_forest.valid(df)
    found = got(hash_forest.nearest(vectors, vectors.filter("vec_id % 100 = 0"), candidates=2000, shard=4000))
    right = brute(rows, 100, 20)
    assert set(found) == set(right) and all(len(v) == 20 for v in found.values())
    hits = [len({i for i, _ in found[q]} & {i for i, _ in right[q]}) for q in right]
    assert np.mean(hits) >= 0.9 * 20
    for q, near in found.items():
        for i, s in near:
            assert s == pytest.approx(float(np.dot(np.float64(rows[q][1]), np.float64(rows[i][1]))), abs=1e-12)


def test_recall_of_the_registered_parameters(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    found, right = got(hash_forest.every_nth(df)), brute(rows, 20, 20)
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in right[q]}) for q in right)
    assert set(found) == set(right) and hits >= 0.9 * sum(map(len, right.values()))


def test_ties_copies_and_odd_rows(spark):
    one = [1.0, 2.0, 3.0]
    rows = [(i, one) for i in range(60)] + [(100 + i, [0.5, float(i % 3), -1.0]) for i in range(30)]
    odd = [(200, None), (220, [0.0, 0.0, 0.0]), (240, [1.0, None, 2.0]), (260, [float("nan"), 1.0, 1.0]),
           (280, [float("inf"), 1.0, 1.0]), (300, [1.0, 2.0]), (None, one), (320, [])]
    df = spark.createDataFrame([(i, v, 0, 1, "a") for i, v in rows + odd], SCHEMA)
    assert got(hash_forest.every_nth(df)) == brute(rows, 20, 20)
    few = df.filter("vec_id < 4")
    assert {q: [i for i, _ in v] for q, v in got(hash_forest.every_nth(few)).items()} == {0: [1, 2, 3]}


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert hash_forest.every_nth(df).collect() == []
    assert hash_forest.every_nth(df.withColumn("vec_id", F.lit(0).cast("long"))).collect() == []
