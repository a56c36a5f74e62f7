"""Approximate nearest neighbours by a forest of hash prefixes.

Equal vectors are one class. Classes are dealt evenly to shards; a shard keeps, per tree, a sorted array
of 64-bit strings of random hyperplane signs. A query descends in every tree to its longest matching
prefix, then all trees ascend together, one bit at a time, until `candidates` distinct classes of the
shard share a prefix that long with it in some tree. Those are scored exactly.

Every row is indexed. Prefixes give angles, so vectors get one more component that makes all norms
equal and turns the largest inner product into the smallest angle; the queries' is 0.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from linepareto.llm.common import stored

NEAREST = 20
TREES = 32
BITS = 64
SHARD = 8192
# Distinct candidates per shard. On vectors without any structure (the 20th neighbour at cosine 0.35 in
# 64 dimensions) nine tenths of the true neighbours are only found among half of all rows.
CANDIDATES = 4000
QUERIES_TOGETHER = 20_000
EVERY = 20


def valid(rows: DataFrame) -> DataFrame:
    """(vec_id, embedding) of rows that take part: finite, not zero, of the table's most frequent length."""
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    ok = rows.filter(F.col("vec_id").isNotNull() & finite & F.exists(x, lambda v: v != 0))
    sizes = ok.groupBy(F.size(x).alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    ok = ok.filter(F.size(x) == (sizes[0]["d"] if sizes else 0))
    return ok.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda v: v.cast("double")).alias("x"))


def _keys(x: np.ndarray, trees: int) -> np.ndarray:
    """One sorted-comparable 64-bit string per tree and vector."""
    planes = np.random.default_rng(20).standard_normal((x.shape[1], trees * BITS))
    signs = (x @ planes > 0).reshape(len(x), trees, BITS)
    return np.packbits(signs, axis=2).view(">u8")[:, :, 0].astype(np.uint64).T


class Forest:
    """The sorted arrays of a shard."""

    def __init__(self, x: np.ndarray, longest: float, trees: int):
        rest = np.sqrt(np.maximum(longest**2 - (x * x).sum(axis=1), 0))
        keys = _keys(np.c_[x, rest], trees)
        self.x, self.trees = x, trees
        self.order = np.argsort(keys, axis=1, kind="stable")
        self.keys = np.take_along_axis(keys, self.order, axis=1)

    def ranges(self, keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Per tree and query the part of the sorted array that shares the first `bits` bits."""
        free = np.uint64((1 << (BITS - bits)) - 1)
        low = np.stack([np.searchsorted(own, k & ~free, "left") for own, k in zip(self.keys, keys)])
        high = np.stack([np.searchsorted(own, k | free, "right") for own, k in zip(self.keys, keys)])
        return low, high

    def search(self, q: np.ndarray, candidates: int):
        """For every query the distinct rows that the synchronous ascent has met."""
        keys = _keys(np.c_[q, np.zeros(len(q))], self.trees)
        found, open_ = [None] * len(q), np.arange(len(q))
        for bits in range(BITS, -1, -1):  # below its longest match a query's ranges are empty
            low, high = self.ranges(keys[:, open_], bits)
            enough = (high - low).sum(axis=0) >= min(candidates, len(self.x))
            done = []
            for k in np.flatnonzero(enough).tolist():
                seen = np.zeros(len(self.x), bool)
                for t in range(self.trees):
                    seen[self.order[t, low[t, k]:high[t, k]]] = True
                rows = np.flatnonzero(seen)
                if len(rows) >= candidates or bits == 0:
                    found[open_[k]] = rows
                    done.append(k)
            open_ = np.delete(open_, done)
            if not len(open_):
                return found
        return found


def nearest(vectors: DataFrame, queries: DataFrame, k: int = NEAREST, trees: int = TREES,
            candidates: int = CANDIDATES, shard: int = SHARD) -> DataFrame:
    """(query_id, rank, vec_id, score): the `k` nearest found of `vectors` for every row of `queries`.

    Both hold (vec_id, x) as `valid` gives them; `queries` are rows of `vectors`. A row is no candidate
    of its own query. Ties go to the smaller vec_id. Rows that repeat a vec_id with another vector are
    rows of their own; an empty table gives no rows.
    """
    # a class is known by a hash of its vector; of its members only the first k + 1 can be results
    members = vectors.join(queries.select("vec_id", F.lit(True).alias("asks")).distinct(), "vec_id", "left")
    members = stored(members.withColumn("code", F.sha2(F.concat_ws(",", F.col("x").cast("array<string>")).cast("binary"), 256)), "vectors")
    classes = stored(members.groupBy("code").agg(F.first("x").alias("x"), F.max(F.coalesce("asks", F.lit(False))).alias("asks")), "classes")
    n, asking, longest = classes.agg(F.count(F.lit(1)), F.count_if("asks"),
                                     F.max(F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v)))).first()
    shards, parts = max(1, -(-n // shard)), max(1, -(-asking // QUERIES_TOGETHER))
    index = classes.select(F.pmod(F.xxhash64("code"), F.lit(shards)).alias("shard"),
                           F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "code", "x")
    asked = classes.filter("asks").select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"),
                                          F.pmod(F.xxhash64("code", F.lit(1)), F.lit(parts)).cast("int").alias("part"), "code", "x")

    def search(rows: pd.DataFrame, questions: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(questions):
            x, codes = np.stack(rows["x"].tolist()), rows["code"].to_numpy()
            forest = Forest(x, longest, trees)
            for start in range(0, len(questions), 1000):
                some = questions.iloc[start:start + 1000]
                q = np.stack(some["x"].tolist())
                for code, v, met in zip(some["code"], q, forest.search(q, candidates)):
                    score = x[met] @ v
                    if len(score) > k + 1:
                        last = np.partition(score, len(score) - k - 1)[len(score) - k - 1]
                        met, score = met[score >= last], score[score >= last]
                    out.append((code, codes[met].tolist(), score.tolist()))
        return pd.DataFrame(out, columns=["query", "codes", "scores"])

    met = index.groupBy("shard", "part").cogroup(asked.groupBy("shard", "part")).applyInPandas(
        search, "query string, codes array<string>, scores array<double>")
    met = met.select("query", F.explode(F.arrays_zip("codes", "scores")).alias("m")).select(
        "query", F.col("m.codes").alias("code"), F.col("m.scores").alias("score"))
    # the first k + 1 members of a class in two steps, so no task orders a third of all rows
    thin = W.partitionBy("code", "slice").orderBy("vec_id")
    first = W.partitionBy("code").orderBy("vec_id")
    few = (members.select("code", "vec_id", F.pmod(F.xxhash64("vec_id"), F.lit(256)).alias("slice"))
           .withColumn("k", F.row_number().over(thin)).filter(F.col("k") <= k + 1)
           .withColumn("k", F.row_number().over(first)).filter(F.col("k") <= k + 1).select("code", "vec_id"))
    by = W.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = met.join(few, "code").withColumn("k", F.row_number().over(by)).filter(F.col("k") <= k + 1)
    listed = best.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("k", "vec_id", "score"))).alias("found"))
    own = members.filter("asks").select(F.col("code").alias("query"), F.col("vec_id").alias("query_id")).join(listed, "query")
    others = F.slice(F.filter("found", lambda m: m["vec_id"] != F.col("query_id")), 1, k)
    return own.select("query_id", F.posexplode(others).alias("rank", "m")).select(
        "query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("m.vec_id").alias("vec_id"), F.col("m.score").alias("score"))


def every_nth(rows: DataFrame, every: int = EVERY, k: int = NEAREST) -> DataFrame:
    """`nearest` for the rows whose vec_id is divisible by `every`."""
    vectors = valid(rows)
    return nearest(vectors, vectors.filter(F.col("vec_id") % every == 0), k)
