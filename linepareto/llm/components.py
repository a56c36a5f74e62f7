"""Connected components of an edge table by random contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from linepareto.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b); nodes of one component share the root.

    In every round each node moves to the node of its neighbourhood with the smallest hash, itself
    included, and edges are rewritten to the targets; the rest shrinks by a factor per round
    whatever the shape. All is grouped with a combine step or joined, nothing is collected.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).filter("a != b").distinct()
    left, found, turn = stored(both, "edges"), None, 0
    while True:
        own = F.struct(F.xxhash64("a", F.lit(turn)).alias("p"), F.col("a").alias("v"))
        near = F.min(F.struct(F.xxhash64("b", F.lit(turn)).alias("p"), F.col("b").alias("v")))
        moved = left.groupBy("a").agg(near.alias("near")).select(
            F.col("a").alias("node"), F.least(own, F.col("near"))["v"].alias("to"))
        moved = stored(moved, "moved")
        if found is None:
            found = moved.withColumnRenamed("to", "root")
        else:
            step = moved.select(F.col("node").alias("root"), "to")
            found = stored(found.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "roots")
        ends = left.join(moved.select(F.col("node").alias("a"), F.col("to").alias("ta")), "a") \
                   .join(moved.select(F.col("node").alias("b"), F.col("to").alias("tb")), "b")
        left = stored(ends.filter("ta != tb").select(F.col("ta").alias("a"), F.col("tb").alias("b")).distinct(), "edges")
        if left.isEmpty():
            return found
        turn += 1
