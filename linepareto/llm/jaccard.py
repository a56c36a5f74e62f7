"""Documents whose sets of word shingles overlap, by a prefix-filtered join.

Equal sets are one node. Shingles are ordered from rare to frequent (documents over the whole table,
one per node), and two sets of the wanted similarity share a shingle among their first
n - ceil(t n) + 1. Nodes meet on those; length, positional and suffix filters come before the sets
themselves are compared, once per pair.

The result is the components of the links. Within a prefix shingle's group, nodes that are already
connected need no comparison, so each group is first compared with single members, the most typical
one first, and only what is still unconnected after that is joined with the rest of its group. A group of copies,
however large, costs a few comparisons per member.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from linepareto.llm import words
from linepareto.llm.common import ASKED, NO_ID, Totals, ask, block_count, block_of, blocked, stored, texts, totals, with_null_ids, working_on
from linepareto.llm.components import components

# Similarity as a ratio of whole numbers.
ABOVE, BELOW = 4, 5
# Ranges of the hash space whose counts bound an overlap.
RANGES = 16
STARS = 2
NODE = "node binary, n int, common int, grams array<long>, spots array<int>, ranges array<int>, shingles array<long>"


def _key(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def _text_key() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key")


def sets(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, n, node): size and 128-bit key of every row's shingle set."""
    def run(batches):
        working_on("words", words.forget)
        for batch in batches:
            found = list(words.shingles_of(batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array([len(s) for s in found], pa.int64()),
                 pa.array([_key(s) for s in found], pa.binary())], names=["doc_id", "text_key", "n", "node"])

    return texts(docs, _text_key()).mapInArrow(run, "doc_id long, text_key long, n long, node binary")


def _first_of_each(pdf: pd.DataFrame, wanted: set[bytes]):
    """(node, shingles) for the nodes that this block stands for."""
    for found in words.shingles_of(pdf["text"].tolist()):
        if (key := _key(found)) in wanted:
            wanted.discard(key)
            yield key, found


def nodes(docs: DataFrame, classes: DataFrame, n_blocks: int) -> DataFrame:
    """NODE for every set that shares one of its prefix shingles with another set."""
    text = blocked(docs, n_blocks)
    wanted = classes.filter("n > 0").select(block_of(n_blocks).alias("block"), F.lit(-1).alias("bucket"),
                                            F.col("node").alias("keys"), F.lit(None).cast("binary").alias("totals"))

    def keys(pdf: pd.DataFrame, chosen: pd.DataFrame) -> pd.DataFrame:
        working_on("words", words.forget)
        found = [s for _, s in _first_of_each(pdf, set(chosen["keys"]))]
        if not found:
            return pd.DataFrame(columns=["block", "bucket", "keys", "counts"])
        every = np.concatenate(found)
        del found
        every.sort()
        at = np.flatnonzero(np.r_[True, every[1:] != every[:-1]])
        distinct, counts = every[at], np.diff(at, append=len(every))
        del every, at
        return ask(int(pdf["block"].iloc[0]), distinct, counts, n_blocks, short=True)

    def prefixes(pdf: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        working_on("words", words.forget)
        known = Totals(answers[answers["bucket"] >= 0], n_blocks, short=True)
        out = []
        for key, found in _first_of_each(pdf, set(answers["keys"][answers["bucket"] < 0])):
            n, seen = len(found), known.of(found)
            length = n - -(-ABOVE * n // BELOW) + 1
            order = np.argsort(seen, kind="stable")[:length]  # equal totals by shingle, which are sorted
            shared = np.flatnonzero(seen[order] >= 2)
            if len(shared):
                ranges = np.bincount((found >> np.uint64(60)).astype(np.int64), minlength=RANGES)
                out.append((key, n, int(1000 * (seen >= 2).mean()), found[order[shared]].view(np.int64), shared.astype(np.int32),
                            ranges.astype(np.int32), found.view(np.int64)))
        return pd.DataFrame(out, columns=["node", "n", "common", "grams", "spots", "ranges", "shingles"])

    asked = text.groupBy("block").cogroup(wanted.groupBy("block")).applyInPandas(keys, ASKED)
    answers = totals(asked, least=2, short=True).union(wanted)
    return text.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(prefixes, NODE)


def _may_link() -> Column:
    """Length filter, positional filter for the shared shingle's places, and suffix filter for a joined pair.

    The suffix filter counts both sets by ranges of the hash space: what the counts differ by is not shared.
    """
    n, m = F.col("n"), F.col("m_n")
    rest = F.least(n - F.col("spot"), m - F.col("m_spot"))
    apart = F.aggregate(F.zip_with("ranges", "m_ranges", lambda x, y: F.abs(x - y)), F.lit(0), lambda s, x: s + x)
    return ((BELOW * F.least(n, m) >= ABOVE * F.greatest(n, m)) & (rest * (ABOVE + BELOW) >= ABOVE * (n + m))
            & ((n + m - apart) * (ABOVE + BELOW) >= 2 * ABOVE * (n + m)))


def links(pairs: DataFrame, node: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    def side(name: str) -> DataFrame:
        return node.select(F.col("node").alias(name), F.col("shingles").alias(f"{name}_shingles"))

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    total = F.size("a_shingles") + F.size("b_shingles")
    shared = F.size(F.array_intersect("a_shingles", "b_shingles"))
    return both.filter(shared * (ABOVE + BELOW) >= ABOVE * total).select("a", "b")


_SIDE = ("node", "n", "spot", "root", "ranges")


def linked(node: DataFrame) -> DataFrame:
    """(node, root) of all nodes that have a link."""
    rows = node.select("node", "n", "common", "ranges", F.explode(F.arrays_zip("grams", "spots")).alias("g")).select(
        "node", "n", "common", "ranges", F.col("g.grams").alias("gram"), F.col("g.spots").alias("spot"))
    tested = edges = roots = None
    for turn in range(STARS + 1):
        at = rows.withColumn("root", F.col("node")) if roots is None else \
            rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        if turn < STARS:  # the member with the largest share of common shingles, then others
            choice = F.struct(F.col("common") if turn == 0 else F.lit(0), F.xxhash64("node", F.lit(turn)))
            groups = at.groupBy("gram").agg(F.max_by(F.struct(*_SIDE), choice).alias("m"),
                                            F.min("root").alias("low"), F.max("root").alias("high"))
            other = groups.filter("low != high").select("gram", *[F.col(f"m.{c}").alias(f"m_{c}") for c in _SIDE])
            left = at
        else:  # whatever is not in its group's largest component, with all others of the group
            parts = at.groupBy("gram", "root").count()
            main = parts.groupBy("gram").agg(F.max_by("root", F.struct("count", "root")).alias("main"),
                                             F.count(F.lit(1)).alias("parts")).filter("parts > 1").select("gram", "main")
            open_rows = at.join(main, "gram")
            left = open_rows.filter("root != main").drop("main")
            other = open_rows.select("gram", *[F.col(c).alias(f"m_{c}") for c in _SIDE])
        pairs = left.join(other, "gram").filter((F.col("root") != F.col("m_root")) & _may_link())
        pairs = pairs.select(F.least("node", "m_node").alias("a"), F.greatest("node", "m_node").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        new = stored(links(pairs, node), "links")
        tested = pairs if tested is None else tested.union(pairs)
        edges = new if edges is None else edges.union(new)
        roots = components(edges)
    return roots


def groups(docs: DataFrame, n_blocks: int | None = None) -> DataFrame:
    """(doc_id, text_key, n, root, component_id) per row; the root is null for rows without shingles."""
    n_blocks = n_blocks or block_count(docs)
    members = stored(sets(docs), "sets")
    classes = stored(members.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n")), "classes")
    roots = linked(stored(nodes(docs, classes, n_blocks), "nodes"))
    of_class = classes.filter("n > 0").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lowest = of_class.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    found = of_class.join(lowest, "root").select("node", "root", "component_id")
    some = members.filter("n > 0").join(found, "node").select("doc_id", "text_key", "n", "root", "component_id")
    none = members.filter("n = 0").select("doc_id", "text_key", "n", F.lit(None).cast("binary").alias("root"),
                                          F.col("doc_id").alias("component_id"))
    return some.union(none)


def similar_documents(docs: DataFrame, n_blocks: int | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of `docs`.

    Two documents link when the Jaccard similarity of their distinct 5-word shingles is 0.8 or more.
    component_id is the smallest doc_id reachable by links. A text without words, or null, has no
    shingle and stands alone; one with fewer words is one shingle. A null id is smaller than others;
    repeated rows link with each other. An empty table gives no rows.
    """
    return with_null_ids(groups(docs, n_blocks), "doc_id", "component_id").select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id")


def one_of_each_group(docs: DataFrame, n_blocks: int | None = None) -> DataFrame:
    """Rows of `docs`: of every group of `similar_documents` one row with the smallest id.

    Rows without shingles all stay. Of rows that share id and text one stays.
    """
    found = groups(docs, n_blocks)
    first = found.filter("root IS NOT NULL").groupBy("root").agg(F.min(F.struct("doc_id", "text_key")).alias("f")).select("f.*")
    stay = stored(first.union(found.filter("root IS NULL").select("doc_id", "text_key")).distinct(), "representatives")
    own = F.struct(*docs.columns).alias("own")
    rows = docs.select(own, F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), _text_key())
    same = W.partitionBy("doc_id", "text_key").orderBy(F.lit(0))
    rows = rows.join(stay, ["doc_id", "text_key"], "left_semi").withColumn("copy", F.row_number().over(same))
    return rows.filter("copy = 1").select("own.*")
