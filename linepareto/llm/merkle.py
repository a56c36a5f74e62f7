"""A Merkle manifest of a dataset: the root of all rows, and every row's proof against it.

Rows of a group, in order, are the leaves of a tree; the groups' roots, in order, are the leaves of another. Leaves
are cut into aligned *blocks*, each hashed in one task to the root of its subtree. The
levels above are a butterfly exchange of blocks: in every round a block swaps the root it has come to
with its partners in the neighbouring subtrees of an aligned group and hashes the levels over them
itself, as all its partners do. After the rounds, as many as the group's size divides the number of blocks,
every block holds the root and the whole upper proof of its leaves; nothing is sent down again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from linepareto.llm.common import stored

# Nodes hashed into one, levels below a block's root, levels a round of the exchange climbs.
FANOUT, BLOCK_LEVELS, ROUND_LEVELS = 2, 12, 4


def digest(*values: Column) -> Column:
    """SHA-256 in hex of the values one after the other: `-` for null, else byte count, `:` and value."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                             for t in texts]), 256)


def _hash(run: Sequence[str]) -> str:
    return hashlib.sha256("".join(run).encode()).hexdigest()


def _climb(nodes: list[str], fanout: int, levels: int | None) -> Iterator[list[str]]:
    """The nodes of each level and last what remains: after `levels`, or (None) one node."""
    yield nodes
    while len(nodes) > 1 if levels is None else levels > 0:
        nodes = [_hash(nodes[k:k + fanout]) for k in range(0, len(nodes), fanout)]
        levels = None if levels is None else levels - 1
        yield nodes


def _siblings(nodes: list[str], at: int, fanout: int) -> tuple[str, str]:
    """The others of a node's run, joined: those before and those behind it."""
    first = at - at % fanout
    return "".join(nodes[first:at]), "".join(nodes[at + 1:first + fanout])


def _ranked(rows: DataFrame, order: Sequence[str], block: int) -> DataFrame:
    """`rows`, which are stored, with their rank in their `key` (from 0), its `total` and their `block`.

    Rows are cut by range, so a key of any share of the rows lies in many tasks; each numbers its own,
    and the numbers of the tasks before come from one small row per key and task.
    """
    columns = list(rows.columns)

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for pdf in batches:
            if not len(pdf):
                continue
            at = pdf.groupby("key", sort=False).cumcount()
            at += (pdf["key"] == last) * seen
            last, seen = pdf["key"].iloc[-1], int(at.iloc[-1]) + 1
            yield pdf.assign(part=part, at=at)

    cut = rows.repartitionByRange("key", *order).sortWithinPartitions("key", *order)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    numbered = stored(cut.mapInPandas(number, f"{kinds}, part int, at long"), "numbered")
    counts = numbered.groupBy("key", "part").agg((F.max("at") + 1).alias("n"))
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(counts.select("key", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"),
                                   F.sum("n").over(Window.partitionBy("key")).alias("total")), "offsets")
    rank = F.col("offset") + F.col("at")
    return numbered.join(offsets, ["key", "part"]).select(
        *columns, rank.alias("rank"), "total", F.expr(f"(offset + at) div {block}").alias("block"))


def _block_roots(ranked: DataFrame, fanout: int, levels: int) -> DataFrame:
    """(key, block, blocks, node): each block's subtree hashed to its root."""
    block = fanout**levels

    def root(pdf: pd.DataFrame) -> pd.DataFrame:
        total = int(pdf["total"].iloc[0])
        nodes = pdf.sort_values("rank")["leaf"].tolist()
        for nodes in _climb(nodes, fanout, None if total <= block else levels):
            pass
        return pd.DataFrame({"key": pdf["key"].iloc[:1], "block": pdf["block"].iloc[:1], "blocks": -(-total // block),
                             "node": nodes})

    return ranked.select("key", "block", "total", "rank", "leaf").groupBy("key", "block").applyInPandas(
        root, "key string, block long, blocks long, node string")


_STATE = "key string, block long, blocks long, node string, before array<string>, after array<string>"


def _exchange(roots: DataFrame, fanout: int, levels: int) -> DataFrame:
    """The blocks with the root of their key in `node` and their siblings on all levels above them.

    Round r joins up to `group` subtrees of group**r blocks. A block stands at some place in its subtree and
    gets each partner subtree's root from the block at the same place there; where the last subtree
    is cut short, its blocks take turns in standing for the places it lacks.
    """
    group = fanout**levels
    none = F.array().cast("array<string>")
    state = stored(roots.select("*", none.alias("before"), none.alias("after")), "blocks")
    most, span = state.agg(F.max("blocks")).first()[0] or 0, 1

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                nodes = [r["node"] for r in sorted(row.got, key=lambda r: r["tree"])]
                before, after, node = list(row.own["before"]), list(row.own["after"]), nodes[0]
                if row.subtrees > 1:
                    at = row.tree % group
                    climbed = list(_climb(nodes, fanout, None if row.subtrees <= group else levels))
                    for level in climbed[:-1]:
                        left, right = _siblings(level, at, fanout)
                        before.append(left)
                        after.append(right)
                        at //= fanout
                    node = climbed[-1][0]
                out.append((row.key, row.block, row.blocks, node, before, after))
            yield pd.DataFrame(out, columns=["key", "block", "blocks", "node", "before", "after"])

    while most > span:
        size = F.lit(span)
        own = state.withColumns({"tree": F.expr(f"block div {span}"), "place": F.col("block") % size,
                                 "subtrees": F.expr(f"(blocks + {span - 1}) div {span}")})
        length = F.least(size, F.col("blocks") - F.col("tree") * size)  # blocks of the own subtree
        first = F.expr(f"tree div {group}") * group
        sent = own.withColumns({"length": length, "to": F.explode(
            F.sequence(first, F.least(first + group, F.col("subtrees")) - 1))})
        there = F.least(size, F.col("blocks") - F.col("to") * size)
        places = F.when(F.col("place") < there, F.sequence(F.col("place"), there - 1, F.col("length")))
        sent = sent.withColumn("place", F.explode(places)).withColumn("receiver", F.col("to") * size + F.col("place"))
        mine = F.when(F.col("receiver") == F.col("block"), F.struct("before", "after"))
        got = sent.groupBy("key", F.col("receiver").alias("block")).agg(
            F.first("blocks").alias("blocks"), F.first("subtrees").alias("subtrees"), F.first("to").alias("tree"),
            F.max_by(mine, mine.isNotNull()).alias("own"), F.collect_list(F.struct("tree", "node")).alias("got"))
        state = stored(got.mapInPandas(hashed, _STATE), "blocks")
        span *= group
    return state


def _with_proofs(ranked: DataFrame, blocks: DataFrame, columns: Sequence[str], fanout: int, levels: int) -> DataFrame:
    """`columns` of every row, and of its block `node` and the siblings on all levels: its own, then the block's."""
    kinds = {f.name: f.dataType.simpleString() for f in ranked.schema.fields}
    more = [c for c in blocks.columns if c not in ("key", "block", "blocks", "before", "after")]
    kinds |= {f.name: f.dataType.simpleString() for f in blocks.schema.fields if f.name in more}
    schema = ", ".join(f"{c} {kinds[c]}" for c in [*columns, *more]) + ", before array<string>, after array<string>"

    def proofs(pdf: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rank")
        total = int(pdf["total"].iloc[0])
        upper = block.iloc[0]
        climbed = list(_climb(pdf["leaf"].tolist(), fanout, None if total <= fanout**levels else levels))[:-1]
        beside = [[_siblings(nodes, at, fanout) for at in range(len(nodes))] for nodes in climbed]
        above = (list(upper["before"]), list(upper["after"]))
        sides = [[[beside[k][i // fanout**k][side] for k in range(len(climbed))] + above[side] for i in range(len(pdf))]
                 for side in (0, 1)]
        return pdf[list(columns)].assign(**{c: upper[c] for c in more}, before=sides[0], after=sides[1])

    return ranked.groupBy("key", "block").cogroup(blocks.groupBy("key", "block")).applyInPandas(proofs, schema)


def _tree(rows: DataFrame, order: Sequence[str], fanout: int, block_levels: int, round_levels: int):
    ranked = _ranked(rows, order, fanout**block_levels)
    blocks = _exchange(_block_roots(ranked, fanout, block_levels), fanout, round_levels)
    return ranked, blocks


def manifest(docs: DataFrame, columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"), group: str = "lang",
             order: str = "doc_id", carried: Mapping[str, Column] | None = None, fanout: int = FANOUT,
             block_levels: int = BLOCK_LEVELS, round_levels: int = ROUND_LEVELS) -> DataFrame:
    """One row per row of `docs`: `order`, `leaf`, `subroot`, `root`, `before`, `after` and what is `carried`.

    A leaf is the `digest` of `columns`. Leaves of a `group` ascend by `order` (null first; equal ones by
    their leaf, so that identical rows, which may change places, are all that is left open); every
    `fanout` of a level are hashed together until one is left, the group's subroot. Subroots, by group
    (null first, then bytewise), give the root the same way. `before` and `after` have, from the leaf's level
    to the root's, the siblings in front of and behind the node, joined: `fold` leads from a leaf to the
    root. Texts are read once and not shuffled. An empty table gives no rows.
    """
    key = F.coalesce(F.concat(F.lit("+"), F.col(group).cast("string")), F.lit(""))
    carried = carried or {}
    leaves = stored(docs.select(key.alias("key"), F.col(order).alias("order"), digest(*map(F.col, columns)).alias("leaf"),
                                F.monotonically_increasing_id().alias("tie"),
                                *[value.alias(name) for name, value in carried.items()]), "leaves")
    levels = (fanout, block_levels, round_levels)
    ranked, blocks = _tree(leaves, ["order", "leaf", "tie"], *levels)
    subroots = stored(blocks.filter("block = 0").select(F.lit("").alias("key"), F.col("key").alias("group"),
                                                        F.col("node").alias("leaf")), "subroots")
    upper = _with_proofs(*_tree(subroots, ["group"], *levels), ["group", "leaf"], fanout, block_levels)
    upper = stored(upper, "upper")
    whole = blocks.join(upper.select(F.col("group").alias("key"), F.col("node").alias("root"),
                                     F.col("before").alias("first"), F.col("after").alias("last")), "key").select(
        "key", "block", F.col("node").alias("subroot"), "root", F.concat("before", "first").alias("before"),
        F.concat("after", "last").alias("after"))
    found = _with_proofs(ranked, whole, ["order", "leaf", *carried], fanout, block_levels)
    return found.withColumnRenamed("order", order)


def fold(leaf: Column, before: Column, after: Column) -> Column:
    """The root that a leaf's proof leads to."""
    return F.aggregate(F.zip_with(before, after, lambda b, a: F.struct(b.alias("b"), a.alias("a"))), leaf,
                       lambda node, run: F.sha2(F.concat(run["b"], node, run["a"]), 256))


def verified_manifest(docs: DataFrame, damaged: int = 7, **levels: int) -> DataFrame:
    """The manifest of `documents` and a check of every row against the root.

    doc_id, leaf, subroot, root, proof_sha256 (of all siblings from the leaf's level to the root's, those of a
    level left to right), folded_root, verified. Where `damaged` divides the crc32 of the written doc_id,
    the leaf that is folded has n_chars greater by 1 (nulls stay; a null doc_id is not damaged).
    """
    n_chars = F.col("n_chars").cast("decimal(20,0)")
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % damaged == 0, F.lit(False))
    other = digest(F.col("doc_id"), F.col("source"), F.col("lang"), n_chars + 1, F.col("text"))
    rows = manifest(docs, carried={"tampered": F.when(hit, other)}, **levels)
    siblings = F.array_join(F.zip_with("before", "after", lambda b, a: F.concat(b, a)), "")
    folded = rows.withColumn("folded_root", fold(F.coalesce("tampered", "leaf"), F.col("before"), F.col("after")))
    return folded.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), "folded_root",
                         (F.col("folded_root") == F.col("root")).alias("verified"))
