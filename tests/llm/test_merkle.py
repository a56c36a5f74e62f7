"""The Merkle manifest against a tree held in one list, and against SQL."""

import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from linepareto.llm import merkle, queries

COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    doc_id, source, lang, n_chars, text = row
    n_chars = None if n_chars is None else n_chars + more
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def tree(nodes, fanout):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][k:k + fanout]) for k in range(0, len(levels[-1]), fanout)])
    return levels


def way(levels, at, fanout):
    out = []
    for nodes in levels[:-1]:
        first = at - at % fanout
        out.append(("".join(nodes[first:at]), "".join(nodes[at + 1:first + fanout])))
        at //= fanout
    return out


def brute(rows, fanout=2):
    """rows: (doc_id, source, lang, n_chars, text)"""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    groups = [sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for lang in langs]
    trees = [tree([leaf(r) for r in group], fanout) for group in groups]
    top = tree([t[-1][0] for t in trees], fanout) if rows else []
    out = []
    for number, (group, own) in enumerate(zip(groups, trees)):
        for at, row in enumerate(group):
            proof = way(own, at, fanout) + way(top, number, fanout)
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            node = leaf(row, hit)
            for before, after in proof:
                node = sha(before, node, after)
            root = top[-1][0]
            out.append((row[0], leaf(row), own[-1][0], root, sha(*[b + a for b, a in proof]), node, node == root))
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=repr)


@pytest.fixture(scope="module")
def documents(spark):
    def make(rows):
        kinds = "doc_id long, source string, lang string, n_chars long, text string"
        return spark.createDataFrame(rows, kinds).selectExpr(
            "*", "1 AS key", "'x' AS block", "2 AS rank", "3L AS node", "0 AS before", "1 AS tie", "7 AS leaf").repartition(3)

    return make


def rows_of(sizes):
    return [(1000 * k + i, None if i % 5 == 0 else f"s{i}", lang, None if i % 4 == 0 else i, f"é{i}\n" * (i % 7))
            for k, (lang, n) in enumerate(sizes.items()) for i in range(n)]


@pytest.mark.parametrize("levels", [{}, {"block_levels": 1, "round_levels": 1}, {"block_levels": 2, "round_levels": 2},
                                    {"fanout": 3, "block_levels": 1, "round_levels": 1}, {"fanout": 5, "block_levels": 1, "round_levels": 2}])
def test_equals_one_tree(documents, levels):
    rows = rows_of({"en": 77, "de": 1, None: 33, "fr": 2, "": 5, "é": 16, "z": 17})
    found = got(merkle.verified_manifest(documents(rows), **levels))
    assert found == brute(rows, levels.get("fanout", 2))
    assert {r[6] for r in found} == {True, False}


def test_odd_input(documents):
    rows = rows_of({"en": 9, None: 3}) + [(None, None, None, None, None)] * 3 + [(4, "s4", "en", 4, "other"), (4, "s4", "en", 4, "other")]
    rows += [(50, "s", "en", 3, "x" * 2_000_000), (51, "s", "en", 2**63 - 1, ""), (-3, "s", "xx", -1, "a")]
    assert got(merkle.verified_manifest(documents(rows), block_levels=2)) == brute(rows)
    assert got(merkle.verified_manifest(documents([]))) == []
    assert got(merkle.verified_manifest(documents(rows[:1]))) == brute(rows[:1])


def test_proofs_fold_to_the_root(documents):
    rows = rows_of({"en": 40, "de": 13})
    found = merkle.manifest(documents(rows), block_levels=2, round_levels=1)
    assert found.filter(merkle.fold(F.col("leaf"), F.col("before"), F.col("after")) != F.col("root")).isEmpty()


def test_no_text_in_a_shuffle(spark, plan):
    text = plan(queries.op13_merkle_manifest(spark, "/root/testdata/sf0.001"))
    assert not any(" text#" in line for line in text.split("\n"))


def test_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    wanted = con.sql(f"SELECT {', '.join(COLUMNS)} FROM ({queries.oracle_sql()['op13_merkle_manifest']})").fetchall()
    assert got(queries.op13_merkle_manifest(spark, folder)) == sorted(wanted, key=repr)
