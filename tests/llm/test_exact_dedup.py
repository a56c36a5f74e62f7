"""Exact duplicates against a dictionary of texts."""

import hashlib

import duckdb

from linepareto.llm import exact_dedup, queries


def brute(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text or "", []).append(doc_id)
    out = []
    for doc_id, text in rows:
        ids = groups[text or ""]
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        out.append((doc_id, keep, len(ids), doc_id == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


def test_equals_dictionary(table, prose):
    texts = [prose(k % 13, 5 + k % 13) for k in range(60)]
    rows = list(enumerate(texts)) + [(100, None), (101, ""), (102, " "), (None, texts[0]), (5, texts[5]), (103, "é"), (104, "é")]
    rows += [(200 + k, "a" * 64 + tail) for k, tail in enumerate("bbcd")] + [(None, "alone"), (300, "x" * 500_000), (301, "x" * 500_000)]
    assert got(exact_dedup.exact_duplicates(table(rows))) == brute(rows)
    assert got(exact_dedup.exact_duplicates(table([]))) == []


def test_no_python_and_no_text_in_a_shuffle(spark, plan):
    text = plan(queries.op6_exact_dedup(spark, "/root/testdata/sf0.001"))
    assert not any(word in text for word in ("Python", "Pandas", "Arrow"))
    assert not any(" text#" in line for line in text.split("Exchange")[1:] for line in line.split("\n")[1:2])


def test_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    columns = "doc_id, keep_id, group_size, kept, text_sha256"
    wanted = con.sql(f"SELECT {columns} FROM ({queries.oracle_sql()['op6_exact_dedup']})").fetchall()
    assert got(queries.op6_exact_dedup(spark, folder)) == sorted(wanted, key=repr)
