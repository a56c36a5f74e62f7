"""The pipeline, stage by stage, against brute force on what the stage before kept."""

import random
from collections import Counter

import corpus_pipeline
import pytest

from linepareto.llm import language
from test_jaccard import brute as components
from test_line_chunks import brute as line_digests
from test_substrings import brute as byte_digests

import hashlib


@pytest.fixture(scope="module")
def rows(prose):
    rnd = random.Random(6)
    lines = [prose(f"p{k}", 9) for k in range(12)]
    out = []
    for k in range(90):
        text = [prose(("d", k, j), rnd.randint(3, 12)) for j in range(rnd.randint(1, 10))]
        if k % 4 == 1:
            text[1:1] = lines[rnd.randint(0, 4):rnd.randint(6, 12)]
        if k % 7 == 3:
            text = out[k // 2][1].split(" ")
            text[len(text) // 2] = "changed"
            text = [" ".join(text)]
        body = "\n".join(text)
        if k % 5 == 2:
            body += " é " + prose("long passage", 50) + " end"
        out.append((k, body if k % 2 else "Der " + body.replace("th", "ß"), "en" if k % 2 else "de"))
    return out + [(100, None, "en"), (101, "", "en"), (102, "123 456", None), (103, out[3][1], "en"), (104, out[3][1], "en"), (None, prose(4, 40), "en")]


def test_stages(spark, table, rows):
    docs = table(rows)
    columns, kept = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES:
        before = [(r["doc_id"], r["text"]) for r in kept.collect()]
        after = stage(spark, kept, "")
        result = after.collect()
        if name == "best_fit_packing":
            assert Counter(r["doc_id"] for r in result if r["piece"] == 0) == Counter(d for d, _ in before)
            continue
        assert after.columns == columns
        got = sorted(((r["doc_id"], r["text"]) for r in result), key=repr)
        if name == "language_id":
            model = language.train(docs)
            assert got == sorted((b for b in before if language.predict(model, b[1])[0] != "und"
                                  and language.predict(model, b[1])[1] >= corpus_pipeline.LEAST_SCORE), key=repr)
            assert {k for k, _, _ in rows[:90]} <= {d for d, _ in got}  # clean documents stay
        elif name == "ngram_jaccard_join":
            low = {d for d, _, c in components(before) if d == c}
            assert got == sorted((b for b in before if b[0] in low), key=repr)
        elif name == "line_dedup":
            assert Counter((d, hashlib.sha256(t.encode()).hexdigest()) for d, t in got) == Counter(
                (d, s) for d, _, _, s in line_digests(before) if s != hashlib.sha256(b"").hexdigest())
        else:
            wanted = {d: (n - r) for d, n, r, _, s in byte_digests(before)}
            assert all(wanted[d] - 6 <= len(t.encode()) <= wanted[d] for d, t in got)
            assert {d for d, _ in got} == {d for d, n in wanted.items() if n}
        kept = spark.createDataFrame(result, after.schema)


def test_runs_on_the_table(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0


def test_empty_table(spark, table):
    docs = table([])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "").collect() == []


def test_a_worker_keeps_only_its_operators_memory():
    from linepareto.llm import common, packing, words

    words.numbers([b"a", b"b"])
    common.working_on("words", words.forget)
    packing._encoders["x"] = None
    common.working_on("packing", packing._encoders.clear)
    assert not words._hashes and "x" in packing._encoders
    common.working_on("packing", packing._encoders.clear)
    assert "x" in packing._encoders
    common.working_on("language")
    assert not packing._encoders and not common._kept


def test_workers_get_small_batches(spark, table):
    """Every stage keeps Spark from handing over 10,000 whole texts at once; a smaller limit stays."""
    name, docs = "spark.sql.execution.arrow.maxRecordsPerBatch", table([(1, "some text", "en")])
    before = spark.conf.get(name)
    try:
        for _, stage in corpus_pipeline.STAGES:
            for limit, wanted in (("10000", "1000"), ("0", "1000"), ("50", "50")):
                spark.conf.set(name, limit)
                stage(spark, docs, "")
                assert spark.conf.get(name) == wanted
    finally:
        spark.conf.set(name, before)
