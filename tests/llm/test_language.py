"""Language identification: held-out accuracy and defined results for odd rows."""

import math
from collections import Counter
from zlib import crc32

import numpy as np
from pyspark.sql import functions as F

from linepareto.llm import language

DOCUMENTS = "/root/testdata/sf0.01/documents.parquet"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(DOCUMENTS)
    rows = language.held_out_predictions(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_held_out_languages_teach_nothing(spark):
    docs = spark.read.parquet(DOCUMENTS)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    changed = docs.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang"))).withColumn("source", F.lit("z"))
    one = language.held_out_predictions(docs).orderBy("doc_id").collect()
    assert language.held_out_predictions(changed).orderBy("doc_id").collect() == one


def test_odd_rows(table, prose):
    rows = [(k, prose(k, 40) if k % 2 else "Der " + prose(k, 30).replace("th", "ß"), "en" if k % 2 else "de") for k in range(30)]
    odd = [(100, None), (101, ""), (102, "12 34 !?"), (None, prose(5, 30), "en"), (103, prose(6, 9), None), (104, "x", "qq")]
    out = {r["doc_id"]: r for r in language.held_out_predictions(table(rows + odd + rows[:2])).collect()}
    assert {out[k]["lang_pred"] for k in (100, 101, 102)} == {"und"} and out[100]["score"] == 0
    assert out[103]["lang_pred"] in ("en", "de") and out[None]["lang_pred"] in ("en", "de")


def test_nothing_to_learn(table):
    assert [r["lang_pred"] for r in language.held_out_predictions(table([(0, "a b c")])).collect()] == ["und"]
    assert language.held_out_predictions(table([])).collect() == []


def test_long_text_is_read_whole():
    text = ("th er on " * 700_000 + "ß" * 3_000_000).encode()
    whole = language.features(text)
    assert whole[language._slots(language.np.frombuffer("ßß".encode(), "u1").astype("u4"), 4)].all()


def test_one_id_repeated_teaches_within_the_bound(table, prose, monkeypatch):
    fitted = []
    monkeypatch.setattr(language, "fit", lambda rows: fitted.append([lang for _, lang in rows]))
    same = [(7, prose(1, 5), "en")] * 3000
    own = [(8, prose(k, 5), "en") for k in range(500)]
    null = [(None, prose(("n", k), 5), "de") for k in range(300)]
    language.train(table(same + own + null + [(k, prose(k, 5), "fr") for k in range(100, 110)]))
    language.train(table(same + [(9, "der die das", "de"), (10, "das die der", "de")]))
    assert all(n <= language.ROWS_PER_LANGUAGE for found in fitted for n in map(found.count, set(found)))
    assert fitted[0].count("de") > 100 and fitted[0].count("fr") == 10
    assert fitted[1] == ["de", "de"]  # equal rows are one, and one teaches nothing


def plain_prediction(model, text):
    """Own loops over n-grams, families and votes."""
    if text is None or not any(c.isalpha() for c in text):
        return "und", 0.0
    vector = language.features(text.encode()).astype(float)
    margins = [sum(float(v) * float(w) for v, w in zip(vector[vector != 0], model.weights[vector != 0, k])) + float(model.bias[k])
               for k in range(model.weights.shape[1])]
    n = len(model.families)
    family = max(range(n), key=lambda k: margins[k])

    def squash(x):
        return 1 / (1 + math.exp(-4 * x))

    won, strength, weakest = Counter(), Counter(), {}
    for k in model.families[family]:
        won[k], strength[k], weakest[k] = 0, 0.0, 1.0
    for (a, b), margin in zip(model.pairs, margins[n:]):
        if a in won:
            won[a if margin > 0 else b] += 1
            for k, own in ((a, margin), (b, -margin)):
                strength[k] += own
                weakest[k] = min(weakest[k], squash(own))
    best = sorted(won, key=lambda k: (-won[k], -strength[k], k))[0]
    return model.languages[best], (squash(margins[family]) if n > 1 else 1.0) * weakest[best]


def test_every_prediction_equals_plain_loops(spark):
    docs = spark.read.parquet(DOCUMENTS)
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1
    model = language.train(docs.filter(learn))
    got = {r["doc_id"]: r for r in language.held_out_predictions(docs).collect()}
    for r in docs.filter("doc_id % 4 = 0").collect():
        lang, score = plain_prediction(model, r["text"])
        assert got[r["doc_id"]]["lang_pred"] == lang and abs(got[r["doc_id"]]["score"] - score) < 1e-4


def test_grams_are_counted_one_by_one():
    """Equal n-grams meet in one slot, and the vector's entries follow their counts."""
    found = language.features(b"aBcab")
    text = b" abcab "  # lower case, with a space at both ends
    slots = Counter()
    for size in language.GRAMS:
        for k in range(len(text) - size + 1):
            slots[int(language._slots(np.frombuffer(text[k:k + size], "u1").astype("u4"), size)[0])] += 1
    assert set(np.flatnonzero(found)) == set(slots)
    top = max(slots.values())
    assert all((found[s] >= found[o]) == (slots[s] >= slots[o]) for s in slots for o in slots) and top >= 2
