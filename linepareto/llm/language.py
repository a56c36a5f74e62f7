"""Language of a text: first its family, then linear machines between the languages of the family.

All classifiers share one table of hashed character n-grams (of bytes): the family by one linear
machine per family against the rest, a language by one support vector machine per pair of its
family's languages. Training reads a bounded sample of labelled rows, `ROWS_PER_LANGUAGE` of each;
prediction reads every byte of every text.
"""

from __future__ import annotations

import itertools
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window as W, functions as F

from linepareto.llm.common import NO_ID, in_training, working_on

ROWS_PER_LANGUAGE = 200
LEAST_PER_LANGUAGE = 2
BITS = 14
GRAMS = (2, 3, 4)
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_TEXT_BYTES = 4_000_000  # gathered at a time

# Language codes (ISO 639-1) by family.
FAMILIES = {
    "germanic": ("da", "de", "en", "is", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "pt", "ro"),
    "slavic": ("bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "uralic": ("et", "fi", "hu"),
    "baltic": ("lt", "lv"),
    "turkic": ("az", "kk", "tr", "uz"),
    "semitic": ("ar", "he", "mt"),
    "indo-aryan": ("bn", "hi", "mr", "ne", "ur"),
}


class Model(NamedTuple):
    languages: list[str]
    families: list[list[int]]  # numbers of the languages of each family
    pairs: list[tuple[int, int]]
    weights: np.ndarray  # one row per n-gram slot; columns: families, then pairs
    bias: np.ndarray


def _slots(data: np.ndarray, size: int) -> np.ndarray:
    """Slots of all n-grams of `size` bytes."""
    n = len(data) - size + 1
    code = np.full(max(n, 0), size, np.uint32)
    for k in range(size if n > 0 else 0):
        code = (code ^ data[k:k + n]) * np.uint32(0x01000193)
    code ^= code >> np.uint32(15)
    return ((code * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS)).astype(np.int64)


def features(text: bytes) -> np.ndarray:
    """Share of every slot among the n-grams of the text, square-rooted, of length 1."""
    data = np.frombuffer(b" " + text.lower() + b" ", np.uint8).astype(np.uint32)
    count = np.zeros(1 << BITS, np.int64)
    for start in range(0, len(data), _TEXT_BYTES):
        for size in GRAMS:  # pieces overlap by an n-gram
            part = data[start:start + _TEXT_BYTES + size - 1]
            count += np.bincount(_slots(part, size), minlength=1 << BITS)
    root = np.sqrt(count, dtype=np.float32)
    return root / max(np.linalg.norm(root), 1e-9)


def _machine(x: np.ndarray, y: np.ndarray, turns: int = 30, weak: float = 1e-4) -> tuple[np.ndarray, float]:
    """Linear support vector machine by dual coordinate descent with squared hinge loss."""
    x = np.c_[x, np.ones(len(x), np.float32)]
    c = 1 / (weak * len(x))
    share = np.where(y > 0, 0.5 / max((y > 0).mean(), 1e-9), 0.5 / max((y < 0).mean(), 1e-9))
    soft = 1 / (2 * c * share)
    norm = (x * x).sum(axis=1) + soft
    w, a = np.zeros(x.shape[1], np.float32), np.zeros(len(x))
    rnd = np.random.default_rng(0)
    for _ in range(turns):
        for i in rnd.permutation(len(x)):
            step = (1 - y[i] * (w @ x[i]) - soft[i] * a[i]) / norm[i]
            new = max(0.0, a[i] + step)
            if new != a[i]:
                w += np.float32((new - a[i]) * y[i]) * x[i]
                a[i] = new
    return w[:-1], float(w[-1])


def fit(rows: list[tuple[np.ndarray, str]]) -> Model:
    """From features and languages. A code that is not in the table above is a family of its own."""
    languages = sorted({lang for _, lang in rows})
    of = {code: name for name, codes in FAMILIES.items() for code in codes}
    names = [of.get(lang.split("-")[0].lower(), lang) for lang in languages]
    families = [[k for k, n in enumerate(names) if n == name] for name in sorted(set(names))]
    x = np.stack([f for f, _ in rows]).astype(np.float32)
    y = np.array([languages.index(lang) for _, lang in rows])
    columns = []
    for family in families:
        inside = np.isin(y, family)
        columns.append(_machine(x, np.where(inside, 1.0, -1.0)) if len(families) > 1 else (np.zeros(1 << BITS, np.float32), 0.0))
    pairs = [p for family in families for p in itertools.combinations(family, 2)]
    for a, b in pairs:
        both = (y == a) | (y == b)
        columns.append(_machine(x[both], np.where(y[both] == a, 1.0, -1.0)))
    return Model(languages, families, pairs, np.stack([c[0] for c in columns], axis=1), np.array([c[1] for c in columns]))


def _sigmoid(x: float) -> float:
    return float(1 / (1 + np.exp(-4 * np.clip(x, -100, 100))))


def predict(model: Model, text: str | None) -> tuple[str, float]:
    """Language and a score from 0 to 1: the family's margin times the weakest margin within it."""
    if not text or not _LETTER.search(text):
        return UNKNOWN, 0.0
    margin = features(text.encode()) @ model.weights + model.bias
    n = len(model.families)
    best = int(np.argmax(margin[:n]))
    score = _sigmoid(margin[best]) if n > 1 else 1.0
    votes = {k: [0, 0.0, 1.0] for k in model.families[best]}
    for (a, b), m in zip(model.pairs, margin[n:]):
        if a in votes:
            for k, own in ((a, m), (b, -m)):
                votes[k][0] += own > 0
                votes[k][1] += own
                votes[k][2] = min(votes[k][2], _sigmoid(own))
    chosen = max(votes, key=lambda k: (votes[k][0], votes[k][1], -k))
    return model.languages[chosen], score * votes[chosen][2]


def train(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> Model | None:
    """A model of the labelled rows of `docs`; of at most `rows_per_language` of a language features are collected.

    The rows with the smallest hashes of their ids are taken, rows of one id by their texts' hashes, and of
    equal rows one; a null id teaches like any other. Null texts, null languages and languages
    with a single row teach nothing. None if nothing is left to learn.
    """
    labelled = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select(
        "lang", "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.xxhash64("text").alias("text_key"))
    chance = F.xxhash64("doc_id", F.lit(7))
    # a language's rows are first thinned per slice, so no task orders a third of the table
    row = ["lang", "doc_id", "text_key"]
    thin = W.partitionBy("lang", "slice").orderBy("chance", "doc_id", "text_key")
    first = W.partitionBy("lang").orderBy("chance", "doc_id", "text_key")
    ids = labelled.select(*row).distinct().withColumns({
        "chance": chance, "slice": F.pmod(F.xxhash64("doc_id", "text_key"), F.lit(512))})
    some = ids.withColumn("k", F.row_number().over(thin)).filter(F.col("k") <= -(-rows_per_language // 64)) \
              .withColumn("k", F.row_number().over(first)).filter(F.col("k") <= rows_per_language).select(*row)
    chosen = labelled.join(F.broadcast(some), row, "left_semi").dropDuplicates(row)  # `some` is bounded

    def describe(batches):
        working_on("language")
        for batch in batches:
            found = [features(t.encode()).astype("<f2").tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(found, pa.binary())], names=["lang", "features"])

    rows = chosen.select("lang", "text").mapInArrow(describe, "lang string, features binary").collect()
    counts = Counter(r["lang"] for r in rows)
    rows = sorted((r["lang"], bytes(r["features"])) for r in rows if counts[r["lang"]] >= LEAST_PER_LANGUAGE)
    return fit([(np.frombuffer(f, "<f2"), lang) for lang, f in rows]) if rows else None


def languages(docs: DataFrame, model: Model | None) -> DataFrame:
    """All rows of `docs` with lang_pred and score; columns of `docs` with these names are replaced.

    `und` with score 0 for a null text, one without a letter, or without a model.
    """
    keep = [c for c in docs.columns if c not in ("lang_pred", "score")]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        working_on("language")
        for batch in batches:
            got = [predict(shared.value, t) if shared.value else (UNKNOWN, 0.0) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep] + [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                names=[*keep, "lang_pred", "score"])

    schema = docs.select(keep).schema.add("lang_pred", "string").add("score", "double")
    return docs.select(keep).mapInArrow(run, schema)


def held_out_predictions(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): learned where crc32(doc_id) mod 3 is not 1."""
    learn = in_training(3, 1)
    found = languages(docs.select("doc_id", "text", (~learn).alias("held_out")), train(docs.filter(learn)))
    return found.select("doc_id", "held_out", "lang_pred", "score")
