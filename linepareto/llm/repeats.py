"""Content that an earlier place of the corpus holds already, found block by block.

Four steps over the same blocks of documents:

1. every block asks for the totals of its segments' keys;
2. segments whose key occurs twice or more anywhere go, with their bytes, to the shard of the key.
   A block sends equal content once, from its earliest place, so content that a third of all
   documents share reaches a shard once per block;
3. a shard decides from the bytes which places are repeats of an earlier place;
4. the places go back to their blocks, where the documents are cut.

"Earlier" is the smaller doc_id, in a document the earlier start. Rows that share an id are ordered
by their text; among equal rows either may stay.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from linepareto.llm.common import ASKED, NO_ID, Totals, ask, block_count, blocked, totals, with_null_ids, working_on

# A place is the row's number among rows of its id, then the byte in its text.
ROW_BITS = np.int64(40)
BATCH_BYTES = 1_000_000
SHARDS_PER_BLOCK = 6
SENT = "block int, shard int, kind string, docs binary, places binary, lengths binary, data binary"
PLACES = "block int, docs binary, places binary, lengths binary"


class Segments(NamedTuple):
    """Segments of a batch of texts: number of the text, first byte, end, key, times the key occurs (2: more than once)."""

    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    key: np.ndarray
    times: np.ndarray


class Sent(NamedTuple):
    """Contents or known repeats with their places."""

    docs: np.ndarray
    places: np.ndarray
    lengths: np.ndarray
    data: list[bytes]


class Method(NamedTuple):
    """How an operator cuts, decides and reports; all are plain functions."""

    segments: Callable[[list[bytes]], Segments]
    decide: Callable[[Sent], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]]
    report: Callable[[bytes, np.ndarray, np.ndarray], tuple]
    columns: dict[str, str]
    hot: int | None = None  # keys with a larger total are decided window by window
    windows: Callable[[bytes, int, int], tuple[np.ndarray, np.ndarray]] | None = None
    window_bytes: int = 0


def _rows(pdf: pd.DataFrame) -> tuple[list[int], list[bytes], list[int]]:
    """Ids, texts and row numbers within an id, in the order of places."""
    both = sorted(zip(pdf["doc_id"].tolist(), pdf["text"].tolist()))
    ids, numbers = [d for d, _ in both], []
    for k, doc_id in enumerate(ids):
        numbers.append(numbers[-1] + 1 if k and ids[k - 1] == doc_id else 0)
    return ids, [t for _, t in both], numbers


def _batches(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    start, size = 0, 0
    for k, text in enumerate(texts):
        if k > start and size + len(text) > BATCH_BYTES:
            yield start, texts[start:k]
            start, size = k, 0
        size += len(text)
    if start < len(texts):
        yield start, texts[start:]


def _blob(sent: Sent, rows: np.ndarray) -> tuple[bytes, bytes, bytes, bytes]:
    return (sent.docs[rows].tobytes(), sent.places[rows].tobytes(), sent.lengths[rows].tobytes(),
            b"".join([sent.data[r] for r in rows]) if sent.data else b"")


def _pack(block: int, shard: np.ndarray, kind: str, sent: Sent) -> pd.DataFrame:
    """One row SENT per shard."""
    order = np.argsort(shard, kind="stable")
    cuts = np.flatnonzero(np.diff(shard[order])) + 1
    groups = np.split(order, cuts) if len(order) else []
    rows = [(block, int(shard[g[0]]), kind, *_blob(sent, g)) for g in groups]
    return pd.DataFrame(rows, columns=["block", "shard", "kind", "docs", "places", "lengths", "data"])


def _unpack(pdf: pd.DataFrame) -> Sent:
    def joined(column: str) -> np.ndarray:
        return np.frombuffer(b"".join(pdf[column]), np.int64)

    lengths, data = joined("lengths"), b"".join(pdf["data"])
    if data:
        ends = np.cumsum(lengths).tolist()
        data = [data[a:b] for a, b in zip([0, *ends], ends)]
    return Sent(joined("docs"), joined("places"), lengths, data or [])


def first_places(sent: Sent) -> tuple[Sent, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Every distinct content at its first place, and the places of the others."""
    first: dict[bytes, int] = {}
    again = []
    for row in np.lexsort((sent.places, sent.docs)).tolist():
        if first.setdefault(sent.data[row], row) != row:
            again.append(row)
    keep = np.fromiter(first.values(), np.int64, len(first))
    again = np.array(again, np.int64)
    return (Sent(sent.docs[keep], sent.places[keep], sent.lengths[keep], list(first)),
            (sent.docs[again], sent.places[again], sent.lengths[again]))


def repeats(docs: DataFrame, method: Method, n_blocks: int | None = None, row: str | None = None) -> DataFrame:
    """doc_id and `method.columns` per row of `docs`, with its number among the rows of its id as `row`.

    Null text is empty; an empty table gives none.
    """
    n_blocks = n_blocks or block_count(docs)
    buckets, shards = n_blocks, SHARDS_PER_BLOCK * n_blocks
    text = blocked(docs, n_blocks)

    extra = [row] if row else []

    def keys(pdf: pd.DataFrame) -> pd.DataFrame:
        working_on("repeats")
        found = [method.segments(batch) for _, batch in _batches(pdf["text"].tolist())]
        distinct, at = np.unique(np.concatenate([f.key for f in found]), return_inverse=True)
        counts = np.bincount(at, weights=np.concatenate([f.times for f in found]), minlength=len(distinct))
        return ask(int(pdf["block"].iloc[0]), distinct, counts, buckets, short=True)

    def send(pdf: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if not len(pdf):
            return pd.DataFrame(columns=["block", "shard", "kind", "docs", "places", "lengths", "data"])
        block, known = int(pdf["block"].iloc[0]), Totals(answers, buckets, short=True)
        ids, whole, numbers = _rows(pdf)
        seen: set[bytes] = set()
        new, old, hot = [], [], []
        for start, batch in _batches(whole):
            seg = method.segments(batch)
            total = known.of(seg.key)
            for s in np.flatnonzero(total >= 2).tolist():
                row, a, b = start + int(seg.text[s]), int(seg.start[s]), int(seg.end[s])
                at = (ids[row], numbers[row] << int(ROW_BITS) | a, b - a)
                if method.hot and total[s] > method.hot:
                    hot.append((*at, row, a, b))
                elif (content := batch[seg.text[s]][a:b]) in seen:
                    old.append(at)
                else:
                    seen.add(content)
                    new.append((*at, content, int(seg.key[s]) >> 32))
        out = []
        if new:
            d, p, n, data, key = zip(*new)
            sent = Sent(np.array(d, np.int64), np.array(p, np.int64), np.array(n, np.int64), list(data))
            out.append(_pack(block, np.array(key, np.int64) % shards, "content", sent))
        if hot:
            out += _hot(method, block, hot, whole, shards)
        if old:
            sent = Sent(*(np.array(c, np.int64) for c in zip(*old)), [])
            out.append(_pack(block, np.full(len(old), block % shards), "known", sent))
        return pd.concat(out) if out else pd.DataFrame(columns=["block", "shard", "kind", "docs", "places", "lengths", "data"])

    def decide(pdf: pd.DataFrame) -> pd.DataFrame:
        found = []
        known = pdf[pdf["kind"] == "known"]
        if len(known):
            sent = _unpack(known)
            found.append((sent.docs, sent.places, sent.lengths))
        content = pdf[pdf["kind"] == "content"]
        if len(content):
            firsts, again = first_places(_unpack(content))
            found += [again, *method.decide(firsts)]
        hot = pdf[pdf["kind"] == "windows"]
        if len(hot):
            sent = _unpack(hot.assign(data=b""))
            code = np.frombuffer(b"".join(hot["data"]), np.uint64).reshape(-1, 2)
            later = _later(code, sent.docs, sent.places)
            found.append((sent.docs[later], sent.places[later], sent.lengths[later]))
        d, p, n = (np.concatenate(c) for c in zip(*found))
        # the block of a place is that of its document
        return _pack_home(d, p, n, pdf)

    def _pack_home(d, p, n, pdf):
        blocks = np.concatenate([np.full(len(x) // 8, b) for x, b in zip(pdf["docs"], pdf["block"])])
        ids = np.frombuffer(b"".join(pdf["docs"]), np.int64)
        order = np.argsort(ids, kind="stable")
        home = blocks[order][np.searchsorted(ids[order], d)] if len(d) else np.zeros(0, np.int64)
        rows = []
        for b in np.unique(home):
            m = home == b
            rows.append((int(b), d[m].tobytes(), p[m].tobytes(), n[m].tobytes()))
        return pd.DataFrame(rows, columns=["block", "docs", "places", "lengths"])

    def report(pdf: pd.DataFrame, cuts: pd.DataFrame) -> pd.DataFrame:
        d, p, n = (np.frombuffer(b"".join(cuts[c]), np.int64) for c in ("docs", "places", "lengths"))
        order = np.lexsort((p, d))
        d, p, n = d[order], p[order], n[order]
        ids, whole, numbers = _rows(pdf)
        out = []
        for doc_id, text, number in zip(ids, whole, numbers):
            lo, hi = np.searchsorted(d, [doc_id, doc_id], side="left")[0], np.searchsorted(d, doc_id, side="right")
            places = p[lo:hi]
            mine = (places >> ROW_BITS) == number
            start = places[mine] & ((np.int64(1) << ROW_BITS) - 1)
            out.append((doc_id, *[number][:len(extra)], *method.report(text, start, start + n[lo:hi][mine])))
        return pd.DataFrame(out, columns=["doc_id", *extra, *method.columns])

    asked = text.groupBy("block").applyInPandas(keys, ASKED)
    answers = totals(asked, least=2, short=True)
    sent = text.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(send, SENT)
    cuts = sent.groupBy("shard").applyInPandas(decide, PLACES)
    schema = ", ".join(["doc_id long", *(f"{c} int" for c in extra), *(f"{k} {v}" for k, v in method.columns.items())])
    return with_null_ids(text.groupBy("block").cogroup(cuts.groupBy("block")).applyInPandas(report, schema))


def changed_texts(docs: DataFrame, method: Method, n_blocks: int | None = None) -> DataFrame:
    """`docs` with the same columns and the texts that `method` leaves; rows left without text go.

    `method` reports new_text, null where nothing was cut. n_chars, if there is such a column, follows
    a changed text. Rows that share an id are told apart by the order of their texts, as places are.
    """
    cut = repeats(docs, method, n_blocks, "row").filter("new_text IS NOT NULL")
    cut = cut.groupBy(F.coalesce("doc_id", F.lit(NO_ID)).alias("cut_id")).agg(
        F.map_from_entries(F.collect_list(F.struct("row", "new_text"))).alias("cuts"))
    own = F.struct(*docs.columns).alias("own")
    rows = docs.select(own, F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("cut_id"))
    order = W.partitionBy("cut_id").orderBy(F.coalesce("own.text", F.lit("")).cast("binary"))
    rows = rows.withColumn("row", F.row_number().over(order) - 1).join(cut, "cut_id", "left")
    rows = rows.select("own", F.try_element_at("cuts", "row").alias("new_text"))
    text = F.coalesce("new_text", "own.text")
    changes = {"text": text, "n_chars": F.when(F.col("new_text").isNull(), F.col("own.n_chars"))
               .otherwise(F.length("new_text")).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {"text": text}
    return rows.filter(text != "").select(*[changes.get(c, F.col("own")[c]).alias(c) for c in docs.columns])


def _later(code: np.ndarray, docs: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Rows whose code stands at an earlier place too."""
    order = np.lexsort((places, docs, code[:, 1], code[:, 0]))
    same = (code[order][1:] == code[order][:-1]).all(axis=1)
    return order[1:][same]


def _hot(method: Method, block: int, hot: list, whole: list[bytes], shards: int) -> list[pd.DataFrame]:
    """Windows of segments with very frequent keys, each by a 128-bit hash: the first of a block goes on."""
    docs, places, codes = [], [], []
    for doc_id, place, _, row, a, b in hot:
        one, two = method.windows(whole[row], a, b)
        codes.append(np.stack([one, two], axis=1))
        docs.append(np.full(len(one), doc_id, np.int64))
        places.append(place + np.arange(len(one), dtype=np.int64))
    code, docs, places = np.concatenate(codes), np.concatenate(docs), np.concatenate(places)
    later = np.zeros(len(code), bool)
    later[_later(code, docs, places)] = True
    size = np.full(len(code), method.window_bytes, np.int64)
    out, first = [], np.flatnonzero(~later)
    data = [c.tobytes() for c in code[first]]
    out.append(_pack(block, ((code[first, 0] >> np.uint64(32)) % np.uint64(shards)).astype(np.int64), "windows",
                     Sent(docs[first], places[first], size[first], data)))
    if later.any():
        out.append(_pack(block, np.full(int(later.sum()), block % shards), "known",
                         Sent(docs[later], places[later], size[later], [])))
    return out
