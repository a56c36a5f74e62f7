"""Best-fit packing of documents into sequences of a fixed number of tokens.

The plan is made over the histogram of piece lengths (at most `capacity` rows, whatever the number
of documents); pieces then take the planned slots by a join on their rank within their length.
"""

from __future__ import annotations

import json
import zlib
from array import array
from struct import pack
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window as W, functions as F

from linepareto.llm.common import stored, working_on
from linepareto.llm.pieces import PATTERN, Pieces, matches

CAPACITY = 1024
END = 2
# Pieces a worker remembers at most, twice over.
REMEMBERED = 800_000
# Rows of one length that are ranked in one task.
RANKED_TOGETHER = 5_000

_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
_encoders: dict = {}


class Slots(NamedTuple):
    """`count` pieces of one length from rank `first` on, `each` to a sequence from `sequence` on."""

    length: int
    first: int
    count: int
    sequence: int
    each: int
    offset: int


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Slots]:
    """Best-fit decreasing over counts: the longest pieces first, each into the fullest sequence it fits.

    Sequences with equal free room are handled together, so the work depends on the number of lengths.
    """
    room: dict[int, list[tuple[int, int]]] = {}  # free tokens: runs of (first sequence, number)
    out, opened = [], 0
    for length in sorted(histogram, reverse=True):
        left, first = histogram[length], 0
        while left:
            free = min((r for r in room if r >= length), default=0)
            if free:
                sequence, n = room[free].pop()
                if not room[free]:
                    del room[free]
            else:
                free, n = capacity, -(-left // (capacity // length))
                sequence, opened = opened, opened + n
            most = free // length
            for each, filled in ((most, min(n, left // most)), (left % most, 1)):
                filled = min(filled, n)
                if not each or not filled or left < each:
                    continue
                out.append(Slots(length, first, each * filled, sequence, each, capacity - free))
                if rest := free - each * length:
                    room.setdefault(rest, []).append((sequence, filled))
                first, left, sequence, n = first + each * filled, left - each * filled, sequence + filled, n - filled
            if n:
                room.setdefault(free, []).append((sequence, n))
    return out


def _byte_letters() -> dict[int, str]:
    """The printable letter that a byte-level vocabulary writes for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


def _encoder(path: str):
    """One per Python worker: its cache serves all tasks."""
    if path not in _encoders:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        settings = json.loads(tokenizer.to_str())
        first = settings["pre_tokenizer"] or {}
        plain = (settings["normalizer"] is None and first.get("type") == "ByteLevel" and first.get("use_regex")
                 and not first["add_prefix_space"])
        specials = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        find, letters, tokens = regex.compile(PATTERN).findall, _byte_letters(), tokenizer.model.tokenize

        def written(match: str) -> str:
            """The match in the vocabulary's letters; of printable ASCII only the space has another one."""
            if match.isascii() and match.isprintable():
                return match.replace(" ", letters[32])
            return match.encode().decode("latin-1").translate(letters)

        def encode(pieces: list[str]) -> list[bytes]:
            """The library's own model on each match; its whole pipeline costs twice as much per piece."""
            split = [matches(p, find) for p in pieces]
            ids = {}
            for match in {m for found in split for m in found}:
                ids[match] = array("I", [t.id for t in tokens(written(match))]).tobytes()
            return [ids[found[0]] if len(found) == 1 else b"".join([ids[m] for m in found]) for found in split]

        def whole(text: str) -> bytes:
            ids = tokenizer.encode(text, add_special_tokens=False).ids
            return pack(f"<{len(ids)}I", *ids)

        cache = Pieces(encode, REMEMBERED)

        def encode_texts(texts: list[str]) -> list[bytes]:
            # special strings may reach across spaces; other pre-tokenizers may cut elsewhere
            odd = {i for i, t in enumerate(texts) if not plain or any(s in t for s in specials)}
            codes = cache.ids([t for i, t in enumerate(texts) if i not in odd])
            for i in sorted(odd):
                codes.insert(i, whole(texts[i]))
            return codes

        _encoders[path] = encode_texts
    return _encoders[path]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end: int = END,
           with_ids: bool = False) -> DataFrame:
    """Tokens of every document and an end id, cut into pieces: (doc_id, piece, start, length, ids_crc32[, ids]).

    Only documents longer than `capacity` are cut; their first piece takes what is over.
    """
    def tokenize(batches):
        working_on("packing", _encoders.clear)
        encode = _encoder(tokenizer_path)
        last = pack("<I", end)
        for batch in batches:
            for part in range(0, batch.num_rows, 1000):
                some = batch.slice(part, 1000)
                codes = encode(some.column("text").to_pylist())
                rows: list[list] = [[], [], [], [], [], []]
                for doc_id, ids in zip(some.column("doc_id").to_pylist(), codes):
                    ids, n = memoryview(ids + last), len(ids) // 4 + 1
                    starts = [0, *range(n % capacity or capacity, n, capacity)] if n > capacity else [0]
                    for k, (a, b) in enumerate(zip(starts, [*starts[1:], n])):
                        for column, value in zip(rows, (doc_id, k, a, b - a, zlib.crc32(ids[4 * a:4 * b]),
                                                        ids[4 * a:4 * b].cast("I").tolist() if with_ids else None)):
                            column.append(value)
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)][:6 if with_ids else 5],
                                                 names=names[:6 if with_ids else 5])

    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return text.mapInArrow(tokenize, _SCHEMA + (", ids array<int>" if with_ids else ""))


def place(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`cut` (pieces with doc_id, piece, length) with sequence_id and offset.

    Ranks within a length come from two levels, so a length that a third of all pieces have is
    ranked in many tasks. The plan has at most a few rows per length and is broadcast.
    """
    spark = cut.sparkSession
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    slots = spark.createDataFrame(plan(histogram, capacity),
                                  "length long, first long, count long, sequence long, each long, at long")
    groups = -(-max(histogram.values(), default=1) // RANKED_TOGETHER)
    grouped = cut.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)))
    sizes = grouped.groupBy("length", "part").count()
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    within = W.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (grouped.withColumn("rank", F.row_number().over(within) - 1).join(offsets, ["length", "part"])
              .withColumn("rank", F.col("rank") + F.col("before")))
    k = F.col("rank") - F.col("first")
    taken = ranked.join(F.broadcast(slots), (ranked["length"] == slots["length"]) & (k >= 0) & (k < F.col("count")))
    return taken.select(*[cut[c] for c in cut.columns], (F.col("sequence") + F.floor(k / F.col("each"))).alias("sequence_id"),
                        (F.col("at") + k % F.col("each") * cut["length"]).alias("offset"))


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end: int = END,
                   with_ids: bool = False) -> DataFrame:
    """All documents in sequences of at most `capacity` tokens, one row per piece.

    Null text is empty: its piece holds the end id alone. Rows that repeat a document are packed each.
    An empty table gives no rows. Columns besides doc_id and text are not read.
    """
    return place(stored(pieces(docs, tokenizer_path, capacity, end, with_ids), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of packed pieces with their ids; a group holds at most `capacity` tokens."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
