"""Byte-level BPE encoding and decoding.

Every match of the public pattern is encoded by itself: a segment tree over its byte positions keeps
in each node the smallest (rank, position) of the pairs below, so the root is the leftmost minimum.
A merge changes three leaves, the pair's own and those of its live neighbours, and their paths to the
root. The trees of many matches stand side by side in one array and take their merges together.
"""

from __future__ import annotations

import base64
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from linepareto.llm.pieces import Pieces, matches

_NONE = np.int64(2**62)
_AT = np.int64(32)  # bits of a position below its rank
# Leaves of the trees that are merged together.
_LEAVES = 1 << 19


class Ranks:
    """A vocabulary of byte strings by rank: pair table for encoding, byte strings for decoding."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.pattern = regex.compile(pattern)
        self.bytes = {rank: token for token, rank in self.ranks.items()}
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        keys, ranks = [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    ranks.append(rank)
        order = np.argsort(keys)
        self.pairs = np.r_[np.array(keys, np.int64)[order], _NONE]
        self.pair_ranks = np.r_[np.array(ranks, np.int64)[order], _NONE]

    def rank(self, a: np.ndarray, b: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Leaf values of the pairs (a, b); none where an id is negative or the pair is not in the table."""
        key = a << np.int64(32) | b
        at = np.searchsorted(self.pairs[:-1], key)
        found = (self.pairs[at] == key) & (a >= 0) & (b >= 0)
        return np.where(found, self.pair_ranks[at] << _AT | position, _NONE)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of byte strings of at least two bytes, all of one padded length."""
        n, size = len(words), 1
        while size < max(map(len, words)):
            size *= 2
        lengths = np.array([len(w) for w in words])
        raw = np.frombuffer(b"".join(w.ljust(size, b"\0") for w in words), np.uint8).reshape(n, size)
        at = np.arange(size)
        ids = np.full((n, size + 1), -1, np.int64)
        ids[:, :size] = np.where(at < lengths[:, None], self.single[raw], -1)
        after = np.minimum(np.tile(np.arange(1, size + 2), (n, 1)), size)
        before = np.tile(np.arange(-1, size), (n, 1))
        tree = np.full((n, 2 * size), _NONE, np.int64)
        tree[:, size:] = self.rank(ids[:, :-1], ids[:, 1:], at.astype(np.int64))
        level = size
        while level > 1:
            tree[:, level // 2:level] = np.minimum(tree[:, level:2 * level:2], tree[:, level + 1:2 * level:2])
            level //= 2
        live = np.flatnonzero(tree[:, 1] < _NONE)
        while len(live):
            best = tree[live, 1]
            here = best & np.int64(2**32 - 1)
            gone = after[live, here]
            then = after[live, gone]
            ids[live, here] = best >> _AT
            ids[live, gone] = -1
            after[live, here] = then
            before[live, then] = here
            prior = before[live, here]
            tree[live, size + here] = self.rank(ids[live, here], ids[live, then], here)
            tree[live, size + gone] = _NONE
            has = prior >= 0
            rows, left = live[has], prior[has]
            tree[rows, size + left] = self.rank(ids[rows, left], ids[rows, here[has]], left)
            for row, leaf in ((live, here), (live, gone), (rows, left)):
                node = (size + leaf) >> 1
                for _ in range(size.bit_length() - 1):
                    tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])
                    node = node >> 1
            live = live[tree[live, 1] < _NONE]
        kept = ids >= 0
        flat, ends = ids[kept].astype("<u4").tobytes(), np.cumsum(4 * kept.sum(axis=1)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def encode_words(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Packed ids of distinct matches of the pattern."""
        out, sized = {}, {}
        for word in words:
            rank = self.ranks.get(word)
            if rank is not None:
                out[word] = pack("<I", rank)
            else:
                sized.setdefault((len(word) - 1).bit_length(), []).append(word)
        for bits, group in sized.items():
            step = max(1, _LEAVES >> bits)
            for k in range(0, len(group), step):
                out.update(zip(group[k:k + step], self.merge(group[k:k + step])))
        return out

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        find = self.pattern.findall
        split = [[m.encode() for m in matches(p, find)] for p in pieces]
        ids = self.encode_words(list({w for words in split for w in words}))
        return [ids[words[0]] if len(words) == 1 else b"".join([ids[w] for w in words]) for words in split]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_loaded: dict = {}


def _ranks(path: str, pattern: str) -> tuple[Ranks, Pieces]:
    """One per Python worker."""
    if (path, pattern) not in _loaded:
        ranks = Ranks(path, pattern)
        _loaded[path, pattern] = ranks, Pieces(ranks.encode_pieces)
    return _loaded[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids): ids of every whole text as little-endian unsigned 32-bit integers.

    Null text is empty and has no ids; repeated rows stay; an empty table gives no rows. Texts are cut
    only between single spaces, where no match of the pattern reaches across (see `pieces`).
    """
    def run(batches):
        _, cache = _ranks(path, pattern)
        for batch in batches:
            for part in range(0, batch.num_rows, 500):
                some = batch.slice(part, 500)
                ids = cache.ids(some.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return text.mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids, bytes): the byte strings of the ids, concatenated. Null ids count as none."""
    def run(batches):
        ranks, _ = _ranks(path, pattern)
        for batch in batches:
            for part in range(0, batch.num_rows, 500):
                some = batch.slice(part, 500)
                ids = some.column("ids")
                text = pa.array([ranks.decode(i or b"") for i in ids.to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([some.column("doc_id"), ids, text], names=["doc_id", "ids", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, bytes binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """One digest per row: n_tokens, ids_sha256 and decoded_sha256 of `encode` and `decode`."""
    return decode(encode(docs, path, pattern), path, pattern).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))
