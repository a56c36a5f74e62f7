"""What the operators share: stored tables, blocks of documents, totals of keys over all blocks.

A *block* is the set of documents whose id hashes to one number. Where every document needs a
global figure about its own words, shingles or chunks, the block asks for its distinct keys once:
(block, bucket) blobs of keys go to buckets by hash, each bucket sums, and every block gets back
the keys it asked for. A key that a third of all documents hold is then one entry per block, so no
task gathers more than its bucket's share, and texts stay in their blocks.
"""

from __future__ import annotations

import ctypes
import math
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from linepareto.session import shared_folder

# Text bytes of one block; a task holds a block and its keys.
BLOCK_BYTES = 12_000_000


_kept: dict[str, Callable[[], None]] = {}
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc; others have none


def working_on(operator: str, forget: Callable[[], None] | None = None) -> None:
    """Called where an operator's task begins: empties what other operators left in this Python worker.

    Workers outlive stages, and what one operator remembers would stand beside what the next one does.
    `forget` empties what this operator remembers. What is free by then goes back to the system: the
    allocators keep it, and an executor holds the most that any operator took in each of its workers.
    """
    for other in [name for name in _kept if name != operator]:
        _kept.pop(other)()
    if forget:
        _kept[operator] = forget
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


# Rows that Spark hands to a Python worker at once. Its 10,000 are 20 to 40 MB of texts, which every task holds
# several times over, on both sides.
ROWS_AT_ONCE = 1_000


def in_small_batches(spark: SparkSession) -> None:
    """From now on the session hands whole texts to its Python workers in smaller batches."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= ROWS_AT_ONCE:
        spark.conf.set(name, ROWS_AT_ONCE)


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """`df` written to the shared folder and read again: computed once, safe from lost executors."""
    folder = shared_folder(df.sparkSession, f"llm-{name}")
    df.write.parquet(folder, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


# Stands for a null id inside the operators, so that ids stay whole numbers in arrays.
NO_ID = -(2**63)


def texts(docs: DataFrame, *more: Column) -> DataFrame:
    """doc_id, the whole text as UTF-8 bytes, null as empty, and `more`; other columns are not read.

    A null id is `NO_ID`, below all others; `with_null_ids` brings it back.
    """
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"), *more)


def with_null_ids(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.nullif(c, F.lit(NO_ID)) for c in columns or ("doc_id",)})


def block_count(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> int:
    """Blocks for a table, from the bytes of all its texts; one cheap pass."""
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    return max(1, math.ceil(total / block_bytes))


def block_of(n_blocks: int) -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(n_blocks)).cast("int")


def blocked(docs: DataFrame, n_blocks: int) -> DataFrame:
    """`texts` with its block, one block in one partition."""
    return texts(docs).withColumn("block", block_of(n_blocks)).repartition(n_blocks, "block")


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finalizer on uint64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


ASKED = "block int, bucket int, keys binary, counts binary"
ANSWERED = "block int, bucket int, keys binary, totals binary"


def ask(block: int, keys: np.ndarray, counts: np.ndarray, buckets: int, short: bool) -> pd.DataFrame:
    """Rows ASKED for the distinct uint64 keys of a block.

    `short` keeps 32 bits of a key beside its bucket: for totals that only rank or preselect, where
    the odd shared number costs work, not results.
    """
    bucket = ((keys >> np.uint64(32)) % np.uint64(buckets)).astype(np.uint16 if buckets <= 65_536 else np.int64)
    order = np.argsort(bucket, kind="stable")
    keys, counts, bucket = keys[order], counts[order].astype("<u4"), bucket[order]
    keys = keys.astype("<u4" if short else "<u8")
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.zeros(0, int)
    ends = np.r_[starts[1:], len(bucket)] if len(bucket) else starts
    return pd.DataFrame({"block": np.full(len(starts), block, np.int32), "bucket": bucket[starts].astype(np.int32),
                         "keys": [keys[a:b].tobytes() for a, b in zip(starts, ends)],
                         "counts": [counts[a:b].tobytes() for a, b in zip(starts, ends)]})


def totals(asked: DataFrame, least: int, short: bool, summary: bool = False) -> DataFrame:
    """ANSWERED: for every block those of its keys whose total over all blocks is `least` or more.

    With `summary`, block -1 gets the number of such keys and the sum of their totals per bucket (int64).
    """
    kind = "<u4" if short else "<u8"

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [np.frombuffer(k, kind) for k in pdf["keys"]]
        all_keys = np.concatenate(parts)
        numbers = np.concatenate([np.frombuffer(c, "<u4") for c in pdf["counts"]])
        distinct, at = np.unique(all_keys, return_inverse=True)
        total = np.bincount(at, weights=numbers, minlength=len(distinct))[at]
        keep = total >= least
        total = np.minimum(total, 2**32 - 1).astype("<u4")
        ends = np.cumsum([len(p) for p in parts])
        out = []
        if summary:
            sums = np.bincount(at, weights=numbers, minlength=len(distinct))
            sums = sums[sums >= least]
            out.append((-1, pdf["bucket"].iloc[0], np.int64(len(sums)).tobytes(), np.int64(sums.sum()).tobytes()))
        for block, bucket, a, b in zip(pdf["block"], pdf["bucket"], np.r_[0, ends[:-1]], ends):
            if (k := keep[a:b]).any():
                out.append((block, bucket, all_keys[a:b][k].tobytes(), total[a:b][k].tobytes()))
        return pd.DataFrame(out, columns=["block", "bucket", "keys", "totals"])

    return asked.groupBy("bucket").applyInPandas(add, ANSWERED)


class Totals:
    """The answers of one block, looked up by key."""

    def __init__(self, pdf: pd.DataFrame, buckets: int, short: bool):
        self.buckets, self.short = np.uint64(buckets), short
        kind = "<u4" if short else "<u8"
        keys = [np.frombuffer(k, kind).astype(np.uint64) for k in pdf["keys"]]
        if short:
            keys = [k | (np.uint64(b) << np.uint64(32)) for k, b in zip(keys, pdf["bucket"])]
        keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        numbers = [np.frombuffer(t, "<u4") for t in pdf["totals"]]
        numbers = np.concatenate(numbers) if numbers else np.zeros(0, np.uint32)
        order = np.argsort(keys)
        self.keys = np.r_[keys[order], np.uint64(2**64 - 1)]
        self.numbers = np.r_[numbers[order], np.uint32(0)]

    def of(self, keys: np.ndarray) -> np.ndarray:
        """Total of every key; 0 where there was no answer."""
        if self.short:
            keys = (keys & np.uint64(0xFFFFFFFF)) | (((keys >> np.uint64(32)) % self.buckets) << np.uint64(32))
        at = np.searchsorted(self.keys[:-1], keys)
        return np.where(self.keys[at] == keys, self.numbers[at], 0)


def in_training(modulus: int, left_out: int) -> Column:
    """Whether crc32 of the id as text falls on another remainder than `left_out`; a null id as ''."""
    text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % modulus != left_out
