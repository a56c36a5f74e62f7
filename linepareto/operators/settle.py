"""Intermediate tables of known size, and scans narrowed by them."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, Observation, functions as F

from linepareto.session import shared_folder

# Key sets up to this many rows are sent to every task.
MAX_BROADCAST_KEYS = 500_000
# Bits per key of a key set's filter, and the most words of 64 bits it has: what is sent to a task is bounded.
FILTER_BITS, MAX_FILTER_WORDS = 16, 1 << 22


class Settled(NamedTuple):
    """A table in the shared folder."""

    df: DataFrame
    size: int  # its number of rows, or more


def settle(df: DataFrame, purpose: str) -> Settled:
    """Write `df` to the shared folder and read it back; its rows are counted on the way.

    It is computed once, survives lost executors, and Spark knows its true size from there on.
    """
    folder = shared_folder(df.sparkSession, purpose)
    counted = Observation()
    df.observe(counted, F.count(F.lit(1)).alias("size")).write.parquet(folder)
    return Settled(df.sparkSession.read.schema(df.schema).parquet(folder), counted.get["size"])


def together(*calls: Callable[[], Any]) -> list:
    """Results of calls that do not need each other: the jobs they run while they build are run side by side."""
    with ThreadPoolExecutor(len(calls)) as pool:
        return [job.result() for job in [pool.submit(copy_context().run, call) for call in calls]]


def dealt_out(rows: DataFrame, key: str) -> DataFrame:
    """`rows` by `key` over all cores, if they are read in fewer pieces than there are; else as they are.

    Work per row that is worth more than moving the row then runs on all cores. A table of that few
    pieces is small; a larger one is never shuffled for it.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores, key) if rows.rdd.getNumPartitions() < cores else rows


def narrow(big: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The rows of `big` whose key is in `keys`, which must be known to be few.

    The scan of `big` is filtered where it is read, without a shuffle.
    """
    return big.join(F.broadcast(keys.select(key).distinct()), key, "left_semi")


def thin(big: DataFrame, key: str, keys: DataFrame, n_keys: int) -> DataFrame:
    """The rows of `big` whose key may be in `keys`: all that are, and a few others.

    For key sets too large to be sent whole. Their hashes set bits of a Bloom filter, and the scan of
    `big` is filtered by it where it is read, without a shuffle. Of keys that are not there one in
    sixteen passes; beyond 16 million keys more of them do.
    """
    words = min(MAX_FILTER_WORDS, max(1, n_keys * FILTER_BITS // 64))

    def bit(name: str, of: str) -> Column:
        place = F.pmod(F.xxhash64(name), F.lit(words * 64))
        return F.floor(place / 64) if of == "word" else F.pmod(place, F.lit(64)).cast("int")

    marks = keys.filter(F.col(key).isNotNull()).groupBy(bit(key, "word").alias("_word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit(key, "bit"))).alias("_bits"))
    hit = F.call_function("shiftright", F.col("_bits"), bit(key, "bit")).bitwiseAND(F.lit(1).cast("long")) == 1
    return big.join(F.broadcast(marks), (bit(key, "word") == F.col("_word")) & hit, "left_semi")
