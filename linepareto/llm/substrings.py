"""Repeated byte strings of a minimum length, anywhere in the corpus.

All windows of the minimum length with the same smallest 32-byte hash meet in one shard (a window's
smallest hash depends on its bytes alone). There the distinct contents are one text with separators;
its Burrows-Wheeler transform gives the common prefixes of neighbouring suffixes in increasing order:
intervals of strings of length l are extended backwards by one byte, and an interval's end that is
reached first at length l has the common prefix l. The search stops at the minimum length; ends
not reached by then stand between suffixes that share it.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame

from linepareto.llm.common import mix
from linepareto.llm.repeats import Method, Segments, Sent, changed_texts, repeats

MIN_BYTES = 100
GRAM = 32
# Totals above which a key's windows are decided by their own hashes, spread over all shards.
HOT = 50_000
_BASE = 0x9E3779B97F4A7C15
_OTHER = 0xD6E8FEB86659FD93


def _hashes(data: np.ndarray, size: int, base: int) -> np.ndarray:
    """Polynomial hashes of all windows of `size` bytes, by doubling."""
    doubled, have, out, out_size = data.astype(np.uint64) + np.uint64(1), 1, None, 0
    while True:
        if size & have:
            if out is None:
                out, out_size = doubled, have
            else:  # the longer window after the shorter one
                n = len(data) - out_size - have + 1
                out = out[:n] * np.uint64(pow(base, have, 2**64)) + doubled[out_size:out_size + n]
                out_size += have
        if have * 2 > size:
            return mix(out)
        n = len(data) - 2 * have + 1
        doubled = doubled[:n] * np.uint64(pow(base, have, 2**64)) + doubled[have:have + n]
        have *= 2


def segments(batch: list[bytes], size: int = MIN_BYTES, gram: int = GRAM) -> Segments:
    """Runs of windows whose smallest gram hash is the same, as the bytes they cover."""
    data = np.frombuffer(b"".join(batch), np.uint8)
    lengths = np.array([len(t) for t in batch], np.int64)
    if len(data) < size:
        none = np.zeros(0, np.int64)
        return Segments(none, none, none, none.astype(np.uint64), none)
    low, span, have = _hashes(data, gram, _BASE), size - gram + 1, 1
    spot = np.arange(len(low), dtype=np.int32)  # leftmost place of the smallest hash
    while have < span:
        step = min(have, span - have)
        right = low[step:] < low[:-step]
        low, spot = np.where(right, low[step:], low[:-step]), np.where(right, spot[step:], spot[:-step])
        have += step
    ends = np.cumsum(lengths)
    text = np.repeat(np.arange(len(batch)), lengths)[:len(low)]
    at = np.flatnonzero(ends[text] - np.arange(len(low)) >= size)
    if not len(at):
        return Segments(at, at, at, at.astype(np.uint64), at)
    text, low, spot = text[at], low[at], spot[at]
    new = np.flatnonzero(np.r_[True, (low[1:] != low[:-1]) | (text[1:] != text[:-1])])
    begin = (ends - lengths)[text[new]]
    last = np.r_[new[1:], len(at)] - 1
    return Segments(text[new], at[new] - begin, at[last] + size - begin, low[new], 1 + (spot[last] != spot[new]))


def windows(text: bytes, start: int, end: int, size: int = MIN_BYTES) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(text[start:end], np.uint8)
    return _hashes(data, size, _BASE), _hashes(data, size, _OTHER)


def _sorted(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Order and sorted keys of at most `bits` bits; packed with their places where both fit one number."""
    at = max(1, (len(key) - 1).bit_length())
    if bits + at > 63:
        order = np.argsort(key)
        return order, key[order]
    both = key << at | np.arange(len(key))
    both.sort()
    return both & ((1 << at) - 1), both >> at


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of a cyclic text in the order of their first `depth` symbols, by prefix doubling."""
    n, (used, dense) = len(symbols), np.unique(symbols, return_inverse=True)
    width, place = max(1, (len(used) - 1).bit_length()), max(1, (n - 1).bit_length())
    known = max(1, (63 - place) // width)  # so many symbols make the first key
    key, bits = np.zeros(n, np.int64), known * width
    for k in range(known):
        key = key << width | np.roll(dense, -k)
    order, ranked = _sorted(key, bits)
    new = np.r_[True, ranked[1:] != ranked[:-1]]  # first of the suffixes that are equal so far, whose place is their rank
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    while known < depth:
        at = np.flatnonzero(~(new & np.r_[new[1:], True]))  # all others have their place
        if not len(at):
            break
        some = order[at]
        by, ranked = _sorted(rank[some] << place | rank[(some + known) % n], 2 * place)
        order[at] = some = some[by]
        new[at] = first = np.r_[True, ranked[1:] != ranked[:-1]]
        rank[some] = np.maximum.accumulate(np.where(first, at, 0))
        known *= 2
    return order


def shared_prefixes(symbols: np.ndarray, order: np.ndarray, least: int) -> np.ndarray:
    """Whether each suffix shares `least` symbols with the one before it in `order`."""
    n = len(symbols)
    transform = symbols[order - 1]
    small = np.int32 if n < 2**31 else np.int64
    back = np.empty(n, small)  # where the suffix one symbol longer stands
    back[np.argsort(transform, kind="stable")] = np.arange(n, dtype=small)
    unknown = np.ones(n + 1, bool)
    unknown[[0, n]] = False
    begins, owners, marked = symbols[order], np.empty(n, small), np.zeros(n, bool)
    low, high = np.array([0]), np.array([n])
    for _ in range(least):
        width = high - low
        first = np.cumsum(width) - width
        owner = np.repeat(np.arange(len(low), dtype=small), width)
        place = back[np.arange(len(owner)) + np.repeat(low - first, width)]
        owners[place], marked[place] = owner, True
        if len(place) * 64 > n:
            place = np.flatnonzero(marked)
        else:
            place.sort()
        marked[place] = False
        owner, symbol = owners[place], begins[place]
        new = np.r_[True, (place[1:] != place[:-1] + 1) | (owner[1:] != owner[:-1]) | (symbol[1:] != symbol[:-1])]
        low = place[new]
        high = place[np.r_[np.flatnonzero(new)[1:], len(place)] - 1] + 1
        fresh = unknown[high]
        low, high = low[fresh], high[fresh]
        unknown[high] = False
        if not len(low):
            break
    return unknown[:n]


def decide(firsts: Sent, size: int = MIN_BYTES):
    """Places of the distinct contents' windows that stand at an earlier place too."""
    if len(firsts.data) < 2 and not any(len(d) > size for d in firsts.data):
        return
    text = np.frombuffer(b"".join(firsts.data), np.uint8).astype(np.int16) + 1
    lengths = firsts.lengths
    owner = np.repeat(np.arange(len(lengths)), lengths + 1)
    begin = np.cumsum(lengths + 1) - (lengths + 1)
    offset = np.arange(len(owner)) - begin[owner]
    symbols = np.zeros(len(owner), np.int16)
    symbols[offset < lengths[owner]] = text
    order = suffix_order(symbols, size + 1)
    same = shared_prefixes(symbols, order, size)
    member = same | np.r_[same[1:], False]
    group = np.cumsum(~same)[member]
    at = order[member]
    whole = offset[at] + size <= lengths[owner[at]]
    group, at = group[whole], at[whole]
    docs, places = firsts.docs[owner[at]], firsts.places[owner[at]] + offset[at]
    by = np.lexsort((places, docs, group))
    later = by[1:][group[by][1:] == group[by][:-1]]
    at = np.sort(at[later])
    if len(at):  # runs of windows become one place
        new = np.r_[True, np.diff(at) != 1]
        starts, ends = at[new], at[np.r_[np.flatnonzero(new)[1:], len(at)] - 1]
        yield firsts.docs[owner[starts]], firsts.places[owner[starts]] + offset[starts], ends - starts + size


def report(text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[int, list[int], list[int], bytes]:
    """Bytes, the maximal removed runs and what is left."""
    order = np.argsort(starts)
    starts, reach = starts[order], np.maximum.accumulate(ends[order]) if len(ends) else ends
    new = np.r_[True, starts[1:] > reach[:-1]] if len(starts) else np.zeros(0, bool)
    first = starts[new].tolist()
    last = reach[np.r_[np.flatnonzero(new)[1:], len(starts)] - 1].tolist() if len(starts) else []
    kept = b"".join([text[a:b] for a, b in zip([0, *last], [*first, len(text)])])
    return len(text), first, last, kept


def _digest(text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple:
    size, first, last, kept = report(text, starts, ends)
    return size, sum(last) - sum(first), len(first), hashlib.sha256(kept).hexdigest()


_STEPS = dict(segments=segments, decide=decide, hot=HOT, windows=windows, window_bytes=MIN_BYTES)


def repeated_substrings(docs: DataFrame, n_blocks: int | None = None) -> DataFrame:
    """(doc_id, n_bytes, starts, ends, kept): removed byte runs and remaining bytes of every row.

    A byte goes if a 100-byte string over it also starts at an earlier place of the table. Null text
    is empty; shorter texts keep all; of repeated rows one stays; an empty table gives no rows.
    """
    columns = {"n_bytes": "long", "starts": "array<long>", "ends": "array<long>", "kept": "binary"}
    return repeats(docs, Method(report=report, columns=columns, **_STEPS), n_blocks)


def digests(docs: DataFrame, n_blocks: int | None = None) -> DataFrame:
    """`repeated_substrings` as figures: n_bytes, n_removed, n_spans, kept_sha256."""
    columns = {"n_bytes": "long", "n_removed": "long", "n_spans": "long", "kept_sha256": "string"}
    return repeats(docs, Method(report=_digest, columns=columns, **_STEPS), n_blocks)


def _text(text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple:
    """What is left as text; a character cut in the middle goes."""
    return (report(text, starts, ends)[3].decode(errors="ignore") if len(starts) else None),


def cut_documents(docs: DataFrame, n_blocks: int | None = None) -> DataFrame:
    """Rows of `docs` with the texts that are left, without those left empty; see `changed_texts`."""
    return changed_texts(docs, Method(report=_text, columns={"new_text": "string"}, **_STEPS), n_blocks)
