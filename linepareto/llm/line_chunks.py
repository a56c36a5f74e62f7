"""Repeated runs of lines, removed by pairs of lines, or by content-defined chunks.

`repeated_runs` compares every two neighbouring lines with words, overlapping, so a run of two or more
lines that an earlier place holds is found wherever it begins and ends. The chunks below find the runs
that hold a whole chunk only; the pipeline cuts by them.

A document is cut where a rolling hash over the last two lines' hashes says so, so the cuts follow the
lines and not their numbers: text put in front moves no cut behind the next one. Chunks of two or
more lines with words that an earlier place of the corpus holds too, byte for byte, are removed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash
from pyspark.sql import DataFrame

from linepareto.llm.repeats import Method, Segments, changed_texts, repeats

# One in so many places is a cut.
CUT_EVERY = 3
LEAST_LINES = 2
_STEP = 0x9E3779B97F4A7C15
_MASK = 2**64 - 1


def chunks(text: bytes) -> list[tuple[int, int, int]]:
    """(first byte, end, lines with words) of all chunks; between two stands one line feed."""
    out, start, at, previous, lines, filled = [], 0, 0, 0, 0, 0
    for line in text.split(b"\n"):
        own = xxhash.xxh3_64_intdigest(line)
        rolling = (previous * _STEP + own) & _MASK
        previous, lines, filled = own, lines + 1, filled + (not line.isspace() and line != b"")
        end = at + len(line)
        at = end + 1
        if lines >= LEAST_LINES and (rolling ^ rolling >> 32) % CUT_EVERY == 0:
            out.append((start, end, filled))
            start, lines, filled = at, 0, 0
    if lines:
        out.append((start, len(text), filled))
    return out


def segments(batch: list[bytes]) -> Segments:
    """The chunks that can be removed."""
    found = [(k, a, b, xxhash.xxh3_64_intdigest(text[a:b])) for k, text in enumerate(batch)
             for a, b, filled in chunks(text) if filled >= LEAST_LINES]
    text, start, end, key = zip(*found) if found else ((), (), (), ())
    return Segments(*(np.array(c, np.int64) for c in (text, start, end)), np.array(key, np.uint64), np.ones(len(found), np.int64))


def nothing_more(firsts):
    """Equal contents are all there is to decide."""
    return iter(())


def _kept(text: bytes, starts: np.ndarray) -> tuple[bytes, int, int]:
    """The text without the chunks that start there, its lines, and the lines removed."""
    gone = set(starts.tolist())
    if not gone:
        return text, text.count(b"\n") + 1 if text else 0, 0
    parts = [(text[a:b], a in gone) for a, b, _ in chunks(text)]
    return (b"\n".join([p for p, cut in parts if not cut]), text.count(b"\n") + 1,
            sum(p.count(b"\n") + 1 for p, cut in parts if cut))


def _whole(text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple:
    kept, lines, removed = _kept(text, starts)
    return lines, removed, kept.decode()


def _digest(text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple:
    kept, lines, removed = _kept(text, starts)
    return lines, removed, hashlib.sha256(kept).hexdigest()


def without_repeated_lines(docs: DataFrame, n_blocks: int | None = None) -> DataFrame:
    """(doc_id, n_lines, n_removed, kept_text) of every row.

    The earliest place of a chunk stays: smallest doc_id (null below all), earliest in the document;
    rows that share an id go by their text. Null text is empty and has no line; single lines and blank
    ones are never removed. An empty table gives no rows.
    """
    columns = {"n_lines": "long", "n_removed": "long", "kept_text": "string"}
    return repeats(docs, Method(segments, nothing_more, _whole, columns), n_blocks)


def digests(docs: DataFrame, n_blocks: int | None = None) -> DataFrame:
    """`without_repeated_lines` with the SHA-256 of the text that is left."""
    columns = {"n_lines": "long", "n_removed": "long", "kept_sha256": "string"}
    return repeats(docs, Method(segments, nothing_more, _digest, columns), n_blocks)


def _text(text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple:
    return (_kept(text, starts)[0].decode() if len(starts) else None),


def cut_documents(docs: DataFrame, n_blocks: int | None = None) -> DataFrame:
    """Rows of `docs` with the texts that are left, without those left empty; see `changed_texts`."""
    return changed_texts(docs, Method(segments, nothing_more, _text, {"new_text": "string"}), n_blocks)


def pairs(text: bytes) -> list[tuple[int, int]]:
    """(first byte, end) of every line with words and the next such line, with blank lines between."""
    out, at, previous = [], 0, -1
    for line in text.split(b"\n"):
        if line and not line.isspace():
            if previous >= 0:
                out.append((previous, at + len(line)))
            previous = at
        at += len(line) + 1
    return out


def pair_segments(batch: list[bytes]) -> Segments:
    found = [(k, a, b, xxhash.xxh3_64_intdigest(text[a:b])) for k, text in enumerate(batch) for a, b in pairs(text)]
    text, start, end, key = zip(*found) if found else ((), (), (), ())
    return Segments(*(np.array(c, np.int64) for c in (text, start, end)), np.array(key, np.uint64), np.ones(len(found), np.int64))


def _run_digest(text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple:
    """Lines, lines inside the given pairs, and the SHA-256 of the others."""
    lines = text.split(b"\n") if text else []
    if not len(starts):
        return len(lines), 0, hashlib.sha256(text).hexdigest()
    first = np.cumsum([0, *(len(x) + 1 for x in lines[:-1])])
    change = np.zeros(len(lines) + 1, np.int64)
    np.add.at(change, np.searchsorted(first, starts), 1)
    np.add.at(change, np.searchsorted(first, ends), -1)  # the first line behind
    gone = np.cumsum(change[:-1]) > 0
    return len(lines), int(gone.sum()), hashlib.sha256(b"\n".join([x for x, g in zip(lines, gone.tolist()) if not g])).hexdigest()


def repeated_runs(docs: DataFrame, n_blocks: int | None = None) -> DataFrame:
    """(doc_id, n_lines, n_removed, kept_sha256) of every row, without all runs an earlier place holds.

    A line goes when it and a neighbour stand next to each other, byte for byte, at an earlier place too
    (order as in `without_repeated_lines`); what goes stays as a line at some earlier place. Null text is
    empty and has no line; single lines, and blank ones outside a pair, are never removed.
    """
    columns = {"n_lines": "long", "n_removed": "long", "kept_sha256": "string"}
    return repeats(docs, Method(pair_segments, nothing_more, _run_digest, columns), n_blocks)
