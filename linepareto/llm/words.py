"""Words and word shingles as numbers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

from linepareto.llm.common import mix

SHINGLE = 5
_STEP = np.uint64(0x9E3779B97F4A7C15)
# Words a worker remembers; more are hashed again.
REMEMBERED = 150_000
# Text bytes whose shingles are computed together.
TOGETHER = 1_000_000
# Bytes of a word that are hashed with those of all others, eight at a time; a longer word is hashed alone.
TOGETHER_IN_WORD = 64
_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_FIRST_BYTES = np.array([2 ** (8 * k) - 1 for k in range(9)], np.uint64)


class Remembered(dict):
    """Hash of a word's bytes, computed when first asked for."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = Remembered()


def forget() -> None:
    _hashes.clear()


def split(text: bytes) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case (bytes methods touch nothing else)."""
    return text.lower().split()


def numbers(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def located(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The texts in lower case behind each other, start and length of every word in them, and the number of words of each."""
    data = b"\n".join([*texts, bytes(8)]).lower()
    gaps = np.flatnonzero(_SPACE[np.frombuffer(data, np.uint8)])
    before = np.r_[-1, gaps[:-1]]
    length = gaps - before - 1
    word = length > 0
    start, length = before[word] + 1, length[word]
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    return data, start, length, np.diff(np.searchsorted(start, ends), prepend=0)


def hashed(data: bytes, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Hashes of the words that `located` found."""
    eight = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))  # those that begin at each byte
    out = mix(length.astype(np.uint64) * _STEP + (eight[start] & _FIRST_BYTES[np.minimum(length, 8)]))
    rest = np.flatnonzero((length > 8) & (length <= TOGETHER_IN_WORD))
    for done in range(8, TOGETHER_IN_WORD, 8):
        left = length[rest] - done
        out[rest] = mix(out[rest] * _STEP + (eight[start[rest] + done] & _FIRST_BYTES[np.minimum(left, 8)]))
        rest = rest[left > 8]
    for k in np.flatnonzero(length > TOGETHER_IN_WORD).tolist():
        out[k] = xxhash.xxh3_64_intdigest(data[start[k]:start[k] + length[k]])
    return out


def hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, one behind the other, and the number of words of each."""
    data, start, length, n = located(texts)
    return hashed(data, start, length), n


def shingles(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingles; a shorter text is one shingle, one without words has none."""
    h, _ = hashes([text])
    n = max(len(h) - size + 1, min(len(h), 1))
    out = np.full(n, min(len(h), size), np.uint64)
    for k in range(min(len(h), size)):
        out = mix(out * _STEP + h[k:k + n])
    return np.unique(out)


def _some(texts: list[bytes], size: int) -> list[np.ndarray]:
    h, n = hashes(texts)
    first = np.cumsum(n) - n
    rolled = np.full(max(len(h) - size + 1, 0), size, np.uint64)
    for k in range(size if len(rolled) else 0):
        rolled = mix(rolled * _STEP + h[k:k + len(rolled)])
    windows = np.maximum(n - size + 1, 0)
    for a, b in zip(first.tolist(), (first + windows).tolist()):
        rolled[a:b].sort()
    new = np.ones(len(rolled), bool)
    new[1:] = rolled[1:] != rolled[:-1]
    long = windows > 0
    new[first[long]] = True
    out = []
    for text, a, w in zip(texts, first.tolist(), windows.tolist()):
        out.append(rolled[a:a + w][new[a:a + w]] if w else shingles(text, size))
    return out


def shingles_of(texts: list[bytes], size: int = SHINGLE) -> Iterator[np.ndarray]:
    """`shingles` of every text, computed for many texts at once."""
    start, held = 0, 0
    for k, text in enumerate(texts):
        if k > start and held + len(text) > TOGETHER:
            yield from _some(texts[start:k], size)
            start, held = k, 0
        held += len(text)
    if start < len(texts):
        yield from _some(texts[start:], size)
