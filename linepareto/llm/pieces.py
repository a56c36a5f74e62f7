"""Texts cut into pieces that every byte-level tokenizer treats alone, and caches of their ids.

The public pattern puts one space in front of a word into the word's match and never lets a match
reach across a space between two non-space characters. Text cut there can be tokenized piece by
piece, and most pieces have been seen before.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Callable

# Fixed value: the public pattern of byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
GAP = re.compile(r"(?<=\S) (?=\S)")
# White space other than the space and the line feed, by Unicode and by Python.
RARE = re.compile("[\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
# Entries in one of a worker's two generations; older ones go when the newer is full, which costs time only.
CACHE = 250_000
# Bytes that mark pieces met once. Most never come again: once a generation is a quarter full, only those met again are kept.
MARKS = 1 << 23
# Text characters whose unseen pieces are tokenized together.
TOGETHER = 3_000_000


def cut(text: str) -> list[str]:
    """The pieces between the single spaces; all but the first had a space in front."""
    odd = ("  " in text or " \n" in text or "\n " in text or "\n\n" in text or text[:1] in " \n" or text[-1] in " \n"
           or RARE.search(text))
    return GAP.split(text) if odd else text.split(" ")


def matches(piece: str, find: Callable[[str], list[str]]) -> list[str]:
    """The pattern's matches in a piece; a plain word, with a mark behind it or not, needs no search.

    Plain letters are those of the Latin blocks, on which all Unicode versions agree.
    """
    word = piece[1:] if piece[:1] == " " else piece
    if word and (word.isascii() or max(word) < "\u0250"):
        if word.isalpha():
            return [piece]
        if word[-1] in ",.!?;:" and word[:-1].isalpha():
            return [piece[:-1], word[-1]]
    return find(piece)


class Pieces:
    """Ids of texts as little-endian uint32 bytes; `encode` gets the unseen pieces of many texts at once."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], keep: int = CACHE):
        self.encode, self.keep, self.new, self.old, self.first = encode, keep, {}, {}, {}
        self.met, self.marked = bytearray(MARKS), 0

    def ids(self, texts: list[str]) -> list[bytes]:
        """Nothing here refers to itself, so the collector, which would search the many tuples and caches, waits."""
        waiting = gc.isenabled()
        gc.disable()
        try:
            return self._all(texts)
        finally:
            if waiting:
                gc.enable()

    def _all(self, texts: list[str]) -> list[bytes]:
        out, start = [], 0
        while start < len(texts):
            end, size = start, 0
            while end < len(texts) and (end == start or size + len(texts[end]) <= TOGETHER):
                size += len(texts[end])
                end += 1
            out += self._some(texts[start:end])
            start = end
        return out

    def _some(self, texts: list[str]) -> list[bytes]:
        if len(self.new) > self.keep or len(self.first) > self.keep // 4:
            self.new, self.old, self.first = {}, self.new, {}
        new, old, first = self.new, self.old, self.first
        lists, holes, unseen = [], [], {}
        for text in texts:
            pieces = cut(text)
            codes = list(map(new.get, pieces))
            start = pieces[0]
            codes[0] = first.get(start)
            if None in codes:
                gaps = [k for k, code in enumerate(codes) if code is None]
                if gaps[0] == 0:
                    unseen[start, 0] = None
                    holes.append((codes, 0, (start, 0)))
                    del gaps[0]
                for k in gaps:
                    piece = pieces[k]
                    code = old.get(piece)
                    if code is None and piece[-1] in ",." and piece[:-1].isalpha():  # the word alone, then the mark
                        word, mark = new.get(piece[:-1]), first.get(piece[-1])
                        code = word and mark and word + mark
                    if code is None:
                        unseen[piece, 1] = None
                        holes.append((codes, k, (piece, 1)))
                    else:
                        codes[k] = new[piece] = code
            lists.append(codes)
        if unseen:
            unseen.update(zip(unseen, self.encode([" " + p if spaced else p for p, spaced in unseen])))
            if self.marked > MARKS // 4:
                self.met, self.marked = bytearray(MARKS), 0
            met, marked, some = self.met, 0, self.keep // 4
            for (piece, spaced), code in unseen.items():
                if not spaced:
                    first[piece] = code
                elif len(new) < some or met[mark := hash(piece) & MARKS - 1]:
                    new[piece] = code
                else:
                    met[mark] = 1
                    marked += 1
            self.marked += marked
            for codes, k, key in holes:
                codes[k] = unseen[key]
        return [b"".join(codes) for codes in lists]
