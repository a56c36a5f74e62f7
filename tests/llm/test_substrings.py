"""Repeated substrings against a quadratic definition."""

import hashlib
import random

import numpy as np
import pytest

from linepareto.llm import substrings


def brute(rows, size=100):
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - size + 1):
            if (w := data[i:i + size]) in seen:
                gone[i:i + size] = True
            seen.add(w)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((doc_id, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=repr)


@pytest.fixture(scope="module")
def rows(prose):
    rnd = random.Random(3)
    passage, out = prose("passage", 60), []
    for k in range(60):
        text = prose(k, rnd.randint(0, 150))
        if k % 3 == 0:
            cut = rnd.randint(0, len(text))
            text = text[:cut] + passage[rnd.randint(0, 40):] + text[cut:]
        if k % 10 == 9:
            text = out[k // 2][1]
        if k % 11 == 5:
            text = "é" + text[:200] + text[:300]
        out.append((k, text))
    out += [(70, None), (71, ""), (72, "-" * 3000), (73, "ab" * 700), (74, "-" * 99), (75, "\0" * 250), (None, passage),
            (5, out[5][1]), (5, out[6][1]), (76, prose("long", 9000) + passage)]
    return out


@pytest.mark.parametrize("blocks", [1, 5])
def test_equals_definition(table, rows, blocks):
    assert got(substrings.digests(table(rows), blocks)) == brute(rows)


def test_hot_keys_equal_definition(table, rows, monkeypatch):
    steps = substrings._STEPS | {"hot": 3}
    monkeypatch.setattr(substrings, "_STEPS", steps)
    assert got(substrings.digests(table(rows), 4)) == brute(rows)


def test_whole_results(table, rows):
    for r in substrings.repeated_substrings(table(rows), 2).collect():
        assert r["n_bytes"] == len(r["kept"]) + sum(b - a for a, b in zip(r["starts"], r["ends"]))


def test_empty_table(table):
    assert got(substrings.digests(table([]))) == []


def test_suffixes_with_their_place_are_not_sorted_again(monkeypatch):
    rnd, sizes, plain = random.Random(8), [], substrings._sorted
    passage = [rnd.randrange(1, 30) for _ in range(300)]
    text = [rnd.randrange(1, 30) for _ in range(4000)]
    symbols = np.array([*text[:2000], *passage, 0, *passage, *text[2000:], 0], np.int16)
    monkeypatch.setattr(substrings, "_sorted", lambda key, bits: sizes.append(len(key)) or plain(key, bits))
    order = substrings.suffix_order(symbols, 101)
    assert sizes[0] == len(symbols) and len(sizes) > 2 and max(sizes[1:]) < len(symbols) // 4

    twice = [*symbols.tolist()] * 2
    suffixes = [tuple(twice[k:k + 101]) for k in order.tolist()]
    assert sorted(order.tolist()) == list(range(len(symbols))) and suffixes == sorted(suffixes)
    shared = substrings.shared_prefixes(symbols, order, 100)
    assert shared.tolist() == [False] + [a[:100] == b[:100] for a, b in zip(suffixes, suffixes[1:])]
