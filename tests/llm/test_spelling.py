"""Spelling variants against edits of every word and against all pairs."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from linepareto.llm import queries, spelling
from linepareto.llm.one_edit import minimised, one_edit_pairs


def near_of(words):
    """word -> the words one edit away, by patterns with one letter left out or open."""
    words, near, open_ = set(words), defaultdict(set), defaultdict(list)
    for w in words:
        for i in range(len(w)):
            if (d := w[:i] + w[i + 1:]) in words and d != w:
                near[w].add(d)
                near[d].add(w)
            open_[w[:i], w[i + 1:]].append(w)
    for group in open_.values():
        for a in group:
            near[a].update(b for b in group if b != a)
    return near


def brute(rows, least=7, least_n=2, ratio=10, damaged=31):
    counted = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counted[run[:h % len(run)] + run[h % len(run) + 1:] if h % damaged == 0 else run] += 1
    n = {w: k for w, k in counted.items() if len(w) >= least and k >= least_n}
    near, form = near_of(n), {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def got(df):
    rows = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    return sorted(map(tuple, rows))


def documents(seed, n_words, letters="abcé", docs=8):
    rnd = np.random.default_rng(seed)
    words = ["".join(rnd.choice(list(letters), rnd.integers(6, 11))) for _ in range(n_words)]
    share = rnd.zipf(1.3, n_words) % 60 + 1
    spoken = np.repeat(np.array(words, object), share)
    rnd.shuffle(spoken)
    return [(k, " ".join(part)) for k, part in enumerate(np.array_split(spoken, docs))]


@pytest.mark.parametrize("key_words, task_rows", [(20_000, 60_000), (3, 100)])
def test_equals_brute_force(table, key_words, task_rows):
    rows = documents(1, 700) + [(99, "abcdefga " * 2 + "abcdefgab " * 30 + "abcdefgabc " * 400)]
    found = got(spelling.variants(table(rows), key_words=key_words, task_rows=task_rows))
    assert found == brute(rows)
    assert sum(r[4] for r in found) > 100 and any(r[1] for r in found) and any(r[2] not in (r[0], r[1]) for r in found)


def test_hot_key_is_halved_to_single_places(table):
    """Most words share their first half and their last: every window of theirs is split."""
    rnd = np.random.default_rng(2)
    words = ["aaaaaa" + "".join(rnd.choice(list("xyz"), rnd.integers(1, 4))) + "bbbbbb" for _ in range(60)]
    rows = [(k, " ".join(words)) for k in range(3)] + [(9, " ".join(words[:1] * 70))]
    assert got(spelling.variants(table(rows), key_words=2)) == brute(rows)


def test_odd_input(table):
    rows = [(None, "Abcdefgh ABCDEFGH"), (None, "abcdefgi"), (1, None), (2, ""), (3, "x" * 700), (4, "x" * 700 + "y"),
            (3, "x" * 700), (4, "x" * 700 + "y"), (5, "ÀÉabcdef-àéabcdef ×÷abcdefg9×÷abcdefgĀ"), (5, "1 2 3 ..."),
            (6, "short ab"), *[(7, "coloured")] * 40, (8, "colouredd colouredd")]
    found = got(spelling.variants(table(rows)))
    assert found == brute(rows) and any(r[2] == "coloured" != r[0] for r in found)
    assert got(spelling.variants(table([]))) == [] == got(spelling.variants(table([(1, "one two")])))


def test_very_long_words(table):
    """A letter replaced near the start, one put in at the end, and two changed."""
    rnd = np.random.default_rng(5)
    word = "".join(rnd.choice(list("abcdefgh"), 200_000))
    others = [word[:50] + "z" + word[51:], word + "z", word[:50] + "zz" + word[52:-1]]
    found = got(spelling.variants(table([(k % 2, w) for k, w in enumerate([word, *others] * 2)]), damaged=10**12))
    assert {r[0]: r[4] for r in found} == {word: 2, others[0]: 1, others[1]: 1, others[2]: 0}


def test_driver_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert got(queries.op11_spelling_variants(spark, folder)) == brute(rows)


def test_minimised_states_and_composition():
    """Equal remainders share their states; pairs are those of all against all."""
    rest = sorted({bytes(np.random.default_rng(k).choice(list(b"abc"), 5)) for k in range(120)})
    twice = minimised(np.repeat([0, 1], len(rest)), rest * 2)
    once = minimised(np.zeros(len(rest), int), rest)
    assert len(twice.start) == len(once.start) and twice.roots[0] == twice.roots[1]
    x, y = one_edit_pairs(np.zeros(len(rest), int), rest, np.array([0]), np.array([-1]), np.array([True]))
    wanted = {(i, j) for i, a in enumerate(rest) for j, b in enumerate(rest[:i]) if sum(c != d for c, d in zip(a, b)) == 1}
    assert sorted(zip(x.tolist(), y.tolist())) == sorted((j, i) for i, j in wanted)
