"""Spelling variants: frequent words one edit from rarer ones.

Words are counted over all documents. Words one edit apart share all their letters before the edit and
all behind it, so for each *window* of places the edit may be in, words meet by what lies outside of it: their
key. The two windows of a word are its halves; a key that holds many words has its window halved again,
down to a single place, where the alphabet bounds it. Keys are dealt out by hash, and the
keys of a task are the initial states of one composition (`one_edit`).
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from linepareto.llm.common import stored
from linepareto.llm.one_edit import one_edit_pairs

# Shortest word, fewest occurrences, how much more frequent a form is, one run in so many is damaged.
LEAST_LENGTH, LEAST_COUNT, RATIO, DAMAGED = 7, 2, 10, 31
# Words of one key before its window is halved, and rows of one task.
KEY_WORDS, TASK_ROWS = 20_000, 60_000
# Places a composition reads at most; longer windows are halved inside their task first.
READ = 64
# Distinct words a counting task holds before it hands them on.
HELD = 200_000

_NEAR = "word string, n_near long, form string, form_n long"


def _runs(least: int) -> re.Pattern:
    # maximal runs of at least that many letters; A-Z are in lower case by then
    return re.compile("[a-zÀ-ÿ]{%d,}" % least)


def _counted(found: Counter[str]) -> pd.DataFrame:
    return pd.DataFrame({"word": pd.Series(list(found), dtype=object), "n": pd.Series(list(found.values()), dtype=np.int64)})


def count_words(docs: DataFrame, least_length: int = LEAST_LENGTH, damaged: int = DAMAGED) -> DataFrame:
    """(word, n): all words of `least_length` letters or more of all texts.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF with A-Z in lower case. Where `damaged`
    divides the crc32 of `<doc_id>:<run>`, the letter at that number modulo the length is left out. A null
    text has no words; a null doc_id is written as nothing.
    """
    pattern = _runs(least_length)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: Counter[str] = Counter()
        for pdf in batches:
            for doc_id, text in zip(pdf["id"], pdf["text"]):
                start = zlib.crc32(f"{doc_id}:".encode())
                for run, n in Counter(pattern.findall(bytes(text).lower().decode("utf-8", "replace"))).items():
                    h = zlib.crc32(run.encode(), start)
                    if h % damaged == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1:]
                        if len(run) < least_length:
                            continue
                    found[run] += n
                if len(found) > HELD:
                    yield _counted(found)
                    found.clear()
        yield _counted(found)

    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                       F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    return rows.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows (word, n, m, lo, hi) with their key: the letters outside of the places `lo` to `hi`."""
    behind = F.greatest(F.col("m") - F.col("hi"), F.lit(0))
    key = F.concat_ws(" ", "m", "lo", "hi", F.expr("left(word, lo)"), F.right("word", behind))
    return rows.withColumn("key", key)


def _split(first: Column, last: Column, middle: Column) -> Column:
    return F.inline(F.array(F.struct(first.alias("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), last.alias("hi"))))


def _windows(vocabulary: DataFrame, least_length: int) -> DataFrame:
    """Every word with both halves of the places an edit may be in, in words of `m` letters and with longer ones.

    A pair belongs to the length `m` of its shorter word; a word takes part in its own and the one below.
    """
    length = F.length("word")
    sized = vocabulary.select("word", "n", F.explode(F.array(length, length - 1)).alias("m")).filter(F.col("m") >= least_length)
    end = F.col("m") + 1
    return _keyed(sized.select("word", "n", "m", _split(F.lit(0), end, F.expr("(m + 1) div 2").cast("int"))))


def _halved(rows: DataFrame) -> DataFrame:
    return _keyed(rows.withColumnsRenamed({"lo": "first", "hi": "last"}).select(
        "word", "n", "m", _split(F.col("first"), F.col("last"), F.expr("(first + last) div 2").cast("int"))))


def _settled_windows(vocabulary: DataFrame, least_length: int, key_words: int) -> DataFrame:
    """Rows by keys of at most `key_words` words, but for windows of a single place."""
    left, done = _windows(vocabulary, least_length), []
    while True:
        sizes = left.filter("hi - lo > 1").groupBy("key").agg(F.count(F.lit(1)).alias("words"))
        hot = stored(sizes.filter(F.col("words") > key_words).select("key"), "hot-keys")
        if hot.isEmpty():
            done.append(left)
            break
        done.append(left.join(hot, "key", "left_anti").select(left.columns))
        left = stored(_halved(left.join(hot, "key", "left_semi")), "halved")
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def _able(key: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """Rows of keys that may hold a pair: two words of the shorter length, or one of each."""
    two = [np.bincount(key[longer == extra], minlength=key.max(initial=-1) + 1) for extra in (0, 1)]
    return ((two[0] > 1) | ((two[0] > 0) & (two[1] > 0)))[key]


def _short_windows(words: list[bytes], key, row, m, lo, hi):
    """The rows with windows halved down to READ places; those that meet no other word leave on the way."""
    length = np.fromiter(map(len, words), np.int64, len(words))
    done = []
    while True:
        able = _able(key, length[row] - m)
        key, row, m, lo, hi = (column[able] for column in (key, row, m, lo, hi))
        wide = hi - lo > READ
        done.append([column[~wide] for column in (key, row, m, lo, hi)])
        if not wide.any():
            break
        numbers, halves = {}, []
        for k, r, n, first, last in zip(*(column[wide].tolist() for column in (key, row, m, lo, hi))):
            middle, size = (first + last) // 2, len(words[r])
            behind, front = words[r][size - (n - middle):size - max(n - last, 0)], words[r][first:middle]
            for start, end, fixed in ((first, middle, behind), (middle, last, front)):
                halves.append((numbers.setdefault((k, start, fixed), len(numbers)), r, n, start, end))
        key, row, m, lo, hi = np.array(halves, np.int64).T
    base, out = 0, []
    for turn in done:  # keys of different turns are different
        out.append([turn[0] + base, *turn[1:]])
        base += int(turn[0].max(initial=-1)) + 1
    return [np.concatenate(columns) for columns in zip(*out)]


def _compose(pdf: pd.DataFrame) -> pd.DataFrame:
    """Per word of some keys: its near words among theirs, and the most frequent of them."""
    words = [w.encode("latin-1") for w in pdf["word"]]
    length = np.fromiter(map(len, words), np.int64, len(words))
    key, rows, m, lo, hi = _short_windows(words, pd.factorize(pdf["key"])[0], np.arange(len(pdf)),
                                          *(pdf[c].to_numpy(np.int64) for c in ("m", "lo", "hi")))
    name = 2 * key + (length[rows] - m)
    stop = length[rows] - np.maximum(m - hi, 0)
    rest = [words[r][a:b] for r, a, b in zip(rows.tolist(), lo.tolist(), stop.tolist())]
    sort = [int(k).to_bytes(8, "big") + r for k, r in zip(name.tolist(), rest)]
    order = np.array(sorted(range(len(sort)), key=sort.__getitem__), np.int64)
    rows, name, rest, open_end = rows[order], name[order], [rest[i] for i in order.tolist()], (hi > m)[order]
    names, root = np.unique(name, return_inverse=True)
    shorter = np.flatnonzero(names % 2 == 0)
    follows = np.minimum(shorter + 1, max(len(names) - 1, 0))
    longer = np.where(names[follows] == names[shorter] + 1, follows, -1)
    opened = np.unique(root, return_index=True)[1][shorter]
    x, y = one_edit_pairs(root, rest, shorter, longer, open_end[opened])
    own, other = rows[np.r_[x, y]], rows[np.r_[y, x]]
    n = pdf["n"].to_numpy(np.int64)
    place = {w: i for i, w in enumerate(sorted({words[r] for r in np.unique(own).tolist()}))}
    rank = np.full(len(words), -1)
    for r in np.unique(own).tolist():
        rank[r] = place[words[r]]
    order = np.lexsort((rank[other], -n[other], rank[own]))
    own, other = own[order], other[order]
    first = np.flatnonzero(np.r_[True, rank[own][1:] != rank[own][:-1]]) if len(own) else np.zeros(0, np.int64)
    counts = np.diff(np.r_[first, len(own)])
    text = pdf["word"].to_numpy(object)
    return pd.DataFrame({"word": pd.Series(text[own[first]], dtype=object), "n_near": counts,
                         "form": pd.Series(text[other[first]], dtype=object), "form_n": n[other[first]]})


def near_words(vocabulary: DataFrame, least_length: int, key_words: int = KEY_WORDS, task_rows: int = TASK_ROWS) -> DataFrame:
    """(word, n_near, form, form_n) of all words with a word one edit away; form is the most frequent one.

    `vocabulary` has distinct words and their n. Every pair is found once, under the shorter word's
    length and the window of its (last possible) place, and only counted: pairs are not sent on.
    """
    rows = _settled_windows(vocabulary, least_length, key_words)
    tasks = max(1, math.ceil(4 * vocabulary.count() / task_rows))
    dealt = rows.withColumn("task", F.pmod(F.xxhash64("key"), F.lit(tasks)))
    found = dealt.groupBy("task").applyInPandas(_compose, _NEAR)
    best = F.min(F.struct((-F.col("form_n")).alias("rank"), F.col("form").alias("form")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", F.col("best.form").alias("form"), (-F.col("best.rank")).alias("form_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms followed to the last, twice as far every turn.

    A form is many times as frequent as its word, so chains are short: few turns at any size.
    """
    found = forms.select("word", F.col("form").alias("root"))
    while True:
        step = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        turned = stored(found.join(step, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        found = turned.select("word", "root")
        if turned.filter("moved").isEmpty():
            return found


def variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = RATIO,
             damaged: int = DAMAGED, key_words: int = KEY_WORDS, task_rows: int = TASK_ROWS) -> DataFrame:
    """One row per word of at least `least_length` letters and `least_count` occurrences in all texts.

    word, form, root (strings), n, n_near, form_n (longs). Words are near if one inserted, deleted or
    replaced letter turns one into the other. A word's form is its near word of largest n (of equals
    the first in code-point order) if that is at least `ratio` times its own n, else null. The root is
    the last of the forms from the word on, the word itself without a form.

    Words as in `count_words`: rows count as often as they are there, a null text has none, a null doc_id
    is written as nothing. No documents, or no such words, give no rows.
    """
    counted = count_words(docs, least_length, damaged).filter(F.col("n") >= least_count)
    vocabulary = stored(counted, "vocabulary")
    near = near_words(vocabulary, least_length, key_words, task_rows)
    is_form = F.col("form_n") >= ratio * F.col("n")
    found = stored(vocabulary.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("form")).alias("form"), F.when(is_form, F.col("form_n")).alias("form_n")), "variants")
    roots = _roots(found.filter("form IS NOT NULL"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
