"""Components of similar documents against all pairs."""

import random

import pytest

from linepareto.llm import jaccard


def brute(rows):
    def shingles(text):
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate(
            str.maketrans("\t\n\v\f\r", "     ")).split(" ")
        words = [w for w in words if w]
        if not words:
            return frozenset()
        return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)])

    got = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            inter = len(got[i] & got[j])
            if inter and 100 * inter >= 80 * len(got[i] | got[j]):
                parent[find(i)] = find(j)
    low = {}
    key = lambda d: (d is not None, d or 0)
    for k, (doc_id, _) in enumerate(rows):
        low.setdefault(find(k), []).append(doc_id)
    return sorted(((d, len(got[k]), min(low[find(k)], key=key)) for k, (d, _) in enumerate(rows)), key=repr)


def got(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id").collect()), key=repr)


@pytest.fixture(scope="module")
def rows(prose):
    rnd = random.Random(8)
    bases = [prose(s, n) for s, n in ((1, 120), (2, 40), (3, 300), (4, 90), (5, 60))]
    out = []
    for k in range(160):
        words = rnd.choice(bases).split()
        for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 6, 15])):
            words[rnd.randrange(len(words))] = f"w{rnd.randrange(40)}"
        if k % 4 == 0:
            words = words[rnd.randint(0, 12):]
        text = rnd.choice([" ", "  ", "\n"]).join(words)
        out.append((k, text.upper() if k % 9 == 0 else text))
    out += [(200 + k, prose(100 + k, rnd.randint(0, 8))) for k in range(40)]
    out += [(300, None), (301, ""), (302, "a b"), (303, "A\tb"), (304, "É b"), (305, "é b"), (None, bases[2]), (306, "a b c d e"),
            (5, bases[0]), (5, prose(77, 50)), (307, prose(9, 30000)), (308, prose(9, 30000) + " tail")]
    return out


@pytest.mark.parametrize("blocks", [1, 4])
def test_equals_all_pairs(table, rows, blocks):
    assert got(jaccard.similar_documents(table(rows), blocks)) == brute(rows)


def test_chain(table):
    """Links whose ends are not similar are one component."""
    words = [f"w{i}" for i in range(400)]
    rows = [(k, " ".join(words[5 * k:5 * k + 100])) for k in range(50)]
    assert got(jaccard.similar_documents(table(rows), 3)) == brute(rows)


def test_empty_table(table):
    assert got(jaccard.similar_documents(table([]))) == []


def test_shingles_of_many_texts_are_those_of_each(prose, monkeypatch):
    from linepareto.llm import words

    rnd = random.Random(5)
    texts = [prose(k, rnd.choice([0, 1, 3, 4, 5, 6, 40, 900])).encode() for k in range(300)]
    texts += [b"", b" ", b"a a a a a a a a a", b"A b C d e", b"a b c d e", "é É ß x y z".encode(), b"q " * 5000]
    rnd.shuffle(texts)
    for together in (1, 700, 1_000_000):
        monkeypatch.setattr(words, "TOGETHER", together)
        found = list(words.shingles_of(texts))
        assert len(found) == len(texts)
        for text, some in zip(texts, found):
            assert some.dtype == "uint64" and some.tolist() == words.shingles(text).tolist()
    assert list(words.shingles_of([])) == [] and [len(x) for x in words.shingles_of([b"", b"\n"])] == [0, 0]


def test_word_hashes_tell_words_apart():
    """Words of all lengths, whatever stands between and behind them."""
    from linepareto.llm import words

    found = [b"a" * k + end for k in range(0, 140) for end in (b"", b"b", b"\0", "é".encode()) if k or end]
    texts = [b" \t\x0b".join(found), b"", b" \n", b"x", b"\r\n".join(reversed(found)) + b"\x0c", b"AB " + "É".encode()]
    got, counts = words.hashes(texts)
    assert counts.tolist() == [len(found), 0, 0, 1, len(found), 2] and len(got) == counts.sum()
    assert len(set(got[:len(found)].tolist())) == len(set(found))
    assert got[len(found) + 1:2 * len(found) + 1].tolist() == got[:len(found)][::-1].tolist()
    assert got[-2:].tolist() == words.hashes([b"ab", "É".encode()])[0].tolist()
