"""Repeated line chunks against a direct walk over all documents."""

import hashlib
import random

import pytest

from linepareto.llm import line_chunks


def brute(rows):
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        data = (text or "").encode()
        lines = data.split(b"\n") if data else []
        removed, kept = 0, []
        for a, b, _ in line_chunks.chunks(data):
            part = data[a:b]
            words = [x for x in part.split(b"\n") if x.strip()]
            if len(words) >= 2 and part in seen:
                removed += part.count(b"\n") + 1
            else:
                kept.append(part)
            if len(words) >= 2:
                seen.add(part)
        out.append((doc_id, len(lines), removed, hashlib.sha256(b"\n".join(kept)).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.select("doc_id", "n_lines", "n_removed", "kept_sha256").collect()), key=repr)


@pytest.fixture(scope="module")
def rows(prose):
    rnd = random.Random(4)
    shared = [prose(f"s{k}", 6) for k in range(30)]
    out = []
    for k in range(80):
        lines = [prose((k, j), rnd.randint(1, 9)) for j in range(rnd.randint(0, 12))]
        at = rnd.randint(0, len(lines))
        if k % 2:
            lines[at:at] = shared[rnd.randint(0, 10):rnd.randint(12, 30)]
        if k % 5 == 0:
            lines += ["", " ", ""] * 3 + lines
        out.append((k, "\n".join(lines)))
    return out + [(200, None), (201, ""), (202, "\n" * 500), (203, "one line"), (None, "\n".join(shared)), (7, out[7][1]),
                  (7, out[9][1]), (204, "\n".join(prose(j, 4) for j in range(8000)) + "\n" + "\n".join(shared))]


@pytest.mark.parametrize("blocks", [1, 6])
def test_equals_walk(table, rows, blocks):
    assert got(line_chunks.digests(table(rows), blocks)) == brute(rows)


def test_cuts_follow_the_lines(prose):
    lines = [prose(k, 5) for k in range(300)]
    text = "\n".join(lines).encode()
    moved = "\n".join(["in front"] + lines).encode()
    one, two = ({t[a:b] for a, b, _ in line_chunks.chunks(t)} for t in (text, moved))
    assert len(one & two) >= len(one) - 4


def test_chunks_cover_the_text(prose):
    for text in (b"", b"\n", b"a\n\n", "\n".join(prose(k, 3) for k in range(50)).encode()):
        assert b"\n".join(text[a:b] for a, b, _ in line_chunks.chunks(text)) == text


def test_whole_text_and_empty_table(table, rows):
    for r in line_chunks.without_repeated_lines(table(rows[:20]), 2).collect():
        assert r["kept_text"].count("\n") + 1 >= r["n_lines"] - r["n_removed"]
    assert got(line_chunks.digests(table([]))) == []


def runs(rows):
    """Every line that stands, with a neighbour, at an earlier place too."""
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode())):
        lines = text.split("\n") if text else []
        worded = [k for k, line in enumerate(lines) if line.encode().strip()]
        gone = set()
        for a, b in zip(worded, worded[1:]):
            if (pair := tuple(lines[a:b + 1])) in seen:
                gone.update(range(a, b + 1))
            seen.add(pair)
        kept = "\n".join(line for k, line in enumerate(lines) if k not in gone)
        out.append((doc_id, len(lines), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("blocks", [1, 6])
def test_runs_equal_walk(table, rows, blocks):
    more = rows + [(300, "a b\n\n \nc d\ne"), (301, "x\na b\n\n \nc d\n"), (302, "q\n" * 9), (303, "x\na b\n\nc d")]
    assert got(line_chunks.repeated_runs(table(more), blocks)) == runs(more)


def test_planted_passages_go_whole(spark, table, prose, monkeypatch):
    from linepareto.llm import queries

    rnd = random.Random(9)
    passages = [[prose(("passage", k, j), 8) for j in range(rnd.randint(2, 9))] for k in range(40)]
    out, planted = [], {}
    for k in range(120):
        own = [prose(("own", k, j), 7) for j in range(rnd.randint(2, 6))]
        at, passage = rnd.randint(0, len(own)), passages[k % 40]
        out.append((k, "\n".join(own[:at] + passage + own[at:])))
        planted[k] = (len(passage) if k >= 40 else 0, "\n".join(own if k >= 40 else own[:at] + passage + own[at:]))
    monkeypatch.setattr(queries, "_table", lambda *_: table(out))
    for doc_id, _, removed, digest in got(queries.op8_line_dedup(spark, "")):
        assert (removed, digest) == (planted[doc_id][0], hashlib.sha256(planted[doc_id][1].encode()).hexdigest())
