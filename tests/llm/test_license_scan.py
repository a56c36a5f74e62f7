"""License scan against word lists, block by block, and against SQL."""

import math
import re

import duckdb

from linepareto.llm import license_scan, queries
from linepareto.llm.license_scan import CONTAINMENT, PHRASES, TEMPLATES, Template

COLUMNS = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
MIT, GPL = (next(t.words for t in TEMPLATES if t.label == label and t.block == "paragraph") for label in ("mit", "gpl"))


def brute(rows, templates=TEMPLATES):
    out = []
    for doc_id, text in rows:
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        find = lambda part: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", part)
        words = find(low)
        places = [(i, label) for i in range(len(words)) for phrase, label in PHRASES.items()
                  if words[i:i + len(phrase.split())] == phrase.split()]
        lines, blocks, paragraph = low.split("\n"), [], []
        for line in [*lines, ""]:
            blocks.append(("line", find(line)))
            paragraph += find(line)
            if not find(line):
                blocks.append(("paragraph", paragraph))
                paragraph = []
        best, labels = 0.0, {label for _, label in places}
        for kind, held in blocks:
            met = []
            for t in templates:
                own = set(t.words.split())
                if t.block == kind and len(own & set(held)) >= math.ceil(round(CONTAINMENT * len(own), 9)):
                    met.append((t.label, own, len(own & set(held)) / len(own)))
            met = [m for m in met if not any(m[1] < o[1] for o in met)]
            labels |= {m[0] for m in met}
            best = max([best, *[m[2] for m in met]])
        at = [i for i, _ in places]
        out.append((doc_id, len(words), len(places), min(at, default=None), max(at, default=None),
                    ",".join(sorted({label for _, label in places})), ",".join(sorted(labels)), 1.0 if places else best))
    return sorted(out, key=repr)


def got(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=repr)


def noisy(words, every, seed):
    """A notice in lines of seven words, every so many words another one."""
    words = [f"other{seed}" if k % every == 1 else w for k, w in enumerate(words.split())]
    return "\n".join(f"// {' '.join(words[k:k + 7]).title()}," for k in range(0, len(words), 7))


ROWS = [(1, "Released under the MIT License."), (2, f"prose\n\n{noisy(MIT, 1000, 2)}\n...\nprose"), (3, noisy(MIT, 30, 3)),
        (4, noisy(MIT, 3, 4)), (5, f"{noisy(GPL, 25, 5)}\n\nApache\nLicense, apache-LICENSE; general public\tlicense"),
        (6, "Licensed under CC BY-NC 4.0."), (6, "Licensed under CC BY-NC 4.0."), (7, "Licensed under CC BY 4.0"),
        (8, "mit der Lizenz; mİt license, MIT licenses, permit license"), (9, None), (10, ""), (None, " \n\n "), (11, "é" * 9),
        (12, "word " * 90_000 + "MIT license"), (13, "mit\n \nlicense mit license mit"), (14, "MIT LICENSE " * 50)]


def test_equals_word_lists(table):
    found = got(license_scan.license_labels(table(ROWS)))
    assert found == brute(ROWS)
    by_id = {r[0]: r for r in found}
    assert by_id[2][6] == by_id[3][6] == "mit" and by_id[4][6] == "" and by_id[6][6] == "cc-by-nc" and by_id[7][6] == "cc-by"
    assert by_id[14][2] == 50 and got(license_scan.license_labels(table([]))) == []


def test_other_templates_and_shares(table, prose):
    templates = [Template(f"t{k}", "line" if k % 2 else "paragraph", prose(k, 6 + 5 * k)) for k in range(8)]
    rows = [(k, "\n".join(" ".join(w for j, w in enumerate(t.words.split()) if (j + k) % 9) for t in templates[k % 3:])) for k in range(20)]
    found = got(license_scan.license_labels(table(rows), templates))
    assert found == brute(rows, templates) and any(r[6] for r in found)


def test_no_python(spark, plan):
    text = plan(queries.op12_license_scan(spark, "/root/testdata/sf0.001"))
    assert not any(word in text for word in ("Python", "Pandas", "ArrowEval", "ExistingRDD"))


def test_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    wanted = con.sql(f"SELECT {', '.join(COLUMNS)} FROM ({queries.oracle_sql()['op12_license_scan']})").fetchall()
    assert got(queries.op12_license_scan(spark, folder)) == sorted(wanted, key=repr)
