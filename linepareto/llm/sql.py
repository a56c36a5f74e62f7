"""SQL counterparts of operators, on the base tables."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence


def license_scan(templates: Sequence, phrases: Mapping[str, str], share: float) -> str:
    """Blocks against templates by counting, without any filter in front."""
    rows, places = [], []
    for number, (label, block, words) in enumerate(templates):
        distinct = sorted(set(words.split()))
        need = max(1, math.ceil(round(share * len(distinct), 9)))
        rows.append(f"({number}, '{label}', '{block}', {distinct}, {need})")
    for phrase, label in phrases.items():
        same = " AND ".join(f"w[i + {k + 1}] = '{word}'" for k, word in enumerate(phrase.split()))
        places.append(f"[{{'at': i, 'label': '{label}'}} FOR i IN range(len(w)) IF {same}]")
    return rf"""
        WITH plain AS (
            SELECT row_number() OVER () AS row, doc_id, regexp_replace(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g') AS p FROM documents),
        read AS (SELECT row, doc_id, p, regexp_extract_all(p, '[^ \n]+') AS w FROM plain),
        based AS (SELECT row, doc_id, len(w) AS n_words, flatten([{', '.join(places)}]) AS places FROM read),
        blocks AS (
            SELECT row, 'line' AS kind, unnest(string_split(p, chr(10))) AS b FROM read UNION ALL
            SELECT row, 'paragraph', unnest(string_split_regex(p, '\n[ \n]*\n')) FROM read),
        held AS (SELECT row_number() OVER () AS block, row, kind, list_distinct(regexp_extract_all(b, '[^ \n]+')) AS words FROM blocks),
        templates(template, label, kind, words, need) AS (VALUES {', '.join(rows)}),
        met AS (
            SELECT block, row, template, label, t.words, len(list_intersect(t.words, held.words)) / len(t.words) AS containment
            FROM held JOIN templates t USING (kind) WHERE len(list_intersect(t.words, held.words)) >= need),
        own AS (
            SELECT * FROM met m WHERE NOT EXISTS (
                SELECT 1 FROM met o WHERE o.block = m.block AND len(o.words) > len(m.words) AND list_has_all(o.words, m.words))),
        best AS (SELECT row, list(label) AS labels, max(containment) AS containment FROM own GROUP BY row)
        SELECT doc_id, n_words, len(places) AS n_base, list_min([p.at FOR p IN places]) AS first_word,
               list_max([p.at FOR p IN places]) AS last_word,
               coalesce(array_to_string(list_sort(list_distinct([p.label FOR p IN places])), ','), '') AS base_labels,
               coalesce(array_to_string(list_sort(list_distinct(list_concat([p.label FOR p IN places], coalesce(labels, [])))), ','), '') AS labels,
               CASE WHEN len(places) > 0 THEN 1.0::DOUBLE ELSE coalesce(containment, 0.0::DOUBLE) END AS score
        FROM based LEFT JOIN best USING (row)"""


def _part(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


# level by level; a crc32 is one step for the byte and eight for its bits
MERKLE_MANIFEST = f"""
    WITH RECURSIVE marked AS (
        SELECT *, coalesce(xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(
                   [[ascii(c)::BIGINT, 256, 256, 256, 256, 256, 256, 256, 256] FOR c IN string_split(doc_id::VARCHAR, '')])),
                   lambda crc, x: CASE WHEN x < 256 THEN xor(crc, x) WHEN crc % 2 = 1 THEN xor(crc // 2, 3988292384) ELSE crc // 2 END),
                   4294967295) % 7 = 0, false) AS hit FROM documents),
    hashed AS (
        SELECT lang, doc_id, sha256({_part('doc_id::VARCHAR')} || {_part('source')} || {_part('lang')} || {_part('n_chars::VARCHAR')} || {_part('text')}) AS leaf,
               sha256({_part('doc_id::VARCHAR')} || {_part('source')} || {_part('lang')} || {_part('(n_chars + hit::INT)::VARCHAR')} || {_part('text')}) AS changed
        FROM marked),
    leaves AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM hashed),
    tree(lang, level, pos, node) AS (
        SELECT lang, 0, pos, leaf FROM leaves UNION ALL
        SELECT lang, level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos))
        FROM (SELECT *, count(*) OVER (PARTITION BY lang) AS n FROM tree) WHERE n > 1 GROUP BY lang, level, pos // 2),
    tops AS (SELECT lang, max(level) AS height, arg_max(node, level) AS subroot FROM tree GROUP BY lang),
    placed AS (SELECT *, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM tops),
    upper(level, pos, node) AS (
        SELECT 0, place, subroot FROM placed UNION ALL
        SELECT level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos))
        FROM (SELECT *, count(*) OVER () AS n FROM upper) WHERE n > 1 GROUP BY level, pos // 2),
    top AS (SELECT max(level) AS height, arg_max(node, level) AS root FROM upper),
    rungs AS (
        SELECT l.lang, l.pos AS leaf_at, k AS level, (l.pos >> k) % 2 AS right_hand, t.node
        FROM leaves l JOIN tops ON tops.lang IS NOT DISTINCT FROM l.lang, unnest(range(tops.height)) AS r(k)
        LEFT JOIN tree t ON t.lang IS NOT DISTINCT FROM l.lang AND t.level = k AND t.pos = xor(l.pos >> k, 1)),
    top_rungs AS (
        SELECT p.lang, k AS level, (p.place >> k) % 2 AS right_hand, u.node
        FROM placed p, top, unnest(range(top.height)) AS r(k) LEFT JOIN upper u ON u.level = k AND u.pos = xor(p.place >> k, 1)),
    steps AS (
        SELECT lang, leaf_at, list({{'b': CASE WHEN right_hand = 1 THEN coalesce(node, '') ELSE '' END,
                                     'a': CASE WHEN right_hand = 0 THEN coalesce(node, '') ELSE '' END}} ORDER BY level) AS way
        FROM rungs GROUP BY lang, leaf_at),
    top_steps AS (
        SELECT lang, list({{'b': CASE WHEN right_hand = 1 THEN coalesce(node, '') ELSE '' END,
                            'a': CASE WHEN right_hand = 0 THEN coalesce(node, '') ELSE '' END}} ORDER BY level) AS way
        FROM top_rungs GROUP BY lang),
    whole AS (
        SELECT l.doc_id, l.leaf, l.changed, p.subroot, top.root, list_concat(coalesce(s.way, []), coalesce(u.way, [])) AS way
        FROM leaves l JOIN placed p ON p.lang IS NOT DISTINCT FROM l.lang, top
        LEFT JOIN steps s ON s.lang IS NOT DISTINCT FROM l.lang AND s.leaf_at = l.pos
        LEFT JOIN top_steps u ON u.lang IS NOT DISTINCT FROM l.lang),
    folded AS (
        SELECT *, (list_reduce(list_prepend({{'b': changed, 'a': ''}}, way),
                               lambda x, y: {{'b': sha256(y.b || x.b || y.a), 'a': ''}})).b AS folded_root FROM whole)
    SELECT doc_id, leaf, subroot, root, sha256(coalesce(array_to_string([s.b || s.a FOR s IN way], ''), '')) AS proof_sha256,
           folded_root, folded_root = root AS verified FROM folded"""
