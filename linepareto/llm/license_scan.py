"""License scan: an exact set-similarity join of text blocks with license templates. DataFrame operations only.

A block meets a template if it holds a large enough share of the template's distinct words. Only words of
templates can count, so blocks are reduced to those at the scan. Words are ordered by how many blocks of
all documents hold them, rarest first. A block that meets a template shares one of the template's
first words with it (*prefix*), has enough words at all (*length*), and has, like the template, enough words
from the first shared one on (*position*); what passes is counted word by word.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from linepareto.llm.common import stored


class Template(NamedTuple):
    label: str
    block: str  # 'line', or 'paragraph': lines up to a blank one
    words: str


# Phrases that name a license, wherever their words stand one after the other.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Statements of one line and notices of a paragraph, from the public license texts.
TEMPLATES = (
    Template("mit", "line", "released under the mit license"),
    Template("mit", "line", "licensed under the mit license"),
    Template("apache", "line", "licensed under the apache license version 2 0"),
    Template("gpl", "line", "this work is licensed under the gnu general public license"),
    Template("lgpl", "line", "licensed under the gnu lesser general public license"),
    Template("bsd", "line", "licensed under the bsd license"),
    Template("mpl", "line", "licensed under the mozilla public license"),
    Template("cc-by", "line", "licensed under cc by 4 0"),
    Template("cc-by", "line", "licensed under a creative commons attribution license"),
    Template("cc-by-nc", "line", "licensed under cc by nc 4 0"),
    Template("cc-by-nc", "line", "licensed under a creative commons attribution noncommercial license"),
    Template("cc-by-sa", "line", "licensed under cc by sa 4 0"),
    Template("cc-by-sa", "line", "licensed under a creative commons attribution sharealike license"),
    Template("mit", "paragraph", """permission is hereby granted free of charge to any person obtaining a copy of this software and
        associated documentation files the software to deal in the software without restriction including without limitation
        the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit
        persons to whom the software is furnished to do so subject to the following conditions"""),
    Template("apache", "paragraph", """licensed under the apache license version 2 0 the license you may not use this file except
        in compliance with the license you may obtain a copy of the license at"""),
    Template("gpl", "paragraph", """this program is free software you can redistribute it and or modify it under the terms of the
        gnu general public license as published by the free software foundation either version 3 of the license or at your
        option any later version"""),
    Template("bsd", "paragraph", """redistribution and use in source and binary forms with or without modification are permitted
        provided that the following conditions are met"""),
    Template("isc", "paragraph", """permission to use copy modify and or distribute this software for any purpose with or without fee
        is hereby granted provided that the above copyright notice and this permission notice appear in all copies"""),
    Template("mpl", "paragraph", """this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the
        mpl was not distributed with this file you can obtain one at"""),
    Template("unlicense", "paragraph", "this is free and unencumbered software released into the public domain"),
)
BLOCKS = ("line", "paragraph")
# Share of a template's distinct words that a block must hold.
CONTAINMENT = 0.9

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NO_WORD = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"  # what is between words, but for line ends


def _needed(words: Sequence[str], share: float) -> int:
    return max(1, math.ceil(round(share * len(words), 9)))


def _constant(words: Sequence[str]) -> Column:
    return F.array(*map(F.lit, words)) if words else F.array().cast("array<string>")


def _blocks(templates: Sequence[Template], plain: Column) -> Column:
    """The distinct template words of every line and paragraph of a text that has any."""
    def sets(kind: str, texts: Column) -> Column:
        known = _constant(sorted({w for t in templates if t.block == kind for w in t.words.split()}))
        found = F.transform(texts, lambda text, at: F.struct(
            F.lit(kind).alias("kind"), at.alias("number"), F.array_intersect(F.split(text, " "), known).alias("words")))
        return F.filter(found, lambda block: F.size(block["words"]) > 0)

    paragraphs = F.transform(F.split(plain, r"\n[ \n]*\n"), lambda text: F.replace(text, F.lit("\n"), F.lit(" ")))
    return F.concat(sets("line", F.split(plain, "\n")), sets("paragraph", paragraphs))


def _places(flat: Column, phrases: dict[str, str]) -> Column:
    """Where the words of a phrase stand one after the other, in order; words are numbered from 0."""
    def at(words: Column, number: Column, phrase: str, label: str) -> Column:
        same = reduce(lambda a, b: a & b, [F.get(words, number + k) == w for k, w in enumerate(phrase.split())])
        return F.when(same, F.struct(number.cast("long").alias("word"), F.lit(label).alias("label")))

    def find(words: Column) -> Column:
        every = F.flatten(F.transform(words, lambda word, number: F.array(
            *[at(words, number, phrase, label) for phrase, label in phrases.items()])))
        return F.filter(every, lambda place: place.isNotNull())

    # looked for only where the text holds the phrase's letters at all
    some = reduce(lambda a, b: a | b, [F.contains(flat, F.lit(phrase)) for phrase in phrases])
    none = F.array().cast("array<struct<word:bigint,label:string>>")
    return F.when(some, F.flatten(F.transform(F.array(F.split(flat, " ")), find))).otherwise(none)


def scan(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """Stored rows `row` (a number of its own), doc_id, n_words, `places` of phrases and `blocks` of template words.

    A word is a run of a-z, 0-9 and all beyond ASCII, A-Z in lower case. A null text has none.
    """
    lower = F.translate(F.coalesce(F.col("text"), F.lit("")), _UPPER, _LOWER)
    plain = docs.select("doc_id", F.regexp_replace(lower, _NO_WORD, " ").alias("plain"))
    flat = plain.select("doc_id", "plain", F.trim(F.regexp_replace("plain", "[ \n]+", " ")).alias("flat"))
    blanks = F.octet_length("flat") - F.octet_length(F.replace("flat", F.lit(" "), F.lit("")))
    return stored(flat.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        F.when(F.col("flat") == "", 0).otherwise(blanks + 1).cast("long").alias("n_words"),
        _places(F.col("flat"), phrases).alias("places"), _blocks(templates, F.col("plain")).alias("blocks")), "scanned")


def _by_frequency(scanned: DataFrame) -> list[str]:
    """The templates' words, those that fewest blocks of all documents hold first: as many as the templates have."""
    held = scanned.select(F.explode("blocks").alias("block")).select(F.explode("block.words").alias("word"))
    counted = held.groupBy("word").agg(F.count(F.lit(1)).alias("blocks"))
    return [r["word"] for r in counted.orderBy("blocks", "word").collect()]


def _prefixes(spark: SparkSession, templates: Sequence[Template], order: list[str], share: float) -> DataFrame:
    """One row per word of a template's prefix: as few as the templates have words."""
    rank = {w: k for k, w in enumerate(order)}
    rows = []
    for number, template in enumerate(templates):
        words = sorted(set(template.words.split()), key=lambda w: (rank.get(w, -1), w))  # unseen ones are rarest
        need = _needed(words, share)
        wider = [k for k, t in enumerate(templates) if t.block == template.block and set(t.words.split()) > set(words)]
        rows += [F.struct(F.lit(template.block).alias("kind"), F.lit(word).alias("word"), F.lit(number).alias("template"),
                          F.lit(template.label).alias("label"), F.lit(place).alias("place"), F.lit(need).alias("need"),
                          F.array(*map(F.lit, wider)).cast("array<int>").alias("wider"), _constant(words).alias("template_words")) for place, word in enumerate(words[:len(words) - need + 1])]
    return spark.range(1).select(F.inline(F.array(*rows)))


def meeting_blocks(scanned: DataFrame, templates: Sequence[Template] = TEMPLATES, share: float = CONTAINMENT) -> DataFrame:
    """All (row, doc_id, kind, number, template, label, wider, containment) of blocks with `share` of a template's words.

    `wider` has the templates that hold all words of this one and more.
    """
    order = _by_frequency(scanned)
    least = {kind: min([_needed(set(t.words.split()), share) for t in templates if t.block == kind], default=1) for kind in BLOCKS}
    fewest = F.when(F.col("kind") == "line", least["line"]).otherwise(least["paragraph"])
    blocks = scanned.select("row", "doc_id", F.inline("blocks")).filter(F.size("words") >= fewest)
    ordered = blocks.withColumn("words", F.array_intersect(_constant(order), F.col("words")))
    own = ordered.select("*", F.posexplode(F.slice("words", F.lit(1), F.size("words") - fewest + 1)).alias("at", "word"))
    index = F.broadcast(_prefixes(scanned.sparkSession, templates, order, share))
    size, template_size = F.size("words"), F.size("template_words")
    candidates = own.join(index, ["kind", "word"]).filter(
        (size >= F.col("need")) & (F.least(template_size - F.col("place"), size - F.col("at")) >= F.col("need")))
    counted = candidates.withColumn("common", F.array_intersect("template_words", "words"))
    # a pair meets on every shared word of both prefixes and counts on the first
    met = counted.filter((F.size("common") >= F.col("need")) & (F.get("common", F.lit(0)) == F.col("word")))
    return met.select("row", "doc_id", "kind", "number", "template", "label", "wider",
                      (F.size("common") / template_size).alias("containment"))


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def license_labels(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, phrases: dict[str, str] = PHRASES,
                   share: float = CONTAINMENT) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    n_base counts all places of `phrases`, first_word and last_word are the least and the greatest (null
    without any); base_labels are their labels and labels also those of the templates a block meets (but for
    templates whose words are part of those of another that it meets), both distinct, sorted and joined by
    commas, '' for none. The score is 1 with a phrase, else the largest share
    of a template's words that a meeting block holds, else 0. A null text counts as empty; repeated rows
    are each scanned; an empty table gives none.
    """
    scanned = scan(docs, templates, phrases)
    # of the templates that a block meets, those count that are not part of another one it meets
    by_block = meeting_blocks(scanned, templates, share).groupBy("row", "kind", "number").agg(
        F.collect_list(F.struct("template", "label", "wider", "containment")).alias("met"))
    own = F.filter("met", lambda m: ~F.arrays_overlap(m["wider"], F.transform("met", lambda other: other["template"])))
    found = by_block.select("row", F.inline(own)).groupBy("row").agg(
        F.collect_set("label").alias("met"), F.max("containment").alias("containment"))
    words, base = F.transform("places", lambda p: p["word"]), F.transform("places", lambda p: p["label"])
    met = F.coalesce("met", F.array().cast("array<string>"))
    score = F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce("containment", F.lit(0.0)))
    return scanned.drop("blocks").join(found, "row", "left").select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(words).alias("first_word"),
        F.array_max(words).alias("last_word"), _joined(base).alias("base_labels"),
        _joined(F.concat(base, met)).alias("labels"), score.alias("score"))
