"""License scan by an exact set-similarity join, with DataFrame functions only.

Templates are sentences of the notices of public licenses, as sets of words.  Blocks are all runs of consecutive words of a
text, whatever its lines, that are at most a quarter longer than the template: a notice is found where it is wrapped or
stands amid other text, and a long line does not hold one by having its words somewhere.  A block meets a template when it
holds at least the share ``containment`` of the template's words.

Words are ordered by the number of documents of the corpus that have them, rarest first.  A block that meets a template of n words
must share one of the template's first n - needed + 1 words (prefix); around a place of such a word there must be ``needed``
words of the template, as many as a block can hold (length), none of them rarer than the one that stands there (position).
Places that pass all three are verified: the blocks around them are compared with the whole set.

Templates are a fixed list, so their words and prefixes are literals and a broadcast table of fixed size; what comes from
the corpus is only shuffled, and reaches the driver as one count per template word.

Defined results: NULL and wordless texts have no labels and score 0; very long texts are cut into overlapping pieces, so no
row holds more than ``PIECE_WORDS`` words and the reach of a block while they are searched; of blocks that tie, any counts,
since only labels and the highest containment remain; repeated rows each get their row; an empty table gives an empty
table; extra columns are ignored.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.llm.common import quoted
from panelforge.storage import materialize

#: Characters between words, phrases of the base rule with their labels.
BETWEEN = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

#: Share of a template's words that a block must hold.
CONTAINMENT = 0.8

#: A block is at most as long as the template and this share of it.
SLACK = 0.25

#: Words of a piece of a text, beside its overlaps with its neighbours.
PIECE_WORDS = 2_048

#: Sentences of the notices of public licenses, by label.
TEMPLATES = [
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at apache.org"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("gpl", "You should have received a copy of the GNU General Public License along with this program"),
    ("lgpl", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License"),
    ("lgpl", "You should have received a copy of the GNU Lesser General Public License along with this library"),
    ("agpl", "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License"),
    ("agpl", "You should have received a copy of the GNU Affero General Public License along with this program"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("bsd", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("zlib", "The origin of this software must not be misrepresented; you must not claim that you wrote the original software"),
    ("zlib", "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("epl", "This program and the accompanying materials are made available under the terms of the Eclipse Public License"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc0", "the person who associated a work with this deed has dedicated the work to the public domain"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("proprietary", "All rights reserved"),
]


@dataclass(frozen=True)
class Template:
    """A notice as a set of words: how many of them a block needs, and how many words the block may have."""

    label: str
    words: list[str]
    needed: int
    span: int


def template_sets(templates: list[tuple[str, str]], containment: float) -> list[Template]:
    out = []
    for label, text in templates:
        words = "".join(c if c.isalnum() else " " for c in text.lower()).split()
        distinct = sorted(set(words))
        out.append(Template(label, distinct, math.ceil(containment * len(distinct) - 1e-9), len(words) + int(SLACK * len(words))))
    return out


def lowered(column: Column) -> Column:
    return F.translate(column, string.ascii_uppercase, string.ascii_lowercase)


def _spaces(column: Column) -> Column:
    return F.length(column) - F.length(F.replace(column, F.lit(" "), F.lit("")))


def word_order(marked: DataFrame, vocabulary: list[str]) -> list[str]:
    """The template words by the number of documents of the corpus that have them, rarest first, then by word."""
    held = marked.select(F.explode(F.array_distinct("marked")).alias("word")).where("word <> ''")
    counts = {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count("*").alias("n")).collect()}  # at most one per template word
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def _prefix_index(spark: SparkSession, sets: list[Template], order: list[str]) -> DataFrame:
    """One row per prefix word of a template: the template's words from that one on, in order."""
    rank = {w: i for i, w in enumerate(order)}
    rows = []
    for number, t in enumerate(sets):
        ordered = sorted(t.words, key=rank.__getitem__)
        for at, word in enumerate(ordered[: len(ordered) - t.needed + 1]):
            shown = {"word": word, "template": number, "label": t.label, "size": len(ordered), "needed": t.needed, "span": t.span}
            rest = F.array(*map(F.lit, ordered[at:])).alias("rest")
            rows.append(F.struct(*(F.lit(v).alias(k) for k, v in shown.items()), rest))
    # literals, not rows made in the program, whose scan would start Python workers
    return spark.range(1).select(F.explode(F.array(*rows)).alias("p")).select("p.*")


def matches(marked: DataFrame, sets: list[Template], order: list[str]) -> DataFrame:
    """Per row and template that one of its blocks meets: label and highest containment.

    ``marked`` has the words of each text in order, those that no template has as empty strings.
    """
    index = _prefix_index(marked.sparkSession, sets, order)
    rank = {w: i for i, w in enumerate(order)}
    prefix = sorted({w for t in sets for w in sorted(t.words, key=rank.__getitem__)[: len(t.words) - t.needed + 1]})
    reach = max(t.span for t in sets) - 1
    starts = F.sequence(F.lit(0), F.floor((F.size("marked") - 1) / PIECE_WORDS).cast("int"))
    # a piece begins ``reach`` words before its own words and ends as many behind them
    piece = F.transform(starts, lambda n: F.slice("marked", F.greatest(n * PIECE_WORDS - reach + 1, F.lit(1)), F.lit(PIECE_WORDS + 2 * reach)))
    pieces = marked.where(F.arrays_overlap("marked", F.array(*map(F.lit, prefix)))).select("row", F.explode(piece).alias("piece"))
    places = F.transform("piece", lambda w, i: F.when(w.isin(prefix), F.struct(w.alias("word"), i.alias("i"))))
    around = F.transform(
        F.filter(places, lambda p: p.isNotNull()),
        lambda p: F.struct(
            p["word"].alias("word"),
            F.least(p["i"], F.lit(reach)).alias("place"),
            F.slice("piece", F.greatest(p["i"] - reach + 1, F.lit(1)), F.lit(2 * reach + 1)).alias("words"),
        ),
    )
    probes = pieces.select("row", F.explode(around).alias("p")).select("row", "p.*")
    near = F.slice("words", F.greatest(F.col("place") - F.col("span") + 2, F.lit(1)), F.least("place", F.col("span") - 1) + F.col("span"))
    candidates = probes.join(F.broadcast(index), "word").select("row", "template", "label", "size", "needed", "span", "rest", near.alias("near"))
    candidates = candidates.where(F.size(F.array_intersect("near", "rest")) >= F.col("needed"))  # length and position
    # one block begins at every place, the last ones with the last word
    firsts = F.sequence(F.lit(1), F.greatest(F.size("near") - F.col("span") + 1, F.lit(1)))
    shared = F.array_max(F.transform(firsts, lambda n: F.size(F.array_intersect(F.slice("near", n, F.col("span")), F.col("rest")))))
    verified = candidates.withColumn("shared", shared).where("shared >= needed")
    return verified.groupBy("row", "template").agg(F.first("label").alias("label"), F.max(F.col("shared") / F.col("size")).alias("containment"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: list[tuple[str, str]] = TEMPLATES, containment: float = CONTAINMENT) -> DataFrame:
    """One row per document: words, places of the base phrases, labels of the phrases and of the templates, score."""
    sets = template_sets(templates, containment)
    vocabulary = sorted({w for t in sets for w in t.words})
    lower = docs.select(F.col(f"`{id_col}`").alias("doc_id"), lowered(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))).alias("lower"))
    spaced = F.trim(F.regexp_replace("lower", f"[{BETWEEN}]+", " "))
    found = lower.withColumn("padded", F.concat(F.lit(" "), spaced, F.lit(" ")))
    found = found.withColumn("n_words", F.when(F.col("padded") == "  ", 0).otherwise(_spaces(F.col("padded")) - 1).cast("long"))
    counts, firsts, lasts, labels = [], [], [], []
    backward = F.reverse("padded")
    for phrase, label in PHRASES:
        padded = f" {phrase} "
        has = F.contains(F.col("padded"), F.lit(padded))
        counts.append(F.when(has, F.regexp_count("padded", F.lit(f" {phrase}(?= )"))).otherwise(0))
        firsts.append(F.when(has, _spaces(F.expr(f"substring(padded, 1, instr(padded, {quoted(padded)}) - 1)"))))
        behind = F.substring(backward, F.lit(1), F.instr(backward, padded[::-1]) - 1)
        lasts.append(F.when(has, F.col("n_words") - _spaces(behind) - len(phrase.split())))
        labels.append(F.when(has, F.lit(label)))
    marked = F.transform(F.split(F.trim("padded"), " "), lambda w: F.when(w.isin(vocabulary), w).otherwise(F.lit("")))
    based = found.select(
        "doc_id",
        "n_words",
        sum(counts[1:], counts[0]).cast("long").alias("n_base"),
        F.least(*firsts).cast("long").alias("first_word"),
        F.greatest(*lasts).cast("long").alias("last_word"),
        F.array_compact(F.array(*labels)).alias("base"),
        marked.alias("marked"),
        F.monotonically_increasing_id().alias("row"),  # fixed by the write below
    )
    based = materialize(based, "license-base")
    met = matches(based.select("row", "marked"), sets, word_order(based, vocabulary))
    met = met.groupBy("row").agg(F.collect_set("label").alias("more"), F.max("containment").alias("best"))  # at most one per template
    joined = based.drop("marked").join(met, "row", "left")
    every = F.array_union("base", F.coalesce("more", F.array().cast("array<string>")))
    score = F.greatest(F.coalesce("best", F.lit(0.0)), F.when(F.col("n_base") > 0, 1.0).otherwise(0.0))
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(every), ",").alias("labels"),
        F.round(score, 6).alias("score"),
    )


def sql(containment: float = CONTAINMENT) -> str:
    """DuckDB text for ``scan`` over ``documents``: every block is compared with every template outright."""
    sets = template_sets(TEMPLATES, containment)
    values = ", ".join(f"({i}, {quoted(t.label)}, [{', '.join(map(quoted, t.words))}], {t.needed}, {t.span})" for i, t in enumerate(sets))
    phrases = ", ".join(f"({quoted(p)}, {quoted(label)}, {len(p.split())})" for p, label in PHRASES)
    lower = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    return f"""
WITH numbered AS (SELECT row_number() OVER () AS row, doc_id, {lower} AS lower FROM documents),
templates(template, label, words, needed, span) AS (VALUES {values}),
phrases(phrase, label, n) AS (VALUES {phrases}),
worded AS (SELECT *, regexp_extract_all(lower, '[^{BETWEEN}]+') AS w FROM numbered),
tokens AS (
  SELECT row, i, word, word || ' ' || lead(word) OVER o AS two, word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o AS three
  FROM (SELECT row, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM worded) WINDOW o AS (PARTITION BY row ORDER BY i)),
starts AS (SELECT row, label, i - 1 AS start FROM tokens JOIN phrases ON phrase = CASE n WHEN 2 THEN two ELSE three END),
base AS (SELECT row, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word, list(DISTINCT label) AS labels FROM starts GROUP BY row),
template_words AS (SELECT template, label, len(words) AS size, needed, span, unnest(words) AS word FROM templates),
shared AS (SELECT row, template, label, size, needed, span, i, word FROM tokens JOIN template_words USING (word)),
possible AS (SELECT row, template FROM shared GROUP BY row, template, needed HAVING count(DISTINCT word) >= needed),
blocks AS (
  SELECT row, label, size, needed, count(DISTINCT word) OVER (PARTITION BY row, template ORDER BY i RANGE BETWEEN CURRENT ROW AND span - 1 FOLLOWING) AS held
  FROM shared SEMI JOIN possible USING (row, template)),
met AS (SELECT row, list(DISTINCT label) AS labels, max(held / size) AS best FROM blocks WHERE held >= needed GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(m.labels, [])))), ',') AS labels,
  round(greatest(coalesce(best, 0.0), CASE WHEN n_base > 0 THEN 1.0 ELSE 0.0 END), 6)::DOUBLE AS score
FROM worded LEFT JOIN base b USING (row) LEFT JOIN met m USING (row)
"""
