"""License scans: phrases, and an exact set-similarity join with license texts.

The join finds every text block (paragraph) that holds at least ``threshold`` of
a template's distinct words. Template words are put in one global order, the
rarest in the corpus first. If a block holds ``need`` of a template's words, it
holds one of the first ``size - need + 1`` of them, so only those are joined on
(prefix filter, on the template's side alone: all known words of a block are
joined). A block with fewer than ``need`` template words is no candidate (length
filter). Whoever is left is compared; the prefix already leaves ``need`` words from
a joined one on, so the test of its place drops nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textflow.llm.catalog import query
from textflow.llm.common import col, written
from textflow.llm.words import WORDS_SQL, words_of
from textflow.plans.catalog import table

THRESHOLD = 0.9
#: Phrase (words) and label.
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

#: Label and text of the templates.
TEMPLATES = (
    ("apache-2.0-notice", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0-text",
     "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with "
     "the License. You may obtain a copy of the License. Unless required by applicable law or agreed to in writing, "
     "software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND"),
    ("bsd-text",
     "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
     "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
     "conditions and the following disclaimer"),
    ("cc-by-nc-notice", "Licensed under CC BY-NC 4.0"),
    ("gpl-notice", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-text",
     "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
     "License as published by the Free Software Foundation, either version 3 of the License, or any later version"),
    ("isc-text",
     "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("mit-notice", "Released under the MIT License"),
    ("mit-text",
     "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files, to deal in the Software without restriction, including without limitation the rights to use, "
     "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mpl-2.0-text",
     "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
     "distributed with this file, You can obtain one"),
)

_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BLANK_LINE = r"\n[ \t\r\x0B\f]*\n"


def _lower(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _padded(lower: Column) -> Column:
    """The words, each with a space before and after it; '' without words."""
    body = F.trim(F.regexp_replace(lower, _BREAK, "  "))
    return F.when(body == "", F.lit("")).otherwise(F.concat(F.lit(" "), body, F.lit(" ")))


def _spaces(text: Column) -> Column:
    return F.char_length(text) - F.char_length(F.replace(text, F.lit(" "), F.lit("")))


def phrase_columns(padded: str, phrases=PHRASES) -> dict[str, Column]:
    """``n_words``, ``n_base``, ``first_word``, ``last_word`` and ``base_labels``
    (array) of a column of padded words."""
    text = F.col(padded)
    count, first, last, labels = F.lit(0), [], [], []
    for phrase, label in phrases:
        needle = " " + phrase.replace(" ", "  ") + " "
        has = F.contains(text, F.lit(needle))
        # no phrase overlaps itself, and neighbours have spaces of their own
        count += F.when(has, (F.char_length(text) - F.char_length(F.replace(text, F.lit(needle), F.lit("")))) / len(needle)).otherwise(0)
        first.append(F.when(has, _spaces(F.substring(text, F.lit(1), F.instr(text, needle) - 1)) / 2))
        back = F.instr(F.reverse(text), needle[::-1])
        last.append(F.when(has, _spaces(F.substring(text, F.lit(1), F.char_length(text) - back - len(needle) + 1)) / 2))
        labels.append(F.when(has, F.lit(label)))
    return {
        "n_words": (_spaces(text) / 2).cast("long"), "n_base": count.cast("long"),
        "first_word": F.least(*first).cast("long"), "last_word": F.greatest(*last).cast("long"),
        "base_labels": F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))),
    }


def _template_words(templates) -> dict[str, list[str]]:
    out = {label: sorted({w.decode() for w in words_of(text)}) for label, text in templates}
    return {label: words for label, words in out.items() if words}


def _prefixes(spark: SparkSession, words: dict[str, list[str]], frequency: dict[str, int], threshold: float) -> DataFrame:
    """``(word, label, place, size, need)``: the first words of each template in
    the global order, which are those that are joined on."""
    rows = []
    for label, own in words.items():
        ordered = sorted(own, key=lambda w: (frequency.get(w, 0), w))
        need = max(1, math.ceil(threshold * len(ordered) - 1e-9))
        rows += [(w, label, i, len(ordered), need) for i, w in enumerate(ordered[:len(ordered) - need + 1])]
    return spark.createDataFrame(rows, "word string, label string, place int, size int, need int")


def containing_blocks(blocks: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``(row, block, label, containment)`` for every block and template with a
    containment of at least ``threshold``. ``blocks``: ``row``, ``block`` and
    ``words``, the array of the block's distinct words that occur in any template.

    The templates are given by the caller and few, as are the words they hold;
    what is broadcast follows them, not the corpus."""
    spark = blocks.sparkSession
    words = _template_words(templates)
    counted = blocks.select(F.explode("words").alias("word")).groupBy("word").count()
    frequency = {r["word"]: r["count"] for r in counted.collect()}  # at most the templates' words
    whole = spark.createDataFrame([(k, v) for k, v in words.items()], "label string, template array<string>")
    least = min((max(1, math.ceil(threshold * len(v) - 1e-9)) for v in words.values()), default=1)
    joined = (blocks.where(F.size("words") >= least)
              .select("row", "block", "words", F.explode("words").alias("word"))
              .join(F.broadcast(_prefixes(spark, words, frequency, threshold)), "word")
              .where(F.size("words") >= F.col("need")))
    candidates = joined.groupBy("row", "block", "label").agg(
        F.first("words").alias("words"), F.min("place").alias("place"), F.first("size").alias("size"), F.first("need").alias("need"))
    held = F.size(F.array_intersect("words", "template"))
    return (candidates.where(F.col("size") - F.col("place") >= F.col("need"))
            .join(F.broadcast(whole), "label").withColumn("held", held).where(F.col("held") >= F.col("need"))
            .select("row", "block", "label", (F.col("held") / F.col("size")).alias("containment")))


def scan_licenses(docs: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD, phrases=PHRASES) -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score)``, one row for each of ``docs``; labels are sorted arrays.

    ``n_base`` counts the places of the phrases, ``first_word`` and ``last_word``
    are their least and greatest starts (null without any). ``labels`` adds the
    templates that a block contains, and ``score`` is the greatest containment
    found (0 if none reaches the threshold). Blocks are what blank lines part. A
    null or empty text has no words; repeated rows get a row each; other columns
    are ignored; an empty table gives an empty one."""
    vocabulary = sorted({w for own in _template_words(templates).values() for w in own})
    known = F.array(*[F.lit(w) for w in vocabulary])
    lowered = docs.select(col(docs, "doc_id").alias("doc_id"), _lower(col(docs, "text").cast("string")).alias("lower"))
    padded = lowered.withColumn("padded", _padded(F.col("lower")))
    blocks = F.transform(F.split("lower", _BLANK_LINE), lambda b: F.array_intersect(F.split(b, _BREAK), known))
    scanned = written(padded.select("doc_id", F.monotonically_increasing_id().alias("row"),
                                    *[e.alias(n) for n, e in phrase_columns("padded", phrases).items()],
                                    blocks.alias("blocks")), "licenses")
    each = scanned.select("row", F.posexplode("blocks").alias("block", "words"))
    found = containing_blocks(each, templates, threshold).groupBy("row").agg(
        F.collect_set("label").alias("found"), F.max("containment").alias("score"))  # at most one a template
    none = F.array().cast("array<string>")
    return scanned.join(found, "row", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels",
        F.array_sort(F.array_union("base_labels", F.coalesce("found", none))).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))


def _sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_SQL_PHRASES = ", ".join(f"({_sql_list(p.split())}, '{label}')" for p, label in PHRASES)
_SQL_TEMPLATES = ", ".join(f"('{k}', {_sql_list(v)})" for k, v in _template_words(TEMPLATES).items())
OP6_SQL = f"""
WITH docs AS (SELECT doc_id, text, {WORDS_SQL} AS w FROM documents),
phrases(words, label) AS (VALUES {_SQL_PHRASES}),
templates(label, words) AS (VALUES {_SQL_TEMPLATES}),
places AS (SELECT doc_id, p.label, i - 1 AS pos FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM docs), phrases p
           WHERE w[i] = p.words[1] AND w[i:i + len(p.words) - 1] = p.words),
base AS (SELECT doc_id, count(*) AS n, min(pos) AS lo, max(pos) AS hi, list_sort(list(DISTINCT label)) AS labels FROM places GROUP BY doc_id),
blocks AS (SELECT doc_id, regexp_extract_all(translate(unnest(regexp_split_to_array(coalesce(text, ''), '\\n[ \\t\\r\\x0B\\f]*\\n')),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM docs),
held AS (SELECT doc_id, t.label, len(list_intersect(t.words, b.w)) / len(t.words) AS part FROM blocks b, templates t),
method AS (SELECT doc_id, max(part) AS score, list(DISTINCT label) AS labels FROM held WHERE part >= {THRESHOLD} - 1e-9 GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(b.n, 0) AS BIGINT) AS n_base,
       CAST(b.lo AS BIGINT) AS first_word, CAST(b.hi AS BIGINT) AS last_word,
       coalesce(array_to_string(b.labels, ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(coalesce(b.labels, []) || coalesce(m.labels, []))), ','), '') AS labels,
       round(coalesce(m.score, 0), 6) AS score
FROM docs d LEFT JOIN base b ON d.doc_id = b.doc_id LEFT JOIN method m ON d.doc_id = m.doc_id
"""


@query("op6_licenses", OP6_SQL)
def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word",
                        F.array_join("base_labels", ",").alias("base_labels"),
                        F.array_join("labels", ",").alias("labels"), F.round("score", 6).alias("score"))
