"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are the windows of the test items: every ``window`` consecutive
words, or a shorter item as a whole. Patterns of one length share tables: a
block is the last two words under the search position; the shift table says how
far the position may move on for that block, a shift of zero leads to the bucket
of the patterns that end in this block, and those are compared word by word.
"""

from __future__ import annotations

from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textflow.llm.catalog import query
from textflow.llm.common import col, private_name, written
from textflow.llm.words import WORDS_SQL, words_of
from textflow.plans.catalog import table

WINDOW = 10
#: Benchmark words searched for in one pass; a larger benchmark takes several passes.
WORDS_A_PASS = 1_000_000

_FOUND = "n_words long, n_hit long, items array<string>, starts array<long>, ends array<long>"


class Patterns:
    """Shift table and buckets for the patterns of one length."""

    def __init__(self, length: int):
        self.length, self.block = length, min(2, length)
        self.default = length - self.block + 1
        self.shift: dict = {}
        self.buckets: dict = {}

    def add(self, words: list[bytes], name: str | None) -> None:
        m, b = self.length, self.block
        for start in range(len(words) - m + 1):
            for end in range(b, m + 1):
                key = tuple(words[start + end - b:start + end])
                self.shift[key] = min(self.shift.get(key, self.default), m - end)
            self.buckets.setdefault(key, []).append((words, start, name))

    def search(self, words: list[bytes], hits: list, names: set) -> None:
        """Appends the hit ranges of word positions and adds the items' names."""
        m, b, default = self.length, self.block, self.default
        shift, at, n = self.shift, self.length, len(words)
        while at <= n:
            key = tuple(words[at - b:at])
            step = shift.get(key, default)
            if step:
                at += step
                continue
            here = words[at - m:at]
            found = False
            for item, start, name in self.buckets[key]:
                if item[start:start + m] == here:
                    found = True
                    names.add(name)
            if found:
                hits.append((at - m, at))
            at += 1


def build_patterns(items: list[tuple], window: int = WINDOW) -> list[Patterns]:
    """Tables for ``(item_id, text)`` rows, by pattern length; items without
    words give none."""
    tables: dict[int, Patterns] = {}
    for item_id, text in items:
        words = words_of(text)
        if words:
            length = min(window, len(words))
            tables.setdefault(length, Patterns(length)).add(words, None if item_id is None else str(item_id))
    return list(tables.values())


def _merged(ranges: list[tuple]) -> list[list]:
    out: list[list] = []
    for lo, hi in sorted(ranges):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(hi, out[-1][1])
        else:
            out.append([lo, hi])
    return out


def _passes(benchmark: DataFrame, words_a_pass: int) -> Iterator[list]:
    """The items in groups of about ``words_a_pass`` words, one group at a time."""
    group, size = [], 0
    for row in benchmark.select(col(benchmark, "item_id"), col(benchmark, "text").cast("string")).toLocalIterator():
        group.append(tuple(row))
        size += len(words_of(row[1]))
        if size >= words_a_pass:
            yield group
            group, size = [], 0
    if group:
        yield group


def _search_column(shared, text, found):
    @F.pandas_udf(_FOUND)
    def search(batches: Iterator[tuple[pd.Series, pd.DataFrame]]) -> Iterator[pd.DataFrame]:
        tables = shared.value
        for texts, before in batches:
            out = []
            for text, items, starts, ends in zip(texts, before["items"], before["starts"], before["ends"]):
                words, hits, names = words_of(text), [], set()
                for patterns in tables:
                    patterns.search(words, hits, names)
                if starts is not None:
                    hits += zip(starts, ends)
                    names.update(items)
                ranges = _merged(hits)
                out.append((len(words), sum(hi - lo for lo, hi in ranges), sorted(n for n in names if n is not None),
                            [lo for lo, _ in ranges], [hi for _, hi in ranges]))
            yield pd.DataFrame(out, columns=["n_words", "n_hit", "items", "starts", "ends"])

    return search(text, found)


def with_hits(docs: DataFrame, benchmark: DataFrame, into: str, window: int = WINDOW,
              words_a_pass: int = WORDS_A_PASS) -> DataFrame:
    """``docs`` with a struct column ``into``: ``n_words``, ``n_hit`` (words inside
    any occurrence of a window), ``items`` (distinct ids, as strings, of the
    items with occurring windows, sorted), ``starts`` and ``ends`` (the hit
    ranges of word positions, merged, end exclusive).

    Texts are searched whole. A null or empty text, or a benchmark without
    words, gives no hits. An item with a null id is searched for, but has no
    name to list; items that repeat an id count once. The benchmark goes to the
    tasks in groups of ``words_a_pass`` words, one pass over ``docs`` a group;
    between passes the rows are written to the shared folder."""
    sc = docs.sparkSession.sparkContext
    out = docs.withColumn(into, F.lit(None).cast(f"struct<{_FOUND.replace(' ', ':').replace(',:', ',')}>"))
    done = 0
    for group in _passes(benchmark, words_a_pass):
        if done:
            out = written(out, "decontaminate")
        shared = sc.broadcast(build_patterns(group, window))
        out = out.withColumn(into, _search_column(shared, col(out, "text").cast("string"), out[into]))
        done += 1
    if not done:
        out = out.withColumn(into, _search_column(sc.broadcast([]), col(out, "text").cast("string"), out[into]))
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the documents in which a benchmark window occurs, in
    their own columns; null and empty texts stay."""
    into = private_name(docs, "hits")
    out = with_hits(docs, benchmark, into, window)
    return out.where(out[into]["n_hit"] == 0).drop(into)


OP5_SQL = f"""
WITH items AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark),
     docs AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
     lengths AS (SELECT DISTINCT least({WINDOW}, len(w)) AS m FROM items WHERE len(w) > 0),
     wins AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS win
              FROM (SELECT item_id, w, least({WINDOW}, len(w)) AS m, unnest(range(1, len(w) - least({WINDOW}, len(w)) + 2)) AS i
                    FROM items WHERE len(w) > 0)),
     places AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS win
                FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM docs, lengths WHERE len(w) >= m)),
     found AS (SELECT doc_id, item_id, p.m AS m, i FROM places p JOIN wins USING (m, win)),
     hit AS (SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS pos FROM found) GROUP BY doc_id),
     named AS (SELECT doc_id, count(*) AS n, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
               FROM (SELECT DISTINCT doc_id, item_id FROM found WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(s.n, 0) AS BIGINT) AS n_items, sha256(coalesce(s.ids, '')) AS items_sha256,
       coalesce(h.n, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit h ON d.doc_id = h.doc_id LEFT JOIN named s ON d.doc_id = s.doc_id
"""


@query("op5_decontaminate", OP5_SQL)
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_hits(docs, table(spark, sf_dir, "benchmark"), "found")
    return found.select(
        "doc_id", "found.n_words", "found.n_hit", F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
        (F.col("found.n_hit") > 0).alias("contaminated"))
