"""Toxicity scores from a weighted lexicon matched by Aho-Corasick.

Texts are folded first: styled and accented Latin letters to plain ones,
look-alike letters of other scripts to Latin, digits and signs that stand for
letters in a token with letters to those letters, everything else to word breaks.
A token with such signs has several readings: with all of them as letters (1, !
and | as i or l), without those at its start or end, and as the words between
them; the one that weighs most counts. The lexicon -- whole words
and word beginnings -- is learned from labelled rows: a term enters when its
document counts in toxic and other texts differ by more than chance explains
over all terms tried, and weighs the smoothed log-odds. Words that begin like a
lexicon entry but are used in clean texts become exception phrases; they match
first, being longer, and weigh nothing. A text's score is a logistic function,
fitted on the same rows, of its matched weight over a slowly growing function of
its length.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from dataclasses import dataclass
from typing import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textflow.llm.catalog import query
from textflow.llm.common import col, private_name
from textflow.plans.catalog import table

THRESHOLD = 0.3
#: Bound of the labelled rows a lexicon is learned from (the first by a hash of their id).
MAX_TRAIN_ROWS = 20_000
MAX_TERMS = 20_000       # lexicon entries kept, the most telling first
MIN_DOCS = 3             # toxic training texts a lexicon term is in
PREFIXES = (4, 5, 6)     # lengths of word beginnings tried beside whole words
FLUSH_TERMS = 200_000    # terms a task counts before it hands them on

# Cyrillic and Greek letters that look like Latin ones, in pairs.
LOOK_ALIKES = ("а a в b с c е e һ h і i ј j к k м m н h о o р p ѕ s т t у y х x ԁ d ԛ q ԝ w "
               "α a β b ε e ι i κ k ν v ο o ρ p τ t υ u χ x").split()
# Digits and signs written for letters.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l"}

_LETTER = {ord(a): b for a, b in zip(LOOK_ALIKES[::2], LOOK_ALIKES[1::2])}
_LETTER |= {0x200B: "", 0x200C: "", 0x200D: "", 0xAD: "", 0xFEFF: ""}
_SIGN = {ord(a): b for a, b in SUBSTITUTES.items()}
_EITHER = dict.fromkeys("1!|", "il")  # signs that are either letter
_SPELLED = [_SIGN | {ord(c): letter for c in _EITHER} for letter in "il"]
_NOISE = "!$@|"                       # at a word's end rather punctuation
_CLASS = "[" + re.escape("".join(SUBSTITUTES)) + "]"
_SIGNS = re.compile(_CLASS)
_WORD = re.compile(r"[^\W\d_]+")
#: A run of letters and signs.
_TOKEN = re.compile(rf"(?:[^\W\d_]++|{_CLASS}++)++")
_MARKS = re.compile("(?<=[a-z])[\u0300-\u036f]+")


def _tokens(text: str | None) -> list[str]:
    """Runs of letters and signs of a text, with plain letters; those without a
    letter are left out."""
    if not text:
        return []
    if text.isascii():
        text = text.lower()
    else:
        text = unicodedata.normalize("NFKD", text).lower().translate(_LETTER)
        text = unicodedata.normalize("NFC", _MARKS.sub("", text))
    if not _SIGNS.search(text):
        return _WORD.findall(text)
    return [t for t in _TOKEN.findall(text) if t.isalpha() or _WORD.search(t)]


def _core(token: str) -> str:
    """A token without the signs at its end that are no letters: all but digits, and
    digits too after a single letter."""
    core = token.rstrip(_NOISE)
    return core if sum(len(w) for w in _WORD.findall(core)) > 1 else core.rstrip("".join(SUBSTITUTES))


def _readings(token: str) -> list[list[str]]:
    """What a token with signs may say, each a list of words with the signs still in
    them: as a whole, without signs at its start, its end and both, in pieces."""
    core, signs = _core(token), "".join(SUBSTITUTES)
    short = core.rstrip(signs)
    whole = dict.fromkeys([token, core, short, token.lstrip(signs), core.lstrip(signs), short.lstrip(signs)])
    return [[w] for w in whole] + [_WORD.findall(token)]


def fold(text: str | None) -> list[str]:
    """The folded words of a text: of each token one reading, 1 and ! as i."""
    return [t if t.isalpha() else _core(t).translate(_SIGN) for t in _tokens(text)]


def _spellings(text: str | None) -> Iterator[str]:
    """The words of all readings of a text's tokens, 1, ! and | all as i or all as l."""
    for token in _tokens(text):
        if token.isalpha():
            yield token
            continue
        for word in (w for words in _readings(token) for w in words):
            for signs in _SPELLED:
                yield word.translate(signs)


def terms_of(words: Iterable[str]) -> set[str]:
    """Whole words as ``'  word '``, word beginnings as ``' beg'``: each with the
    spaces that the matched text has around its words."""
    distinct = set(words)
    out = {f" {w} " for w in distinct}
    for n in PREFIXES:
        out.update(" " + w[:n] for w in distinct if len(w) > n)
    return out


@dataclass
class Lexicon:
    """``weights``: term -> weight, 0 for an exception phrase; ``slope`` and
    ``offset``: of the logistic score."""

    weights: dict[str, float]
    slope: float = 0.0
    offset: float = -5.0

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            found.add_word(term, weight)
        if len(found):
            found.make_automaton()
        return found


def _heaviest(automaton, word: str) -> float:
    """Weight of the longest match in a word with signs, the most over all letters
    that its signs may be. Only beginnings of lexicon entries are followed, so many
    signs don't multiply."""
    live, done = {" ": 0.0}, [0.0]
    for sign in [*word, " "]:
        after: dict = {}
        for begun, weight in live.items():
            went_on = False
            for letter in _EITHER.get(sign) or SUBSTITUTES.get(sign, sign):
                longer = begun + letter
                if automaton.match(longer):
                    after[longer] = automaton.get(longer, weight)
                    went_on = True
            if not went_on:
                done.append(weight)
        live = after
        if not live:
            break
    return max([*done, *live.values()])


def matched(automaton, text: str | None) -> float:
    """Weight of the longest non-overlapping matches over the length's norm; a token
    with signs counts by its heaviest reading."""
    tokens = _tokens(text)
    if not tokens or not len(automaton):
        return 0.0
    words = [t for t in tokens if t.isalpha()]
    total = sum(weight for _, weight in automaton.iter_long(" " + "  ".join(words) + " "))
    if len(words) < len(tokens):
        total += sum(max(sum(_heaviest(automaton, w) for w in words) for words in _readings(t))
                     for t in tokens if not t.isalpha())
    return total / (1.0 + math.log1p(len(tokens) / 100.0))


def _logistic(x, slope: float, offset: float):
    return 1.0 / (1.0 + np.exp(-np.clip(slope * x + offset, -60.0, 60.0)))


def is_training_row(doc_id: str = "doc_id") -> Column:
    """Rows that labels may be learned from: ``crc32(doc_id as text) mod 4`` is not 2
    (a row without an id counts as held out)."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) != 2, F.lit(False))


def _training_texts(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """``(text, label)`` of at most ``max_rows`` labelled training rows, equal
    texts once (the sample is bounded, so it may be broadcast)."""
    sample = (labels.select(col(labels, "doc_id").alias("doc_id"), col(labels, "toxic").cast("int").alias("label"))
              .where(F.col("label").isin(0, 1) & is_training_row())
              .groupBy("doc_id").agg(F.max("label").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    # the ids are collected first: the scan of the texts then filters by a fixed small table
    sample = docs.sparkSession.createDataFrame(sample.collect(), "doc_id long, label int")
    texts = docs.select(col(docs, "doc_id").alias("doc_id"), col(docs, "text").cast("string").alias("text"))
    return texts.join(F.broadcast(sample), "doc_id").groupBy(F.xxhash64("text"), "text").agg(
        F.max("label").alias("label")).select("text", "label")


def _count_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts = {0: Counter(), 1: Counter()}
    rows = [0, 0]

    def flush():
        terms = list(counts[0].keys() | counts[1].keys())
        out = pd.DataFrame({"term": pd.Series(terms, dtype=object), "clean": [counts[0][t] for t in terms],
                            "toxic": [counts[1][t] for t in terms]})
        counts[0].clear()
        counts[1].clear()
        return out

    for batch in batches:
        for text, label in zip(batch["text"], batch["label"]):
            counts[label].update(terms_of(_spellings(text)))
            rows[label] += 1
            if len(counts[0]) + len(counts[1]) > FLUSH_TERMS:
                yield flush()
    yield flush()
    yield pd.DataFrame({"term": [""], "clean": [rows[0]], "toxic": [rows[1]]})


def learn(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> Lexicon:
    """The lexicon of at most ``max_rows`` labelled rows (see the module's text).
    Rows with a null or other label, and those held out, are not used; without
    both kinds of rows the lexicon is empty and every score low."""
    train = _training_texts(docs, labels, max_rows).persist()
    try:
        counted = (train.mapInPandas(_count_terms, "term string, clean long, toxic long")
                   .groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).persist())
        totals = counted.where("term = ''").first()
        if totals is None or not totals["clean"] or not totals["toxic"]:
            return Lexicon({})
        n_clean, n_toxic = float(totals["clean"]), float(totals["toxic"])
        n_terms = counted.count()
        clean, toxic = F.col("clean").cast("double"), F.col("toxic").cast("double")
        both = clean + toxic
        share = n_toxic / (n_toxic + n_clean)

        def part(n, expected):
            return F.when(n > 0, n * F.log(n / expected)).otherwise(F.lit(0.0))

        surprise = 2 * (part(toxic, both * share) + part(clean, both * (1 - share)))
        weight = F.log((toxic + 0.5) / (n_toxic + 1)) - F.log((clean + 0.5) / (n_clean + 1))
        told = (counted.where("term <> ''").withColumn("weight", weight).withColumn("surprise", surprise)
                .where((F.col("toxic") >= MIN_DOCS) & (F.col("weight") > math.log(5.0))
                       & (F.col("surprise") > 2 * math.log(n_terms)))
                .orderBy(F.desc("surprise"), "term").limit(MAX_TERMS))
        weights = {r["term"]: float(r["weight"]) for r in told.collect()}
        starts = [t for t in weights if not t.endswith(" ")]
        if starts:
            # words of clean texts under a matched beginning, more clean than not
            small = docs.sparkSession.createDataFrame([(t,) for t in starts], "start string")
            exempt = (counted.where(F.col("term").endswith(" ") & (F.col("clean") >= 2) & (weight <= 0))
                      .withColumn("start", F.explode(F.array(*[F.substring("term", 1, n + 1) for n in PREFIXES])))
                      .join(F.broadcast(small), "start").select("term", "clean").distinct()
                      .orderBy(F.desc("clean"), "term").limit(MAX_TERMS))
            for r in exempt.collect():
                weights[r["term"]] = 0.0
        counted.unpersist()
        lexicon = Lexicon(weights)
        pairs = train.select(_match_column(lexicon, F.col("text")).alias("x"), "label").toPandas()  # at most max_rows
        lexicon.slope, lexicon.offset = _calibrate(pairs["x"].to_numpy(float), pairs["label"].to_numpy(float))
        return lexicon
    finally:
        train.unpersist()


def _calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve by Newton's method, held finite by a
    small ridge."""
    w = np.zeros(2)
    features = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(50):
        p = _logistic(x, w[0], w[1])
        gradient = features.T @ (p - y) + 0.1 * w
        hessian = (features * (p * (1 - p))[:, None]).T @ features + 0.1 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w -= np.clip(step, -2.0, 2.0)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(w[0], 0.0)), float(w[1])


def _match_column(lexicon: Lexicon, text: Column) -> Column:
    weights = lexicon.weights

    @F.pandas_udf("double")
    def match(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = Lexicon(weights).automaton()
        for texts in batches:
            yield pd.Series([matched(automaton, t) for t in texts], dtype="float64")

    return match(text)


def score_column(lexicon: Lexicon, text: Column) -> Column:
    """The toxicity score (0 to 1) of a text column; a null text scores as an
    empty one."""
    x = _match_column(lexicon, text)
    return 1.0 / (1.0 + F.exp(-(F.lit(lexicon.slope) * x + F.lit(lexicon.offset))))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that score ``threshold`` or more; all
    columns as they are. Repeated rows share their text's fate, rows with a
    null id or text are judged like others, an empty table stays empty."""
    score = private_name(docs, "toxicity")
    scored = docs.withColumn(score, score_column(learn(docs, labels), col(docs, "text").cast("string")))
    return scored.where(scored[score] < threshold).drop(score)


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lexicon = learn(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", (~is_training_row()).alias("held_out"), score_column(lexicon, docs["text"]).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
