"""I-Match document fingerprints over randomised lexicon subsets.

The lexicon holds the words whose inverse document frequency lies in a band. A
document's fingerprint is one hash for each of several random subsets of the
lexicon: the hash of the document's sorted distinct words that are in the
subset. Subsets are drawn by a hash of the word, so they need no table. About
half of the lexicon is in no sparse subset, so the last subset is the whole
lexicon; a text with few words in the sparse ones also gets a hash of all its
distinct words. Texts that share a few drawn words alone stay apart by these.

Size of the lexicon: a word of the band is in at least ``MIN_SHARE`` of the
documents, so there are at most (mean distinct words a document) / ``MIN_SHARE``
of them, however many documents there are. That bound, not the corpus, sets what
is sent to the tasks.
"""

from __future__ import annotations

import hashlib
import struct
from collections import Counter
from typing import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textflow.llm.catalog import query
from textflow.llm.common import col
from textflow.llm.words import words_of
from textflow.plans.catalog import table

MIN_SHARE = 0.001        # least share of the documents that a band word is in (idf <= ln 1000)
MAX_SHARE = 0.2          # largest share (idf >= ln 5)
#: Random subsets of the lexicon by the share of words they keep (one in so many):
#: dense ones tell short texts apart, sparse ones still agree for edited long texts,
#: the last one holds every word of the band.
SUBSETS = (32,) * 16 + (128,) * 16 + (512,) * 16 + (1,)
FEW_WORDS = 8            # fewer words in the sparse subsets: all distinct words are hashed too
SEED = 20240607
FLUSH_WORDS = 400_000    # words a task counts before it hands them on
WORDS_KEPT = 1_000_000   # words whose lexicon entry a task remembers
MAX_LEXICON = 4_000_000  # the broadcast's bound; a corpus beyond it needs a higher MIN_SHARE


def _count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: Counter = Counter()
    docs = 0

    def flush():
        hashes = np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in counts), dtype=np.uint64, count=len(counts))
        out = pd.DataFrame({"word": hashes.view(np.int64), "n": np.fromiter(counts.values(), np.int64, len(counts)), "kind": 1})
        counts.clear()
        return out

    for batch in batches:
        for text in batch["text"]:
            counts.update(set(words_of(text)))
            docs += 1
            if len(counts) > FLUSH_WORDS:
                yield flush()
    yield flush()
    yield pd.DataFrame({"word": [0], "n": [docs], "kind": [0]})


def lexicon(docs: DataFrame, min_share: float = MIN_SHARE, max_share: float = MAX_SHARE) -> np.ndarray:
    """The band's words as sorted 64-bit hashes. Document frequencies are counted
    over all of ``docs``; a task adds its documents up before anything is
    shuffled. An empty corpus has an empty lexicon."""
    texts = docs.select(col(docs, "text").cast("string").alias("text"))
    counts = (texts.mapInPandas(_count_words, "word long, n long, kind int")
              .groupBy("kind", "word").agg(F.sum("n").alias("n")).persist())
    try:
        total = counts.where("kind = 0").agg(F.sum("n")).first()[0] or 0
        band = counts.where("kind = 1").where(F.col("n").between(min_share * total, max_share * total) & (F.col("n") > 1))
        rows = band.select("word").limit(MAX_LEXICON + 1).toPandas()
        if len(rows) > MAX_LEXICON:
            raise ValueError(f"more than {MAX_LEXICON} words in the band: raise min_share")
        return np.sort(rows["word"].to_numpy(np.int64).view(np.uint64))
    finally:
        counts.unpersist()


class Imatch:
    """Fingerprints for one lexicon (unsigned hashes of its words)."""

    def __init__(self, lexicon: np.ndarray):
        self.lexicon = set(lexicon.tolist())
        self.seen: dict = {}  # word -> None, or its hash and subsets

    def _look_up(self, word: bytes):
        h = xxhash.xxh64_intdigest(word, SEED)
        entry = None
        if h in self.lexicon:
            draws = struct.unpack(f"<{len(SUBSETS)}H", hashlib.shake_128(struct.pack("<Q", h)).digest(2 * len(SUBSETS)))
            entry = h, [k for k, draw in enumerate(draws) if draw % SUBSETS[k] == 0]
        if len(self.seen) >= WORDS_KEPT:
            self.seen.clear()
        self.seen[word] = entry
        return entry

    def subset_hashes(self, text: str | None) -> list[str]:
        """A hash of eight hex digits for each subset, '' for a subset none of
        whose words are in the text, and last a hash of all distinct words if fewer
        than ``FEW_WORDS`` of them are in sparse subsets, '' otherwise."""
        words = set(words_of(text))
        seen, look_up = self.seen, self._look_up
        members: list[list[int]] = [[] for _ in SUBSETS]
        drawn = 0
        for word in words:
            entry = seen[word] if word in seen else look_up(word)
            if entry is not None:
                drawn += len(entry[1]) > 1  # in the last subset they all are
                for k in entry[1]:
                    members[k].append(entry[0])
        digest = xxhash.xxh64_intdigest
        out = [f"{digest(struct.pack(f'<{len(m)}Q', *sorted(m)), k) >> 32:08x}" if m else "" for k, m in enumerate(members)]
        out.append(f"*{digest(b' '.join(sorted(words)), SEED):016x}" if drawn < FEW_WORDS else "")
        return out

    def fingerprint(self, text: str | None) -> str:
        return ".".join(self.subset_hashes(text))


def likeness(a: str, b: str) -> float:
    """Share of equal hashes among those that either text has (0 to 1)."""
    pairs = [(x, y) for x, y in zip(a.split("."), b.split(".")) if x or y]
    return sum(x == y for x, y in pairs) / len(pairs) if pairs else 1.0


def with_fingerprint(docs: DataFrame, into: str, words: np.ndarray | None = None) -> DataFrame:
    """``docs`` with the fingerprint of each whole text in ``into``. A null text
    counts as an empty one; equal texts have equal fingerprints."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon(docs) if words is None else words)

    @F.pandas_udf("string")
    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        made = Imatch(shared.value)
        for texts in batches:
            yield pd.Series([made.fingerprint(t) for t in texts])

    return docs.withColumn(into, prints(col(docs, "text").cast("string")))


# --- each text beside the next document's --------------------------------------

def _borders(ids: DataFrame, parts: int) -> tuple[list, list]:
    """Borders that cut the ids into about equal ranges, and for each range the
    id that follows its smallest in descending order."""
    cuts = ids.agg(F.percentile_approx("doc_id", F.array(*[F.lit(i / parts) for i in range(1, parts)]), 4 * parts)
                   if parts > 1 else F.lit(None)).first()[0]
    edges = sorted(set(cuts or []))
    ranged = ids.select("doc_id", _range_of(edges).alias("range"))
    most = {r["range"]: r["most"] for r in ranged.groupBy("range").agg(F.max("doc_id").alias("most")).collect()}
    top = max((v for v in most.values() if v is not None), default=None)
    follows, below = {}, None
    for k in range(-1, len(edges) + 1):
        follows[k] = below if below is not None else top
        below = most.get(k) if most.get(k) is not None else below
    return edges, follows


def _range_of(edges: list):
    """Number of borders at or below an id; -1 for a null id, which comes last."""
    marks = F.array(*[F.lit(e) for e in edges]) if edges else F.array().cast("array<bigint>")
    return F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(
        F.size(F.filter(marks, lambda e: e <= F.col("doc_id"))))


def beside_next(docs: DataFrame, use, schema: str, parts: int | None = None) -> DataFrame:
    """Applies ``use(doc_id, text, next_text)`` (a row of ``schema``) to every
    document and the next one in descending order of ``doc_id``; after the last
    comes the first. Rows that repeat an id follow each other by text; a null text
    counts as empty. Documents without an id follow each other by text, the last
    of them is followed by the first document, and none of them follows one that
    has an id. A single document follows itself; an empty table gives no rows.

    The documents are dealt into ranges of ids and sorted within them, and each
    range also gets a copy of the one document that follows it, so every task
    walks its rows with one of them in hand and nothing is gathered."""
    rows = docs.select(col(docs, "doc_id").cast("long").alias("doc_id"),
                       F.coalesce(col(docs, "text").cast("string"), F.lit("")).alias("text"))
    parts = parts or max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    edges, follows = _borders(rows.select("doc_id"), parts)
    own = rows.select("doc_id", "text", _range_of(edges).alias("range"), F.lit(0).alias("guest"))
    wanted = [(k, v) for k, v in follows.items() if v is not None]
    guests = docs.sparkSession.createDataFrame(wanted, "range int, guest_id long") if wanted else None
    if guests is not None:
        found = rows.where(F.col("doc_id").isin(sorted({v for _, v in wanted}))).groupBy("doc_id").agg(F.min("text").alias("text"))
        visiting = found.join(F.broadcast(guests), found["doc_id"] == guests["guest_id"]).select(
            "doc_id", "text", "range", F.lit(1).alias("guest"))
        own = own.union(visiting)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        first: dict = {}
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                if held is not None and held.range == row.range and not held.guest:
                    out.append(use(None if pd.isna(held.doc_id) else int(held.doc_id), held.text, row.text))
                elif held is not None and not held.guest:
                    out.append(use(None if pd.isna(held.doc_id) else int(held.doc_id), held.text, first["text"]))
                if held is None or held.range != row.range:
                    first = {"text": row.text}
                held = row
            if out:
                yield pd.DataFrame(out, columns=names)
        if held is not None and not held.guest:  # a range without a guest holds the whole table
            yield pd.DataFrame([use(None if pd.isna(held.doc_id) else int(held.doc_id), held.text, first["text"])], columns=names)

    names = [part.split()[0] for part in schema.split(",")]
    dealt = own.repartition(max(1, len(edges) + 1), "range").sortWithinPartitions(
        F.col("range"), F.col("guest"), F.col("doc_id").desc_nulls_last(), F.col("text"))
    return dealt.mapInPandas(walk, schema)


_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")


@query("op10_imatch")
def op10_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    shared = spark.sparkContext.broadcast(lexicon(docs))
    made: list = []

    def use(doc_id, text, after):
        if not made:
            made.extend([Imatch(shared.value), None, None])
        imatch, known, print_ = made
        if known != text:
            print_ = imatch.fingerprint(text)
        cut = len(text) // 3
        edited = text[:len(text) - cut] + after[:cut]
        next_print = imatch.fingerprint(after)
        made[1:] = [after, next_print]  # the next row's own
        edited_print = imatch.fingerprint(edited)
        digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
        return doc_id, len(text), digest, print_, edited_print, likeness(print_, edited_print), likeness(print_, next_print)

    return beside_next(docs, use, _SCHEMA)
