"""Fill-in-the-middle transformation with a piece table.

A document becomes a list of descriptors ``(buffer, start, stop)`` over two
immutable buffers: its text, and the sentinels. Cutting a document splits
descriptors; putting it into prefix-suffix-middle order permutes them and sets
sentinel descriptors between; no text is copied until a result is written out, a
hash runs over the descriptors' slices. The way back reads the output as a buffer
of its own, cuts it at the sentinels, leaves these out and applies the inverse
permutation.

A text is cut at token borders (a run of letters, or any other character) that
hang on its id alone, so a rerun or a lost executor gives the same example. Every
document is a row of its own; a task has one text in hand beside its batch.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from textflow.llm.catalog import query
from textflow.llm.common import col, private_name
from textflow.plans.catalog import table

# The sentinels, which one buffer holds one after the other.
SENTINELS = "<P><S><M>"
MARK = {"prefix": ("marks", 0, 3), "suffix": ("marks", 3, 6), "middle": ("marks", 6, 9)}
#: Order of the parts in an output, by form; a part's sentinel stands before it.
ORDERS = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
PARTS = ("prefix", "middle", "suffix")   # as they stand in the text
SEED = "1:"
RATE = 90           # of 100 documents get an arrangement
SPM_RATE = 20       # of 100 arranged ones are spm
SLICE = 1 << 16     # characters that are encoded for a hash at a time

Piece = tuple[str, int, int]


@dataclass(frozen=True)
class PieceTable:
    """Immutable ``buffers`` (name to text) and the descriptors of a document over them."""

    buffers: dict[str, str]
    pieces: tuple[Piece, ...]

    @classmethod
    def of(cls, text: str) -> "PieceTable":
        return cls({"text": text, "marks": SENTINELS}, (("text", 0, len(text)),) if text else ())

    def cut(self, *places: int) -> list["PieceTable"]:
        """The document split at ``places`` (ascending offsets of the document), as one
        table a part; a descriptor that a place falls into becomes two."""
        parts: list[list[Piece]] = [[] for _ in range(len(places) + 1)]
        at, k = 0, 0
        for buffer, start, stop in self.pieces:
            while k < len(places) and places[k] < at + stop - start:
                if places[k] > at:
                    parts[k].append((buffer, start, start + places[k] - at))
                    start, at = start + places[k] - at, places[k]
                k += 1
            if stop > start:
                parts[k].append((buffer, start, stop))
            at += stop - start
        return [PieceTable(self.buffers, tuple(p)) for p in parts]

    def joined(self, *others: "PieceTable | Piece") -> "PieceTable":
        """The document followed by other documents over the same buffers, or by descriptors."""
        more = [p for o in others for p in (o.pieces if isinstance(o, PieceTable) else (o,))]
        return PieceTable(self.buffers, (*self.pieces, *more))

    def slices(self) -> Iterator[str]:
        for buffer, start, stop in self.pieces:
            for at in range(start, stop, SLICE):
                yield self.buffers[buffer][at:min(stop, at + SLICE)]

    def __len__(self) -> int:
        return sum(stop - start for _, start, stop in self.pieces)

    def __str__(self) -> str:
        return "".join(self.slices())

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for part in self.slices():
            digest.update(part.encode("utf-8", "surrogatepass"))
        return digest.hexdigest()


def arranged(text: str, low: int, high: int, form: str) -> PieceTable:
    """The output of ``text`` cut at ``low`` and ``high``, as descriptors."""
    whole = PieceTable.of(text)
    if form not in ORDERS:
        return whole
    parts = dict(zip(PARTS, whole.cut(low, high)))
    out = PieceTable(whole.buffers, ())
    return out.joined(*[x for name in ORDERS[form] for x in (MARK[name], parts[name])])


def restored(output: str, form: str) -> PieceTable:
    """The text that ``output`` was made of: cut at its sentinels, which can't stand
    anywhere else in it, and put back into the order of the text."""
    whole = PieceTable.of(output)
    if form not in ORDERS:
        return whole
    order, places, at = ORDERS[form], [], 0
    for name in order:
        mark = SENTINELS[MARK[name][1]:MARK[name][2]]
        at = output.index(mark, at)
        places += [at, at + len(mark)]
        at += len(mark)
    found = dict(zip(order, whole.cut(*places)[2::2]))
    return PieceTable(whole.buffers, ()).joined(*[found[name] for name in PARTS])


def token_starts(text: str) -> np.ndarray:
    """Offsets in code points at which the tokens ``[A-Za-z]+|[^A-Za-z]`` begin."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4") | 32
    letter = (codes >= 97) & (codes <= 122)
    begins = ~letter
    begins[:1] = True
    begins[1:] |= ~letter[:-1]
    return np.flatnonzero(begins)


def described(text: str, key: str, rate: int = RATE, spm_rate: int = SPM_RATE) -> tuple[int, str, PieceTable]:
    """Tokens, form and output of a text whose draws come from ``key``."""
    digest = hashlib.sha256(key.encode()).hexdigest()
    first, second, third, fourth = (int(digest[8 * k:8 * k + 8], 16) for k in range(4))
    starts = token_starts(text)
    n = len(starts)
    low, high = (int(starts[k]) if k < n else len(text) for k in sorted((first % (n + 1), second % (n + 1))))
    marks = (SENTINELS[start:stop] for _, start, stop in MARK.values())
    if not text or any(m in text for m in marks) or third % 100 >= rate:
        return n, "plain", PieceTable.of(text)
    form = "spm" if fourth % 100 < spm_rate else "psm"
    return n, form, arranged(text, low, high, form)


def over(text: str, pieces) -> PieceTable:
    """The piece table that descriptors of a row stand for."""
    return PieceTable({"text": text, "marks": SENTINELS}, tuple((p["buffer"], p["start"], p["stop"]) for p in pieces))


_TEXT, _LONG = T.StringType(), T.LongType()
_PIECE = T.StructType().add("buffer", _TEXT).add("start", _LONG).add("stop", _LONG)
_MADE = T.StructType().add("n", _LONG).add("form", _TEXT).add("pieces", T.ArrayType(_PIECE))


def describe(docs: DataFrame, n: str = "n", form: str = "form", pieces: str = "pieces", seed: str = SEED,
             rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """``docs`` with the number of tokens, the form (``plain``, ``psm`` or ``spm``)
    and the descriptors of each document's output, in order.

    ``rate`` of 100 documents are arranged, ``spm_rate`` of 100 of those as spm; all
    draws come from the hash of ``seed`` and the id. Empty and null texts, and texts
    that hold a sentinel themselves, stay plain (a null text counts as empty). Rows
    that repeat an id get equal draws, repeated rows equal results; a null id draws
    like an empty one. Texts may be of any length: a document has at most six
    descriptors. Columns of ``docs`` called like an added one give way to it; an
    empty table stays empty."""

    @pandas_udf(_MADE)
    def made(text: pd.Series, key: pd.Series) -> pd.DataFrame:
        rows = []
        for t, k in zip(text, key):
            tokens, kind, out = described(t, k, rate, spm_rate)
            rows.append((tokens, kind, [dict(zip(("buffer", "start", "stop"), p)) for p in out.pieces]))
        return pd.DataFrame(rows, columns=["n", "form", "pieces"])

    key = F.concat(F.lit(seed), F.coalesce(col(docs, "doc_id").cast("string"), F.lit("")))
    whole = private_name(docs, "made")
    full = docs.withColumn(whole, made(_text(docs), key))
    added = {n: "n", form: "form", pieces: "pieces"}
    kept = [col(full, c).alias(c) for c in docs.columns if c.lower() not in {a.lower() for a in added}]
    return full.select(*kept, *[F.col(whole)[part].alias(name) for name, part in added.items()])


def _text(docs: DataFrame) -> Column:
    return F.coalesce(col(docs, "text").cast("string"), F.lit(""))


@pandas_udf(_TEXT)
def _written(text: pd.Series, pieces: pd.Series) -> pd.Series:
    return pd.Series([str(over(t, p)) for t, p in zip(text, pieces)], dtype=object)


@pandas_udf(_TEXT)
def _restored(output: pd.Series, form: pd.Series) -> pd.Series:
    return pd.Series([str(restored(o, f)) for o, f in zip(output, form)], dtype=object)


@pandas_udf(T.StructType().add("output_sha256", _TEXT).add("restored_sha256", _TEXT))
def _digests(text: pd.Series, pieces: pd.Series, form: pd.Series) -> pd.DataFrame:
    rows = []
    for t, p, f in zip(text, pieces, form):
        out = over(t, p)
        rows.append((out.sha256(), restored(str(out), f).sha256()))
    return pd.DataFrame(rows, columns=["output_sha256", "restored_sha256"])


def write_out(described_docs: DataFrame, output: str = "output", pieces: str = "pieces") -> DataFrame:
    """Documents with descriptors, with the text that these stand for."""
    return described_docs.withColumn(output, _written(_text(described_docs), col(described_docs, pieces)))


def read_back(written_out: DataFrame, text: str = "restored", output: str = "output", form: str = "form") -> DataFrame:
    """Written documents with the text that was transformed, from output and form alone."""
    return written_out.withColumn(text, _restored(col(written_out, output), col(written_out, form)))


_SQL_TOKENS = "regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]')"
OP13_SQL = f"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('{SEED}' || CAST(doc_id AS VARCHAR)) AS h FROM documents),
drawn AS (
  SELECT doc_id, text, {_SQL_TOKENS} AS tokens, {', '.join(f"CAST('0x' || substr(h, {8 * k + 1}, 8) AS BIGINT) AS h{k + 1}" for k in range(4))} FROM docs),
cut AS (
  SELECT *, CAST(len(tokens) AS BIGINT) AS n, least(h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)) AS low,
         greatest(h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)) AS high,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= {RATE} THEN 'plain'
              WHEN h4 % 100 < {SPM_RATE} THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (
  SELECT *, array_to_string(list_slice(tokens, 1, low), '') AS prefix,
         array_to_string(list_slice(tokens, low + 1, high), '') AS middle,
         array_to_string(list_slice(tokens, high + 1, n), '') AS suffix FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""


@query("op13_fill_middle", OP13_SQL)
def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = describe(table(spark, sf_dir, "documents").select("doc_id", "text"))
    mark = F.lit("text")

    def chars(part: str) -> Column:
        """Length of the descriptor after the part's sentinel; none means an empty part."""
        begin = F.lit(MARK[part][1])
        at = F.array_position(F.transform("pieces", lambda d: (d["buffer"] != mark) & (d["start"] == begin)), F.lit(True))
        after = F.try_element_at("pieces", (at + 1).cast("int"))
        size = F.when(after["buffer"] == mark, after["stop"] - after["start"]).otherwise(F.lit(0))
        return F.when(F.col("form") != "plain", size.cast("long"))

    sums = _digests(_text(made), F.col("pieces"), F.col("form"))
    return (made.withColumn("sums", sums)
            .select("doc_id", "n", "form", chars("prefix").alias("prefix_chars"), chars("middle").alias("middle_chars"),
                    "sums.output_sha256", "sums.restored_sha256"))
