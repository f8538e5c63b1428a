"""A corpus pipeline of the training-data operators.

``STAGES`` are applied in order to ``documents``, each to all that its
predecessor kept; every stage's result is written to the shared folder and read
back, so a lost executor never costs more than the stage at hand.

All stages take any table with the columns of ``documents``, in any order and beside
any others, which they hand on as they are. An empty table stays empty. Rows are
documents: rows that repeat an id are documents of their own, and what decides between
them is said below. Texts are looked at whole, however long."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textflow.llm import decontaminate, line_dedup, mixing, simhash, toxicity
from textflow.llm.common import written
from textflow.plans.catalog import table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score rejects go. A text's score hangs on it alone, so
    repeated rows go or stay together; null and empty texts are judged like others; a
    document without a label is scored like any other."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of lines go, for longer lines within two edits, and documents
    that lose all their lines; the character count follows the text. The earlier of two
    lines is that of the smaller id (null last), then of the smaller row hash, then the
    one that stands first; wholly equal rows count as one document and get the same
    text. Null and empty texts and blank lines stay."""
    kept = line_dedup.drop_emptied(docs, edits=2)
    if "n_chars" not in docs.columns:
        return kept
    count = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return kept.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(count))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: that of the smallest id (null
    last), ties by the row's hash; of wholly equal rows one. Texts without words, null
    ones among them, are one group."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go. Null and empty texts have none and
    stay; repeated rows go or stay together; without benchmark items all stay."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, in its order, with the words it takes of
    each (``taken``), the figures it follows from and the virtual finish time. Documents
    without words are never taken; a null source is a source of its own; rows that
    repeat an id are served in the order of their sizes, then of the row's hash."""
    return mixing.mix(docs).where("taken > 0")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("source mixing", mix_sources),
]

#: SQL can't express the learned lexicon of the first stage; tests/llm hold the
#: stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage for ``documents`` in ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
