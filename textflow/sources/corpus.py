"""Batch readers for the labelled corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textflow.operators.prep import labelled_from_raw
from textflow.schemas import RAW_CORPUS


def read_raw_corpus(
    spark: SparkSession,
    path: str,
    multi_line: bool = False,
    escape: str = '"',
    sep: str = ",",
    mode: str = "PERMISSIVE",
) -> DataFrame:
    """Headerless six-column CSV with an explicit schema (no inference pass).

    ``escape='"'`` reads doubled quotes inside quoted text correctly; keep
    ``multi_line`` off unless texts hold newlines (a multi-line CSV file is
    not splittable, so write many files)."""
    return (
        spark.read.schema(RAW_CORPUS)
        .option("header", "false")
        .option("escape", escape)
        .option("quote", '"')
        .option("sep", sep)
        .option("multiLine", str(multi_line).lower())
        .option("mode", mode)
        .csv(path)
    )


def read_labelled_csv(
    spark: SparkSession,
    path: str,
    positive: int = 4,
    keep: tuple[str, ...] = (),
    multi_line: bool = False,
) -> DataFrame:
    """The corpus as ``(label, text)``; extra raw columns via ``keep``."""
    raw = read_raw_corpus(spark, path, multi_line=multi_line)
    return labelled_from_raw(raw, positive=positive, keep=keep)


def corrupt_rows(spark: SparkSession, path: str, multi_line: bool = False, escape: str = '"') -> DataFrame:
    """One row ``(total_rows, corrupt_rows)`` of a corpus file: records with fewer
    or more fields than six, or fields of the wrong type, count as corrupt. The
    reader itself keeps such records with nulls in place of what is missing, so
    the profile should show this figure beside the null counts.

    Every column is read (a pruned scan cannot tell a ragged record)."""
    names = [f.name for f in RAW_CORPUS.fields]
    schema = T.StructType([*RAW_CORPUS.fields, T.StructField("_corrupt", T.StringType(), True)])
    raw = (spark.read.schema(schema).option("header", "false").option("escape", escape).option("quote", '"')
           .option("multiLine", str(multi_line).lower()).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", "_corrupt").csv(path))
    whole = F.pmod(F.xxhash64(*names), F.lit(2)) >= 0   # always true, and needs all columns
    return raw.agg(F.count_if(whole).alias("total_rows"),
                   F.count_if(whole & F.col("_corrupt").isNotNull()).alias("corrupt_rows"))


def check_arity(spark: SparkSession, path: str, expected: int = 6, multi_line: bool = False) -> None:
    """Fail early when the file has fewer columns than the corpus needs.

    Reads only the first record (a ``limit(1)`` scan of one split)."""
    first = (
        spark.read.option("header", "false").option("escape", '"')
        .option("multiLine", str(multi_line).lower()).csv(path).limit(1).collect()
    )
    if not first:
        raise ValueError(f"input {path} is empty")
    if len(first[0]) < expected:
        raise ValueError(f"input {path} has {len(first[0])} columns, expected {expected}")


def write_raw_corpus(df: DataFrame, path: str) -> None:
    """Write a six-column frame as headerless CSV readable by :func:`read_raw_corpus`."""
    (
        df.select(*[F.col(f.name).cast(f.dataType) for f in RAW_CORPUS.fields])
        .write.mode("overwrite")
        .option("header", "false")
        .option("escape", '"')
        .option("quote", '"')
        .csv(path)
    )
