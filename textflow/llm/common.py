"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textflow.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to a fresh folder of the cluster's shared
    checkpoint directory and read back: cuts the lineage, and a lost executor
    costs a re-read instead of a recomputation."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def private_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (inputs may carry any columns)."""
    while True:
        name = f"{stem}_{uuid.uuid4().hex[:8]}"
        if name.lower() not in {c.lower() for c in df.columns}:
            return name


def text_of(col: str = "text") -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def col(df: DataFrame, name: str) -> Column:
    """A column of ``df`` by its exact name, dots and all."""
    return df["`" + name.replace("`", "``") + "`"]


def row_hash(df: DataFrame) -> Column:
    """A hash over all columns (maps, which Spark doesn't hash, left out): the
    last tie-break between rows that repeat an id."""
    names = [c for c, kind in df.dtypes if "map<" not in kind]
    return F.xxhash64(*[col(df, c) for c in names])
