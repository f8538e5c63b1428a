"""Preparing labelled text: naming, label binarisation, trimming, sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textflow.functions.keyed import BUCKETS, keyed_bucket


def binarise_label(col: Column | str, positive: int = 4) -> Column:
    """``(try_cast(col as int) == positive)`` as 0/1; null stays null.

    ``try_cast`` keeps a non-numeric value as null under ANSI mode (the
    Spark 4 default) instead of failing the job."""
    c = F.col(col) if isinstance(col, str) else col
    return (c.cast("string").try_cast("int") == F.lit(positive)).cast("int")


def labelled_from_raw(
    raw: DataFrame,
    polarity_col: str = "polarity",
    text_col: str = "text",
    positive: int = 4,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Six-column corpus to ``(label, text)`` plus any ``keep`` columns.

    ``label = (polarity == positive)`` as 0/1; every other value becomes 0 and
    null stays null. Only the used columns are read (Catalyst prunes the CSV
    or Parquet scan to them).
    """
    label = binarise_label(polarity_col, positive)
    return raw.select(*[F.col(k) for k in keep], label.alias("label"), F.col(text_col).alias("text"))


def trim_text(df: DataFrame, col: str = "text") -> DataFrame:
    """Strip leading/trailing spaces (spaces only, like SQL ``trim``)."""
    return df.withColumn(col, F.trim(F.col(col)))


def split_null_text(df: DataFrame, col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Rows that can be featurised, and the rows whose text is null.

    The ML tokenizer fails the whole job on a null string; the null rows are
    split off instead (and counted by the profile)."""
    return df.where(F.col(col).isNotNull()), df.where(F.col(col).isNull())


def sample_rows(
    df: DataFrame, fraction: float, seed: int = 42, key: str | None = None
) -> DataFrame:
    """Bernoulli sample, only when ``fraction < 1``.

    With ``key`` the sample is keyed (a row is in or out by the hash of its
    key, stable under re-partitioning and retries); without it Spark's
    per-partition ``sample`` is used as the reference does."""
    if fraction >= 1.0:
        return df
    if key is None:
        return df.sample(fraction=fraction, seed=seed)
    cut = int(round(fraction * BUCKETS))
    return df.where(keyed_bucket(key, salt=f"sample:{seed}") < F.lit(cut))


def cap_rows(df: DataFrame, max_rows: int, key: str | None = None) -> DataFrame:
    """Row cap for quick runs (``max_rows > 0``).

    Without ``key`` this is ``limit`` (any rows, stops reading early). With
    ``key`` the kept rows are deterministic: the first ``max_rows`` in
    ``(keyed bucket, key)`` order, found without sorting the rows. A histogram
    of the 10,000 key buckets (one small partial aggregate) gives the bucket
    where the running count reaches ``max_rows``; of that bucket alone (a ten
    thousandth of the table) the keys are ranked to find the last one kept.
    The rows are then filtered where they are read, in as many tasks as the
    scan has. Rows that share the last key are kept together."""
    if max_rows <= 0:
        return df
    if key is None:
        return df.limit(max_rows)
    bucket = keyed_bucket(key, salt="cap")
    hist = df.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.orderBy("b"))
    edge = (hist.select("b", (F.lit(max_rows) - (upto - F.col("n"))).alias("need"), upto.alias("upto"))
            .where(F.col("upto") >= F.lit(max_rows)))
    # scalar subqueries: planned with the capped query, no eager job
    cut = edge.select(F.min("b")).scalar()
    need = edge.select(F.min_by("need", "b")).scalar()
    keys = df.select(bucket.alias("b"), F.col(key).alias("k")).where(F.col("b") == cut)
    last = (keys.select("k", F.row_number().over(Window.orderBy("k")).alias("place"))
            .where(F.col("place") == need).select(F.max("k")).scalar())
    return df.where(cut.isNull() | (bucket < cut) | ((bucket == cut) & (F.col(key) <= last)))


def ensure_text_column(df: DataFrame, col: str = "text") -> DataFrame:
    """Guarantee a ``text`` column: a sole column is renamed, otherwise error."""
    if col in df.columns:
        return df
    if len(df.columns) == 1:
        return df.withColumnRenamed(df.columns[0], col)
    raise ValueError(f"no '{col}' column and more than one column to choose from: {df.columns}")
