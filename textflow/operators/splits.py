"""Train / validation / test splits and k-fold assignment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textflow.functions.keyed import BUCKETS, keyed_bucket


def random_splits(
    df: DataFrame, train_ratio: float = 0.8, val_ratio: float = 0.1, seed: int = 42
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The reference's two-stage ``randomSplit``: ``[train+val, test]`` then
    ``train/(train+val)``. With ``val_ratio == 0`` validation is the train set.

    Depends on the partition layout; prefer :func:`keyed_splits` when rows
    have a key."""
    train_val, test = df.randomSplit([train_ratio + val_ratio, 1 - train_ratio - val_ratio], seed=seed)
    if val_ratio > 0:
        inner = train_ratio / (train_ratio + val_ratio)
        train, val = train_val.randomSplit([inner, 1 - inner], seed=seed)
    else:
        train = val = train_val
    return train, val, test


def split_column(key: str, train_ratio: float = 0.8, val_ratio: float = 0.1, seed: int = 42):
    """``'train' | 'val' | 'test'`` from the key's hash bucket."""
    bucket = keyed_bucket(key, salt=str(seed))
    train_cut = int(round(train_ratio * BUCKETS))
    val_cut = int(round((train_ratio + val_ratio) * BUCKETS))
    return (
        F.when(bucket < F.lit(train_cut), F.lit("train"))
        .when(bucket < F.lit(val_cut), F.lit("val"))
        .otherwise(F.lit("test"))
    )


def with_split(
    df: DataFrame, key: str, train_ratio: float = 0.8, val_ratio: float = 0.1, seed: int = 42
) -> DataFrame:
    return df.withColumn("split", split_column(key, train_ratio, val_ratio, seed))


def keyed_splits(
    df: DataFrame, key: str, train_ratio: float = 0.8, val_ratio: float = 0.1, seed: int = 42
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Disjoint, exhaustive splits by key hash; no shuffle, stable under
    re-partitioning and task retries. ``val_ratio == 0`` gives val = train."""
    tagged = with_split(df, key, train_ratio, val_ratio, seed)
    train = tagged.where(F.col("split") == "train").drop("split")
    test = tagged.where(F.col("split") == "test").drop("split")
    val = tagged.where(F.col("split") == "val").drop("split") if val_ratio > 0 else train
    return train, val, test


def split_sizes(df_with_split: DataFrame, col: str = "split") -> DataFrame:
    """Rows per split in one aggregation."""
    return df_with_split.groupBy(col).agg(F.count(F.lit(1)).alias("n_rows"))


def fold_column(key: str, num_folds: int, seed: int = 42):
    """Fold number ``0 .. num_folds-1`` from a hash independent of the split's."""
    return (keyed_bucket(key, salt=f"fold:{seed}") % F.lit(num_folds)).cast("int")


def with_folds(df: DataFrame, key: str, num_folds: int = 2, seed: int = 42) -> DataFrame:
    return df.withColumn("fold", fold_column(key, num_folds, seed))
