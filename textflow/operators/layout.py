"""Partition layout before CPU-heavy per-row work."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


SPREAD_CONF = "spark.textflow.spreadPartitions"


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows dealt round-robin over ``partitions`` tasks before CPU-heavy work.

    Off unless a number is given here or in the session setting
    ``spark.textflow.spreadPartitions``: the shuffle of raw text pays only where
    an input is a few unsplittable files (a small benchmark table, one
    compressed CSV). Many files, or splittable ones, are read in parallel as
    they are."""
    partitions = partitions or int(df.sparkSession.conf.get(SPREAD_CONF, "0"))
    return df.repartition(partitions) if partitions > 0 else df


class persisted:
    """Persist frames for a block and always unpersist them afterwards.

    ``materialise=True`` forces each frame with a ``count`` on entry (the
    optional cache-and-count of splits); otherwise the first action fills
    the cache."""

    def __init__(self, *frames: DataFrame, level=None, materialise: bool = False):
        from pyspark import StorageLevel

        self.frames = frames
        self.level = level or StorageLevel.MEMORY_AND_DISK
        self.materialise = materialise

    def __enter__(self):
        out = tuple(df.persist(self.level) for df in self.frames)
        if self.materialise:
            for df in out:
                df.count()
        return out if len(out) != 1 else out[0]

    def __exit__(self, *exc):
        for df in self.frames:
            df.unpersist()
        return False


def top_k(df: DataFrame, k: int, value_col: str, *tie_cols: str) -> DataFrame:
    """The ``k`` rows with the largest ``value_col`` (ties by ``tie_cols``),
    exact, with a bounded final merge.

    A plain ``orderBy().limit(k)`` sends k rows from *every* partition into
    one task. Here a scalar subquery first takes the k-th largest of the
    per-partition maxima: k partitions each hold a row at least that large,
    so at least k rows pass ``value >= threshold`` and the true top k are
    among them; only partitions whose maximum reaches the threshold (about k
    of them) send rows to the final merge. With fewer than k partitions there
    is no threshold. Both passes run in one query and share its shuffles."""
    order = [F.desc(value_col), *[F.asc(c) for c in tie_cols]]
    maxima = df.groupBy(F.spark_partition_id().alias("part")).agg(F.max(value_col).alias("m"))
    best = maxima.orderBy(F.desc("m")).limit(k)
    threshold = best.select(F.when(F.count(F.lit(1)) >= F.lit(k), F.min("m"))).scalar()
    kept = df.where(threshold.isNull() | (F.col(value_col) >= threshold))
    return kept.orderBy(*order).limit(k)


def write_bucketed(df: DataFrame, table: str, key: str, num_buckets: int, path: str) -> DataFrame:
    """Store ``df`` as an external table bucketed and sorted by ``key``.

    Two tables bucketed the same way on the join key join without a shuffle
    (Spark reads matching buckets side by side): for the labelled corpus this
    removes the one shuffle of raw text, ``documents ⋈ labels`` on
    ``doc_id``. The files go to ``path`` (a shared folder), the table name to
    the session catalog. Returns the table."""
    (df.write.mode("overwrite").bucketBy(num_buckets, key).sortBy(key)
     .option("path", path).saveAsTable(table))
    return df.sparkSession.table(table)
