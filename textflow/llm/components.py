"""Connected components of an edge table, as Spark joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textflow.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above ``u`` is hung on the smallest of ``u`` and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """``u`` and its neighbours below it are hung on the smallest of them
    (edges come as ``u > v``)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    hung = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (long ``u``, ``v``) but the
    roots themselves; the root is the smallest node of the component.

    Alternates the large-star and small-star steps until the edge table stops
    changing. Both steps aggregate before they join, so a hub costs one
    pre-aggregated row a task and a join that AQE can split; each round is
    written to the shared folder, and only a row count and a checksum come to
    the driver. Self loops, repeated edges and an empty table are allowed."""
    up = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    now = written(edges.where("u <> v").select(*up).distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if mark == seen or mark[0] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = mark
        now = written(_small_star(_large_star(now)), "edges")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
