"""Exact top-k search by a Voronoi kNN join.

For each query vector the k rows with the highest inner product. A bounded number
of data rows are drawn as pivots, and every vector goes to the cell of its nearest
pivot. A summary of each cell -- its rows, and the distances to the pivot of those
nearest to it -- gives every query a score that its k-th best row reaches at least:
a row at distance r from pivot p scores within ``q.p - |q| r`` and ``q.p + |q| r``.
From that follows, for each group of queries and each cell, how far from the pivot
a row must be to matter to any of the group; the others are not sent there. Groups
and the rows sent to them are cut into blocks, each pair of which is solved in a
task by one matrix product; the blocks' best rows are merged per query.

The method is exact with any data. How much the bounds leave out hangs on the
vectors: of tight clusters most cells, of evenly spread directions next to nothing,
in which case each row is sent once to every ``QUERY_BLOCK`` queries.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textflow.llm.catalog import query
from textflow.llm.common import col, written
from textflow.plans.catalog import table

SCALE = 256             # components are floor(SCALE * x)
PIVOTS = 128            # data rows drawn as pivots, at most: what the driver and each task hold of them is bounded
QUERY_BLOCK = 1024      # queries that a task has at a time
DATA_BLOCK = 8192       # rows that a task has at a time
AT_ONCE = 256           # queries of one matrix product
SLACK = 1e-9            # of the magnitudes in a bound, for rounding
MOST = (1 << 63) - 1    # scores stop here
_NO_ID = MOST


def _usable(vector) -> F.Column:
    big = F.lit(float("inf"))
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * SCALE) < big))


def _vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(none, id, vector)``: rows whose vector takes part; ``none`` tells a null id."""
    vector = col(df, vector_col).cast("array<double>")
    own = col(df, id_col).cast("long")
    return df.where(_usable(vector)).select(own.isNull().alias("none"), F.coalesce(own, F.lit(_NO_ID)).alias("id"), vector.alias("vector"))


def scaled(vectors, dim: int) -> np.ndarray:
    """Vectors as rows of whole numbers, shorter ones ending in zeros."""
    if len(vectors) and min(map(len, vectors)) == dim:
        return np.floor(SCALE * np.stack([np.asarray(v, dtype=np.float64) for v in vectors]))
    out = np.zeros((len(vectors), dim))
    for row, v in zip(out, vectors):
        row[:len(v)] = np.floor(SCALE * np.asarray(v, dtype=np.float64))
    return out


def _matrix(packed, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(packed), "<f8").reshape(len(packed), dim)


def _nearest(rows: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest pivot of each row (the first of equally near ones) and its distance."""
    rough = (pivots * pivots).sum(1)[None, :] - 2 * rows @ pivots.T
    cell = rough.argmin(1)
    return cell, np.sqrt(((rows - pivots[cell]) ** 2).sum(1))


def _celled(df: DataFrame, pivots: np.ndarray, name: str) -> DataFrame:
    """``(none, id, vector, cell, distance, slot)``, written; ``vector`` is packed and
    ``slot`` a number of the row's own."""
    dim = pivots.shape[1]

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                rows = scaled(batch["vector"].tolist(), dim)
                cell, distance = _nearest(rows, pivots)
                packed = [r.tobytes() for r in rows.astype("<f8")]
                yield pd.DataFrame({"none": batch["none"], "id": batch["id"], "vector": packed, "cell": cell, "distance": distance})

    found = df.mapInPandas(assign, "none boolean, id long, vector binary, cell int, distance double")
    return written(found.withColumn("slot", F.monotonically_increasing_id()), name)


@dataclass(frozen=True)
class Summary:
    """Of each cell: its rows, and the distances of the rows nearest to its pivot."""

    rows: np.ndarray
    nearest: list[np.ndarray]


def _summary(data: DataFrame, cells: int, n: int) -> Summary:
    """One row a cell is collected: its count and ``n`` distances."""
    by = Window.partitionBy("cell").orderBy("distance")
    close = data.select("cell", "distance").withColumn("place", F.row_number().over(by)).where(F.col("place") <= n)
    close = {r["cell"]: np.sort(r["near"]) for r in close.groupBy("cell").agg(F.collect_list("distance").alias("near")).collect()}
    counts = {r["cell"]: r["count"] for r in data.groupBy("cell").count().collect()}
    return Summary(np.array([counts.get(c, 0) for c in range(cells)]), [close.get(c, np.empty(0)) for c in range(cells)])


def least_scores(queries: np.ndarray, pivots: np.ndarray, nearest: list[np.ndarray], n: int) -> np.ndarray:
    """For each query a score that at least ``n`` rows reach (minus infinity if there
    are fewer rows), by the cells' nearest distances."""
    size = np.sqrt((queries * queries).sum(1))
    dots = queries @ pivots.T
    bounds = [dots[:, c, None] - size[:, None] * near[None, :] for c, near in enumerate(nearest) if len(near)]
    every = np.concatenate(bounds, axis=1) if bounds else np.empty((len(queries), 0))
    if every.shape[1] < n:
        return np.full(len(queries), -np.inf)
    best = np.partition(every, every.shape[1] - n, axis=1)[:, every.shape[1] - n]
    return np.minimum(best - SLACK * (1 + np.abs(every).max(axis=1)), float(MOST) * 0.9)


def far_enough(queries: np.ndarray, floors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """For each cell the distance from its pivot that a row needs to reach the floor of
    any of the queries."""
    size = np.sqrt((queries * queries).sum(1))[:, None]
    dots = queries @ pivots.T
    short = floors[:, None] - dots - SLACK * (1 + np.abs(dots) + size)
    with np.errstate(divide="ignore", invalid="ignore"):
        need = np.where(short <= 0, 0.0, short / size)
    return need.min(axis=0)


def grouped(counts: np.ndarray, pivots: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """The group of each cell's queries, and the number of blocks of each group: so many
    groups as the queries fill blocks, around cells far from each other."""
    used = np.flatnonzero(counts)
    wanted = min(len(used), max(1, -(-int(counts.sum()) // block)))
    heads = [int(used[counts[used].argmax()])] if len(used) else []
    away = np.full(len(used), np.inf)
    while len(heads) < wanted:
        away = np.minimum(away, ((pivots[used] - pivots[heads[-1]]) ** 2).sum(1))
        heads.append(int(used[away.argmax()]))
    group = np.zeros(len(counts), dtype=int)
    if heads:
        group = ((pivots[:, None, :] - pivots[heads][None, :, :]) ** 2).sum(2).argmin(1)
    held = np.bincount(group, weights=counts, minlength=max(1, len(heads))).astype(int)
    return group, np.maximum(1, -(-held // block))


def best_rows(queries: np.ndarray, floors: np.ndarray, data: np.ndarray, ids: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query the places and scores of the ``n`` best rows at or above its floor,
    ties to smaller ids. Products are exact: in floating point while no sum can leave
    its whole numbers, in long integers beyond, which stop at the 64-bit range."""
    exact = np.abs(queries).max(initial=0) * np.abs(data).max(initial=0) * data.shape[1] < 2.0 ** 53
    if not exact:
        queries, data = (np.array([[int(x) for x in row] for row in m], dtype=object).reshape(m.shape) for m in (queries, data))
    for start in range(0, len(queries), AT_ONCE):
        scores = queries[start:start + AT_ONCE] @ data.T
        if not exact:
            scores = np.clip(scores, -MOST, MOST).astype(np.int64)
        for k, row in enumerate(scores):
            if len(row) > n:   # the n-th best row's score; more rows may have it
                found = np.flatnonzero(row >= np.partition(row, len(row) - n)[len(row) - n])
                found = found[np.lexsort((ids[found], -row[found]))[:n]]
            else:
                found = np.arange(len(row))
            found = found[row[found] >= floors[start + k]]
            yield start + k, found, row[found]


def knn_join(data: DataFrame, queries: DataFrame, k: int, id_col: str = "id", vector_col: str = "vector", pivots: int = PIVOTS,
             query_block: int = QUERY_BLOCK, data_block: int = DATA_BLOCK) -> DataFrame:
    """``(query_id, rank, id, score)``: for each row of ``queries``, which are rows of
    ``data``, the ``k`` best other rows (all, if fewer) by the inner product of
    ``floor(256 * x)``, ties to the smaller id, a null id last.

    Vectors that are null or hold a null or a component that is not finite take no
    part; shorter vectors end in zeros, an empty one scores 0. Rows that repeat an id
    are rows of their own: a query leaves out itself, not its copies, and repeated
    queries get a result each. Scores beyond the 64-bit range are equal to its end.
    Other columns are ignored; an empty table gives an empty result."""
    data, queries = (_vectors(d, id_col, vector_col) for d in (data, queries))
    dim = data.agg(F.max(F.size("vector"))).first()[0] or 0
    drawn = data.orderBy(F.xxhash64("id", "vector"), "id").limit(pivots).select("vector").collect()
    if not drawn:
        return data.sparkSession.createDataFrame([], "query_id long, rank int, id long, score long")
    centres = np.unique(scaled([r["vector"] for r in drawn], dim), axis=0)
    rows = _celled(data, centres, "knn-data")
    asked = _celled(queries, centres, "knn-queries")
    asked = asked.groupBy("none", "id", "vector", "cell").agg(F.count(F.lit(1)).alias("copies"))
    asked = written(asked.withColumn("query", F.monotonically_increasing_id()), "knn-asked")
    n = k + 1   # a query may find itself, which goes in the end
    summary = _summary(rows, len(centres), n)
    per_cell = {r["cell"]: r["count"] for r in asked.groupBy("cell").count().collect()}
    group, blocks = grouped(np.array([per_cell.get(c, 0) for c in range(len(centres))]), centres, query_block)
    nearest, spark = summary.nearest, data.sparkSession

    def floors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                floor = least_scores(_matrix(batch["vector"], dim), centres, nearest, n)
                yield batch.assign(floor=floor, group=group[batch["cell"]].astype("int32"))

    schema = "none boolean, id long, vector binary, cell int, copies long, query long, floor double, group int"
    floored = written(asked.mapInPandas(floors, schema), "knn-floors")

    def needs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        least = np.full((len(blocks), len(centres)), np.inf)
        for batch in batches:
            for g, part in batch.groupby("group"):
                least[g] = np.minimum(least[g], far_enough(_matrix(part["vector"], dim), part["floor"].to_numpy(), centres))
        g, c = np.nonzero(least < np.inf)
        yield pd.DataFrame({"group": g.astype("int32"), "cell": c.astype("int32"), "need": least[g, c]})

    routes = floored.select("vector", "floor", "group").mapInPandas(needs, "group int, cell int, need double").groupBy(
        "group", "cell").agg(F.min("need").alias("need")).collect()   # at most PIVOTS x PIVOTS
    sent = np.zeros(len(blocks), dtype=int)
    for r in routes:
        sent[r["group"]] += int(summary.rows[r["cell"]])
    parts = np.maximum(1, -(-sent // data_block))
    to = spark.createDataFrame([(r["group"], r["cell"], r["need"], int(blocks[r["group"]]), int(parts[r["group"]])) for r in routes],
                               "group int, to_cell int, need double, blocks int, parts int")
    # bounded by the square of the pivots: 16,384 rows of 24 bytes
    routed = rows.join(F.broadcast(to), (F.col("cell") == F.col("to_cell")) & (F.col("distance") >= F.col("need")))
    routed = routed.select("group", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
                           F.pmod(F.xxhash64("slot"), F.col("parts")).cast("int").alias("part"), "none", "id", "vector")
    sizes = to.select("group", "blocks", "parts").distinct().withColumnRenamed("group", "of")
    dealt = floored.join(F.broadcast(sizes), F.col("group") == F.col("of")).select(
        "group", F.pmod(F.xxhash64("query"), F.col("blocks")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "query", "id", "vector", "floor")

    def solve(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            ids, packed = right["id"].to_numpy(), right["vector"].to_numpy()
            for q, at, scores in best_rows(_matrix(left["vector"], dim), left["floor"].to_numpy(), _matrix(packed, dim), ids, n):
                own_id, own = left["id"].iat[q], left["vector"].iat[q]
                number = left["query"].iat[q]
                out += [(number, bool(right["none"].iat[i]), ids[i], int(s), bool(ids[i] == own_id and packed[i] == own))
                        for i, s in zip(at, scores)]
        return pd.DataFrame(out, columns=["query", "none", "id", "score", "own"])

    by = ("group", "block", "part")
    found = dealt.groupBy(*by).cogroup(routed.groupBy(*by)).applyInPandas(solve, "query long, none boolean, id long, score long, own boolean")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "none", "id", F.desc("own"))
    top = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= n)
    selves = F.sum(F.col("own").cast("int")).over(best.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    others = top.withColumn("selves", selves).where(~(F.col("own") & (F.col("selves") == 1)))
    ranked = others.withColumn("rank", F.col("place") - F.least("selves", F.lit(1)).cast("int")).where(F.col("rank") <= k)
    named = asked.select("query", F.when(~F.col("none"), F.col("id")).alias("query_id"), "copies")
    return named.join(ranked, "query").select(
        "query_id", "rank", F.when(~F.col("none"), F.col("id")).alias("id"), "score",
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).drop("copy")


OP12_SQL = f"""
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(q.v, d.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors d ON q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 5
"""


@query("op12_knn", OP12_SQL)
def op12_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    asked = rows.where(F.col("vec_id") % 50 == 0)
    return knn_join(rows, asked, 5, "vec_id", "embedding").withColumnRenamed("id", "vec_id").select("query_id", "rank", "vec_id", "score")
