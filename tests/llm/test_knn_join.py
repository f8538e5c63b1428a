import math

import numpy as np
import pandas as pd
import pytest

from helpers import SF001
from textflow.llm import knn_join as knn

MOST = 2 ** 63 - 1
SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, k=5):
    """The contract by a loop over (id, vector) rows."""
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (q, own) in enumerate(good):
        if q is None or q % 50:
            continue
        scored = sorted((-max(-MOST, min(MOST, sum(a * b for a, b in zip(own, v)))), i is None, i or 0, i) for j, (i, v) in enumerate(good) if j != at)
        out += [(q, rank, i, -s) for rank, (s, _, _, i) in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


def told(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def asked(frame):
    return frame.where("vec_id % 50 = 0")


def test_query_against_brute_force(spark):
    rows = pd.read_parquet(f"{SF001}/embeddings.parquet")
    plain = [(int(i), [float(x) for x in v]) for i, v in zip(rows.vec_id, rows.embedding)]
    assert told(knn.op12_knn(spark, SF001)) == brute(plain)


def clustered(n, dim=6, seed=0):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(9, dim)) * 4
    return [(i, (centres[i % 9] + draw.normal(size=dim) / 40).tolist()) for i in range(n)]


@pytest.mark.parametrize("blocks", [(3, 40), (1000, 1000)])
def test_blocks_and_groups(spark, blocks):
    rows = clustered(700)
    frame = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    got = knn.knn_join(frame, asked(frame), 5, "vec_id", "embedding", 24, *blocks)
    assert told(got) == brute(rows)


def test_bounds_leave_rows_out_and_keep_the_best():
    draw = np.random.default_rng(1)
    data = np.array([knn.scaled([v], 6)[0] for _, v in clustered(900)])
    pivots = np.unique(data[draw.choice(900, 40, replace=False)], axis=0)
    cell, distance = knn._nearest(data, pivots)
    nearest = [np.sort(distance[cell == c])[:6] for c in range(len(pivots))]
    queries = data[:30]
    floors = knn.least_scores(queries, pivots, nearest, 6)
    scores = queries @ data.T
    assert (np.sort(scores, axis=1)[:, -6] >= floors).all()
    sent = 0
    for q, floor, row in zip(queries, floors, scores):
        kept = distance >= knn.far_enough(q[None], np.array([floor]), pivots)[cell]
        assert kept[row >= np.sort(row)[-6]].all()
        sent += kept.sum()
    assert sent < 0.5 * scores.size


def test_least_scores_with_few_rows():
    assert knn.least_scores(np.ones((2, 3)), np.ones((1, 3)), [np.zeros(2)], 6).tolist() == [-np.inf] * 2


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (50, [1.0, 0.5]), (50, [1.0, 0.5]), (50, [-1.0, 0.25]), (None, [1.0, 0.5]), (1, None), (2, [1.0, None]),
            (3, [nan, 1.0]), (4, [inf, 1.0]), (100, [0.0, 0.0]), (5, [0.0, 0.0]), (6, []), (150, []), (7, [2.0]), (-50, [3.0, -inf]),
            (8, [0.001, -0.001]), (None, [1.0, 0.5]), (200, [0.999, 0.501])]
    frame = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    got = knn.knn_join(frame, asked(frame), 5, "vec_id", "embedding", 3, 2, 2)
    assert told(got) == brute(rows)


def test_one_hot_vector_and_ties(spark):
    rows = [(i, [0.3, 0.4]) if i % 3 else (i, [0.3, 0.1 + i / 1e4]) for i in range(400)]
    frame = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    assert told(knn.knn_join(frame, asked(frame), 5, "vec_id", "embedding", 8, 4, 50)) == brute(rows)


@pytest.mark.parametrize("step", [2 ** 21, 2 ** 33])   # scores beyond 2^53; beyond 2^63
def test_large_components_stay_exact(spark, step):
    rows = [(i, [float(3 ** 13 + i), float(-step * (i % 7))]) for i in range(60)]
    frame = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    assert told(knn.knn_join(frame, asked(frame), 5, "vec_id", "embedding", 4)) == brute(rows)


def test_few_rows_and_empty_table(spark):
    frame = spark.createDataFrame([(0, [1.0], 0), (1, [2.0], 0)], SCHEMA)
    assert told(knn.knn_join(frame, asked(frame), 5, "vec_id", "embedding")) == [(0, 1, 1, 131072)]
    empty = frame.limit(0)
    assert knn.knn_join(empty, asked(empty), 5, "vec_id", "embedding").columns == ["query_id", "rank", "id", "score"]
    alone = frame.where("vec_id = 0")
    assert told(knn.knn_join(alone, asked(alone), 5, "vec_id", "embedding")) == []
