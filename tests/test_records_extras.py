"""Stage log, publishing gate, fit groups, optimality, fold weights, bucket
frequencies and score sketches."""

import random

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Tokenizer
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from conftest import SF01
from textflow.operators import auc, features as feat, score_sketch
from textflow.operators.registry import Registry, staged_versions
from textflow.operators.splits import fold_column
from textflow.operators.training import (
    ModelSpec,
    TrainConfig,
    Trainer,
    default_model_specs,
    gradient_norm,
    record_outcome,
    run_fits,
)
from textflow.plans.text_plans import labelled_text
from textflow.schemas import MODEL_VERSIONS, STAGE_LOG


@pytest.fixture(scope="module")
def labelled(spark):
    return labelled_text(spark, SF01).cache()


# -- stages ------------------------------------------------------------------

def test_versions_move_between_stages(spark, tmp_dir):
    registry = Registry(spark, tmp_dir)
    model = PipelineModel([Tokenizer(inputCol="text", outputCol="t")])
    for _ in range(3):
        registry.register_model("m", model)
    assert registry.latest("m", "Production") == (None, None)
    assert registry.move("m", "1", "Staging") is None
    assert registry.move("m", "1", "Production") == "Staging"
    before = spark.sql("SELECT current_timestamp() AS t").first()["t"]
    registry.move("m", "2", "Production", archive_others=True)
    assert registry.latest("m", "Production")[0] == "2"
    assert {r["version"]: r["stage"] for r in registry.versions("m").collect()} == {"1": "Archived", "2": "Production", "3": None}
    assert registry.latest("m")[0] == "3"
    assert registry.latest("m", "Production", as_of=before)[0] == "1"     # what was served then
    assert registry.table("stage_log").count() == 4
    with pytest.raises(ValueError, match="no version"):
        registry.move("m", "9", "Production")
    with pytest.raises(ValueError, match="stage must"):
        registry.move("m", "1", "production")


def test_last_move_wins_against_a_loop(spark):
    draw = random.Random(3)
    versions = [("m", str(v), draw.choice([None, "Staging"]), None, None, None) for v in range(6)]
    base = 1_700_000_000
    moves = [("m", str(draw.randrange(8)), None, draw.choice(["Staging", "Production", "Archived"]), draw.randrange(5), f"{k:03d}")
             for k in range(60)]
    frame = spark.createDataFrame([(n, v, a, b, t, i) for n, v, a, b, t, i in moves],
                                  "name string, version string, from_stage string, to_stage string, t long, move_id string").select(
        "name", "version", "from_stage", "to_stage", F.timestamp_seconds(F.col("t") + base).alias("moved_at"), "move_id")
    assert {f.name for f in STAGE_LOG.fields} == set(frame.columns)
    for upto in range(-1, 5):
        then = spark.range(1).select(F.timestamp_seconds(F.lit(base + upto))).first()[0]
        got = {r["version"]: r["stage"] for r in staged_versions(spark.createDataFrame(versions, MODEL_VERSIONS), frame, then).collect()}
        want = {v[1]: v[2] for v in versions}
        for _, version, _, to, t, _ in sorted(moves, key=lambda m: (m[4], m[5])):
            if t <= upto and version in want:
                want[version] = to
        assert got == want


# -- training -----------------------------------------------------------------

def test_best_is_published_above_the_gate_only(spark, labelled, tmp_dir):
    lr = [s for s in default_model_specs() if s.name == "LogisticRegression"]
    cfg = TrainConfig(num_features=1024, min_doc_freq=1)
    outcome = Trainer(cfg, lr).fit(labelled)
    accuracy = outcome.best.metrics["accuracy"]
    registry = Registry(spark, tmp_dir)
    assert "best" not in record_outcome(outcome, registry, cfg, "text", publish_above=accuracy)   # strictly above
    assert registry.latest("text-best") == (None, None) and registry.latest("text-logisticregression")[0] == "1"
    assert record_outcome(outcome, registry, cfg, "text", publish_above=accuracy - 0.01)["best"][0] == "1"
    told = {r["value"] for r in registry.table("run_params").where("name = 'published'").collect()}
    assert told == {"true", "false"}


@pytest.mark.parametrize("workers", [1, 3])
def test_fits_carry_groups_of_their_own_and_the_caller_s_pool(spark, workers):
    context = spark.sparkContext
    context.setLocalProperty("spark.scheduler.pool", "training")
    context.setJobGroup(f"night{workers}", "nightly")

    def fit(k):
        rows = spark.range(10 + k).repartition(2).count()
        return rows, context.getLocalProperty("spark.scheduler.pool"), context.getLocalProperty("spark.jobGroup.id")

    try:
        results = run_fits(spark, [(f"model{k}", lambda k=k: fit(k)) for k in range(5)], workers)
        assert results == [(10 + k, "training", f"night{workers}/model{k}") for k in range(5)]
        for k in range(5):
            assert context.statusTracker().getJobIdsForGroup(f"night{workers}/model{k}")
        assert not context.statusTracker().getJobIdsForGroup(f"night{workers}")
        assert context.getLocalProperty("spark.jobGroup.id") == f"night{workers}"
    finally:
        context.setLocalProperty("spark.scheduler.pool", None)
        context.setLocalProperty("spark.jobGroup.id", None)


def test_gradient_against_numpy_and_at_the_optimum(spark, labelled):
    train = feat.hashed_features(labelled, 256, 1).join(labelled.select("doc_id", "label"), "doc_id").select("label", "features").persist()
    rows = train.collect()
    x, y = np.array([r.features.toArray() for r in rows]), np.array([r.label for r in rows], dtype=float)
    deviation = x.std(0, ddof=1)
    used = deviation > 0
    norms = {}
    for steps in (2, 400):
        model = LogisticRegression(maxIter=steps, regParam=0.1, tol=1e-12).fit(train)
        w = model.coefficients.toArray()
        residual = 1 / (1 + np.exp(-(x @ w + model.intercept))) - y
        slopes = (x.T @ residual)[used] / len(y) / deviation[used] + 0.1 * w[used] * deviation[used]
        norms[steps] = gradient_norm(model, train)
        assert norms[steps] == pytest.approx(np.sqrt((slopes ** 2).sum() + residual.mean() ** 2), rel=1e-6, abs=1e-9)
    start = gradient_norm(model, train, at_zero=True)
    assert norms[400] < 1e-4 * start < norms[2] * 10
    train.unpersist()


def test_grid_scores_against_a_fit_from_scratch(spark, labelled):
    """Weights applied where a fold is read give what a whole pipeline on the fold gives."""
    cfg = TrainConfig(num_features=1024, min_doc_freq=2, enable_cv=True, cv_folds=2)
    spec = ModelSpec("LR", lambda: LogisticRegression(maxIter=15, regParam=0.3), {"regParam": [0.01, 1.0]})
    trainer = Trainer(cfg, [spec])
    outcome = trainer.fit(labelled)
    from textflow.operators.splits import with_split

    train = with_split(labelled.where("text IS NOT NULL"), "doc_id", cfg.train_ratio, cfg.val_ratio, cfg.seed).where("split = 'train'")
    tagged = train.withColumn("fold", fold_column("doc_id", 2, cfg.seed))
    for grid_id, _, score in outcome.results[0].grid:
        found = []
        for k in range(2):
            stages = feat.feature_stages(1024, 2) + [LogisticRegression(maxIter=15, regParam=[0.01, 1.0][grid_id])]
            fitted = Pipeline(stages=stages).fit(tagged.where(F.col("fold") != k))
            found.append(fitted.transform(tagged.where(F.col("fold") == k)).agg(
                F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0])
        assert score == pytest.approx(sum(found) / 2, abs=1e-9)
    assert trainer._persisted == []
    # the model is fitted with the best point, not with the estimator's own settings
    best = max(outcome.results[0].grid, key=lambda g: (g[2], -g[0]))
    assert outcome.results[0].params["regParam"] == [0.01, 1.0][best[0]] != 0.3


# -- bucket frequencies --------------------------------------------------------

def test_bucket_frequencies_against_a_loop(spark):
    texts = [(1, "a b b c"), (2, "b d"), (3, ""), (4, "zebra a")]
    docs = spark.createDataFrame(texts, "doc_id int, text string")
    hashed = feat.hashing_model(8).transform(docs)
    got = {r["bucket"]: r["df"] for r in feat.bucket_frequencies(hashed).collect()}
    want = {}
    for row in hashed.collect():
        for k in row.rawFeatures.indices:
            want[int(k)] = want.get(int(k), 0) + 1
    assert got == want
    terms = spark.createDataFrame([("zebra", 1), ("b", 2), ("c", 1), ("d", 1)], "term string, n_docs long")
    buckets = {r["term"]: r["bucket"] for r in feat.term_buckets(terms, 8).collect()}
    stage = feat.HashingTF(numFeatures=8)
    assert buckets == {t: stage.indexOf(t) for t in buckets}
    told = {r["bucket"]: (r["n_terms"], r["most"], r["total"]) for r in feat.bucket_collisions(terms, 8).collect()}
    assert sum(n for n, _, _ in told.values()) == 4 and sum(t for _, _, t in told.values()) == 5


# -- sketches ---------------------------------------------------------------------

def exact_area(rows):
    pos, neg = [s for s, label in rows if label], [s for s, label in rows if not label]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("accuracy", [0.001, 0.05, 0.5])
def test_area_within_the_sketch_s_own_bound(spark, accuracy):
    draw = random.Random(5)
    rows = [(draw.choice([draw.gauss(0, 1), draw.gauss(0, 1e-4), 0.0, 1e300, -1e-300, float("inf"), 5.0]), draw.random() < 0.4) for _ in range(700)]
    rows = [(s + (0.3 if label else 0.0), int(label)) for s, label in rows]
    frame = spark.createDataFrame(rows + [(float("nan"), 1), (None, 0), (1.0, None)], "score double, label int")
    parts = [score_sketch.sketch(frame.where(F.pmod(F.hash("score"), F.lit(3)) == k), accuracy=accuracy) for k in range(3)]
    both = parts[0].union(parts[1]).union(parts[2])
    area = score_sketch.roc_area(both).first()
    assert (area["n_pos"], area["n_neg"]) == (sum(r[1] for r in rows), sum(1 - r[1] for r in rows))
    assert abs(area["roc_auc"] - exact_area(rows)) <= area["error_bound"] + 1e-12
    whole = score_sketch.roc_area(score_sketch.sketch(frame, accuracy=accuracy)).first()
    assert whole["roc_auc"] == pytest.approx(area["roc_auc"], abs=1e-12)     # merging loses nothing
    assert auc.area_values(frame)["roc_auc"] == pytest.approx(exact_area(rows), abs=1e-9)


def test_buckets_ascend_with_scores(spark):
    scores = sorted([-1e308, -5.0, -1.0, -1e-9, -1e-13, 0.0, 1e-13, 1e-12, 2e-9, 0.5, 0.9, 1.0, 7.0, 1e308, float("inf"), float("-inf")])
    got = [r[0] for r in spark.createDataFrame([(s,) for s in scores], "s double").coalesce(1).select(score_sketch.bucket_of(F.col("s"))).collect()]
    assert got == sorted(got) and len(set(got)) == len(got) - 2    # those next to zero are one


def test_one_class_and_replayed_batches(spark, tmp_dir):
    from pyspark.ml.linalg import Vectors

    rows = [(Vectors.dense([-s, s]), label) for s, label in ((0.5, 1), (0.1, 0), (0.7, 1))]
    frame = spark.createDataFrame(rows, ["rawPrediction", "label"])
    path = f"{tmp_dir}/s"
    assert score_sketch.running_area(spark, path).first()["roc_auc"] is None
    score_sketch.write_batch(frame.where("label = 1"), path, "q", 0)
    assert score_sketch.running_area(spark, path).first()[:] == (None, None, 2, 0)
    score_sketch.write_batch(frame, path, "q", 0)    # the replay replaces it
    score_sketch.write_batch(frame, path, "other", 0)
    one = score_sketch.running_area(spark, path, "q").first()
    assert (one["roc_auc"], one["error_bound"], one["n_pos"], one["n_neg"]) == (1.0, 0.0, 2, 1)
    assert score_sketch.running_area(spark, path).first()["n_pos"] == 4
