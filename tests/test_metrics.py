import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from textflow.operators import auc, evaluate as ev


def _pairs(n, seed=1, ties=True):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        label = 1 if rnd.random() < 0.6 else 0
        score = rnd.randint(0, 20) if ties else rnd.random()
        score = float(score) + (0.7 if label else 0.0) * rnd.random()
        out.append((float(label), float(score)))
    return out


def _exact_by_python(pairs):
    pos = [s for l, s in pairs if l == 1]
    neg = [s for l, s in pairs if l == 0]
    wins = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    return wins / (len(pos) * len(neg))


@pytest.mark.parametrize("ties", [True, False])
def test_areas_match_spark_evaluator(spark, ties):
    pairs = _pairs(600, ties=ties)
    df = spark.createDataFrame([(l, Vectors.dense([-s, s])) for l, s in pairs], ["label", "rawPrediction"])
    got = auc.binary_areas_from_raw(df, "label").first()
    roc = BinaryClassificationEvaluator(metricName="areaUnderROC", numBins=0).evaluate(df)
    pr = BinaryClassificationEvaluator(metricName="areaUnderPR", numBins=0).evaluate(df)
    assert got["roc_auc"] == pytest.approx(roc, abs=1e-12)
    assert got["pr_auc"] == pytest.approx(pr, abs=1e-12)
    assert got["roc_auc"] == pytest.approx(_exact_by_python(pairs), abs=1e-12)


def test_bucket_count_does_not_change_result(spark):
    pairs = _pairs(2000, seed=7)
    df = spark.createDataFrame(pairs, "label double, score double")
    results = {b: auc.binary_areas(df, "label", "score", num_buckets=b).first() for b in (1, 3, 17, 64)}
    first = results[1]
    for row in results.values():
        assert row["roc_auc"] == pytest.approx(first["roc_auc"], abs=1e-12)
        assert row["pr_auc"] == pytest.approx(first["pr_auc"], abs=1e-12)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(-5, 5)), min_size=4, max_size=60))
def test_auc_properties(spark, data):
    labels = {l for l, _ in data}
    df = spark.createDataFrame([(float(l), float(s)) for l, s in data], "label double, score double")
    got = auc.binary_areas(df, "label", "score", num_buckets=3).first()
    if labels != {0, 1}:
        assert got["roc_auc"] is None
        return
    flipped = auc.binary_areas(df.withColumn("score", -F.col("score")), "label", "score").first()
    monotone = auc.binary_areas(df.withColumn("score", F.exp(F.col("score") / 3)), "label", "score").first()
    assert got["roc_auc"] + flipped["roc_auc"] == pytest.approx(1.0, abs=1e-12)
    assert monotone["roc_auc"] == pytest.approx(got["roc_auc"], abs=1e-12)
    assert got["roc_auc"] == pytest.approx(_exact_by_python([(l, s) for l, s in data]), abs=1e-12)


def test_count_metrics_match_spark_evaluator(spark):
    rnd = random.Random(3)
    rows = [(float(rnd.random() < 0.7), float(rnd.random() < 0.6)) for _ in range(500)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    got = ev.metric_values(ev.confusion_row(df))
    for metric, key in [("accuracy", "accuracy"), ("weightedPrecision", "weighted_precision"),
                        ("weightedRecall", "weighted_recall"), ("weightedFMeasure", "weighted_f1")]:
        want = MulticlassClassificationEvaluator(metricName=metric).evaluate(df)
        assert got[key] == pytest.approx(want, abs=1e-12), metric
    for label in (0, 1):
        for metric, key in [("precisionByLabel", "precision"), ("recallByLabel", "recall"),
                            ("fMeasureByLabel", "f1")]:
            want = MulticlassClassificationEvaluator(metricName=metric, metricLabel=float(label)).evaluate(df)
            assert got[f"{key}_{label}"] == pytest.approx(want, abs=1e-12)
    matrix = ev.confusion_matrix(ev.confusion_row(df)).collect()
    assert sum(r["pred_0"] + r["pred_1"] for r in matrix) == 500


def test_one_class_data_gives_zero_filled_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.0)] * 5, "label double, prediction double")
    got = ev.metric_values(ev.confusion_row(df))
    assert got["precision_0"] == 0.0 and got["recall_0"] == 0.0 and got["f1_0"] == 0.0
    assert got["accuracy"] == 1.0 and got["tn"] == 0 and got["tp"] == 5
    classes = {r["class"]: r for r in ev.class_metrics(ev.confusion_row(df)).collect()}
    assert classes[0]["support"] == 0 and classes[1]["f1"] == 1.0
