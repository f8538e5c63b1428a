"""Model plans: the flagship train-and-evaluate run, the three-model
comparison, the tuning grid and saved-model scoring. Fitted models depend on
float summation order, so these get the rows-only check."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textflow.operators.training import (
    ModelSpec,
    TrainConfig,
    Trainer,
    default_model_specs,
)
from textflow.functions.keyed import keyed_bucket_sql
from textflow.plans.catalog import plan, r6
from textflow.plans.text_plans import labelled_text
from textflow.session import scratch_path

METRIC_COLS = ("accuracy", "auc", "pr_auc", "weighted_precision", "weighted_recall", "weighted_f1")


def _config(**changes) -> TrainConfig:
    """The plans' settings, the same at every input size: 2^15 hashed features,
    terms of two or more training documents."""
    return TrainConfig(num_features=1 << 15, min_doc_freq=2).with_(**changes)


def _frame(spark, outcome) -> DataFrame:
    df = outcome.results_frame(spark)
    cols = [c for c in METRIC_COLS if c in df.columns]
    return df.select("model", "position", *[r6(c).alias(c) for c in cols],
                     *[F.col(c).cast("bigint") for c in ("tn", "fp", "fn", "tp") if c in df.columns])


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled corpus -> keyed split -> TF-IDF -> logistic regression -> metrics."""
    lr = [s for s in default_model_specs() if s.name == "LogisticRegression"]
    outcome = Trainer(_config(), lr).fit(labelled_text(spark, sf_dir))
    return _frame(spark, outcome)


LABELLED_ROWS_SQL = "FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE d.text IS NOT NULL AND l.quality IS NOT NULL"
N_TEST_SQL = f"SELECT count(*) {LABELLED_ROWS_SQL} AND {keyed_bucket_sql('d.doc_id')} >= 9000"
#: A model's gradient norm may be at most this part of the norm at zero coefficients.
OPTIMUM = 0.05


@plan(
    "train_compare",
    f"""
    SELECT model, position, ({N_TEST_SQL}) AS n_test,
           ({N_TEST_SQL} AND l.quality = 1) AS n_test_pos, TRUE AS accuracy_adds_up, TRUE AS areas_in_range, near_optimum
    FROM (VALUES ('LogisticRegression', 0, TRUE), ('RandomForest', 1, NULL), ('LinearSVC', 2, NULL)) AS t(model, position, near_optimum)
    """,
)
def q_train_compare(spark, sf_dir):
    """The three classifiers on shared features, evaluated on the test split: the test
    rows and positives that their confusion counts add up to, the accuracy that follows
    from these, and for the logistic regression (null for the others) whether the gradient
    of its loss is near zero. The metrics themselves are in ``entry()`` and the registry."""
    outcome = Trainer(_config(parallelism=3, certify=True)).fit(labelled_text(spark, sf_dir))
    rows = []
    for r in outcome.results:
        m = r.metrics
        n = m["tn"] + m["fp"] + m["fn"] + m["tp"]
        near = m["gradient_norm"] <= OPTIMUM * m["gradient_start"] if "gradient_norm" in m else None
        rows.append((r.name, r.position, int(n), int(m["fn"] + m["tp"]), abs(m["accuracy"] * n - m["tn"] - m["tp"]) < 1e-6,
                     all(0.0 <= m[k] <= 1.0 for k in METRIC_COLS), near))
    return spark.createDataFrame(rows, "model string, position int, n_test long, n_test_pos long, accuracy_adds_up boolean, "
                                       "areas_in_range boolean, near_optimum boolean")


@plan(
    "train_params",
    f"""
    SELECT model, position, params, TRUE AS timed,
           (SELECT count(*) FROM documents d JOIN labels l ON d.doc_id = l.doc_id
            WHERE {keyed_bucket_sql('d.doc_id')} >= 9000) AS n_test
    FROM (VALUES ('LogisticRegression', 0, 'elasticNetParam=0.0 maxIter=20 regParam=0.1'),
                 ('RandomForest', 1, 'maxBins=32 maxDepth=5 numTrees=10'),
                 ('LinearSVC', 2, 'maxIter=30 regParam=0.1')) AS t(model, position, params)
    """,
)
def q_train_params(spark, sf_dir):
    """Effective parameters, training time and test rows of the three models."""
    outcome = Trainer(_config(parallelism=3)).fit(labelled_text(spark, sf_dir))
    shown = {"LogisticRegression": ("elasticNetParam", "maxIter", "regParam"),
             "RandomForest": ("maxBins", "maxDepth", "numTrees"), "LinearSVC": ("maxIter", "regParam")}
    rows = [(r.name, r.position, " ".join(f"{p}={r.params[p]}" for p in shown[r.name]), r.training_seconds > 0,
             int(r.metrics["n_rows"])) for r in outcome.results]
    return spark.createDataFrame(rows, "model string, position int, params string, timed boolean, n_test long")


@plan(
    "tuned_grid",
    """
    SELECT model, grid_id, params, TRUE AS scored, TRUE AS one_best FROM (VALUES
      ('LogisticRegression', 0, 'regParam=0.01, elasticNetParam=0.0'), ('LogisticRegression', 1, 'regParam=0.01, elasticNetParam=0.5'),
      ('LogisticRegression', 2, 'regParam=0.1, elasticNetParam=0.0'), ('LogisticRegression', 3, 'regParam=0.1, elasticNetParam=0.5'),
      ('RandomForest', 0, 'numTrees=5, maxDepth=3'), ('RandomForest', 1, 'numTrees=5, maxDepth=5'),
      ('RandomForest', 2, 'numTrees=10, maxDepth=3'), ('RandomForest', 3, 'numTrees=10, maxDepth=5')) AS t(model, grid_id, params)
    """,
)
def q_tuned_grid(spark, sf_dir):
    """Cross-validated grids (LR, RF; LinearSVC tuning off by default), the IDF re-fitted
    per fold: one row per (model, grid point), whether it was scored and whether the
    model was fitted with the first of the best points. (The scores, which depend on the
    order of sums, are in ``grid_frame`` and the registry; a test refits them.)"""
    cfg = _config(enable_cv=True, cv_folds=2, parallelism=3)
    outcome = Trainer(cfg).fit(labelled_text(spark, sf_dir))
    rows = []
    for r in outcome.results:
        best = max(r.grid, key=lambda g: (g[2], -g[0]), default=None)
        for grid_id, params, score in r.grid:
            fitted = all(str(r.params[k]) == v for k, v in (p.split("=") for p in best[1].split(", ")))
            rows.append((r.name, grid_id, params, 0.0 < score <= 1.0, fitted))
    return spark.createDataFrame(rows, "model string, grid_id int, params string, scored boolean, one_best boolean")


@plan(
    "saved_model_score",
    """
    SELECT d.doc_id, TRUE AS same_as_saved
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id
    """,
)
def q_saved_model_score(spark, sf_dir):
    """Fit, save, load and re-score every labelled document: one row per
    document flagging that the loaded model's prediction and raw scores equal
    the in-memory model's (model values themselves are not SQL-checkable)."""
    lr: list[ModelSpec] = [s for s in default_model_specs() if s.name == "LogisticRegression"]
    labelled = labelled_text(spark, sf_dir)
    outcome = Trainer(_config(), lr).fit(labelled)
    model = outcome.results[0].model
    path = scratch_path(spark, "saved-model")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    before = model.transform(labelled).select(
        "doc_id", F.col("prediction").alias("p0"), vector_to_array("rawPrediction").alias("r0"))
    after = loaded.transform(labelled).select(
        "doc_id", "prediction", vector_to_array("rawPrediction").alias("r1"))
    same = (F.col("prediction") == F.col("p0")) & (F.col("r1") == F.col("r0"))
    return after.join(before, "doc_id").select("doc_id", same.alias("same_as_saved"))
