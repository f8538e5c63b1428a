import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from conftest import SF01
from textflow.operators import training
from textflow.operators.training import (
    ModelResult,
    ModelSpec,
    TrainConfig,
    Trainer,
    default_model_specs,
    grid_points,
    pick_best,
    record_outcome,
)
from textflow.operators.registry import Registry, best_run
from textflow.plans.text_plans import labelled_text


@pytest.fixture(scope="module")
def labelled(spark):
    return labelled_text(spark, SF01).cache()


def test_grid_is_bound_to_the_instance(spark):
    lr = LogisticRegression()
    points = grid_points(lr, {"regParam": [0.01, 10.0]})
    assert all(p.parent == lr.uid for pt in points for p in pt)


def test_grid_points_give_different_metrics(spark, labelled):
    """Regression for class-level grids: every grid point trained the same model."""
    spec = ModelSpec("LR", lambda: LogisticRegression(maxIter=10), {"regParam": [0.0001, 10.0]})
    cfg = TrainConfig(num_features=4096, min_doc_freq=1, enable_cv=True, cv_folds=2, select_metric="weighted_f1")
    outcome = Trainer(cfg, [spec]).fit(labelled)
    avgs = [g[2] for g in outcome.results[0].grid]
    assert len(avgs) == 2 and avgs[0] != avgs[1]


def test_three_models_train_evaluate_and_record(spark, labelled, tmp_dir):
    cfg = TrainConfig(num_features=4096, min_doc_freq=2)
    outcome = Trainer(cfg).fit(labelled)
    assert [r.name for r in outcome.results] == ["LogisticRegression", "RandomForest", "LinearSVC"]
    for r in outcome.results:
        m = r.metrics
        assert 0.0 <= m["accuracy"] <= 1.0
        assert m["tn"] + m["fp"] + m["fn"] + m["tp"] == outcome.split_sizes["eval"]
        assert m["auc"] is not None and 0.0 <= m["auc"] <= 1.0
    assert outcome.best is not None
    frame = outcome.results_frame(spark)
    assert frame.count() == 3
    registry = Registry(spark, tmp_dir)
    versions = record_outcome(outcome, registry, cfg, "text")
    assert versions["best"][0] == "1"
    runs = registry.table("runs")
    assert runs.count() == 4
    best = best_run(runs.where("parent_run_id IS NOT NULL"), registry.table("run_metrics"),
                    registry.table("run_params")).first()
    assert best["accuracy"] == pytest.approx(outcome.best.metrics["accuracy"])
    scored = registry.load(versions["best"][1]).transform(labelled.limit(5))
    assert "prediction" in scored.columns


def test_pick_best_ties_and_zero():
    def r(name, acc):
        return ModelResult(name, 0, None, {}, {"accuracy": acc}, 0.0)

    assert pick_best([r("a", 0.0), r("b", 0.0)]) is None
    assert pick_best([r("a", 0.7), r("b", 0.7), r("c", 0.6)]).name == "a"


def test_default_specs_match_reference_settings(spark):
    specs = {s.name: s for s in default_model_specs()}
    assert set(specs) == {"LogisticRegression", "RandomForest", "LinearSVC"}
    assert specs["LinearSVC"].tune is False
    lr = specs["LogisticRegression"].make()
    assert lr.getMaxIter() == 20 and lr.getRegParam() == 0.1


def test_save_outcome_writes_every_model_and_best_pointer(spark, labelled, tmp_dir):
    from pyspark.ml import PipelineModel

    from textflow.operators.training import save_outcome

    lr = [s for s in default_model_specs() if s.name == "LogisticRegression"]
    outcome = Trainer(TrainConfig(num_features=1024, min_doc_freq=1), lr).fit(labelled)
    index = save_outcome(spark, outcome, tmp_dir, stamp="20240101000000").collect()
    assert len(index) == 1 and index[0]["is_best"]
    model = PipelineModel.load(index[0]["path"])
    assert "prediction" in model.transform(labelled.limit(3)).columns
    assert spark.read.parquet(f"{tmp_dir}/models/_index").count() == 1


@pytest.mark.parametrize("mode", ["keyed", "random"])
def test_profile_counts_every_row_in_both_split_modes(spark, labelled, mode):
    lr = [s for s in default_model_specs() if s.name == "LogisticRegression"]
    cfg = TrainConfig(num_features=1024, min_doc_freq=1, split_mode=mode)
    outcome = Trainer(cfg, lr).fit(labelled)
    total = labelled.count()
    assert outcome.profile["total_rows"] == total
    assert outcome.profile["pos_count"] == labelled.where("label = 1").count()
    assert 0 < outcome.split_sizes["eval"] < outcome.split_sizes["train"] < total
    m = outcome.results[0].metrics
    assert m["tn"] + m["fp"] + m["fn"] + m["tp"] == outcome.split_sizes["eval"]


def test_auc_modes_agree_on_small_data(spark, labelled):
    lr = [s for s in default_model_specs() if s.name == "LogisticRegression"]
    exact = Trainer(TrainConfig(num_features=1024, min_doc_freq=1), lr).fit(labelled).results[0].metrics
    evaluator = Trainer(TrainConfig(num_features=1024, min_doc_freq=1, auc_mode="evaluator"), lr) \
        .fit(labelled).results[0].metrics
    # under 2000 distinct scores the evaluator does not down-sample: same areas
    assert evaluator["auc"] == pytest.approx(exact["auc"], abs=1e-9)
    assert evaluator["pr_auc"] == pytest.approx(exact["pr_auc"], abs=1e-9)


def test_missing_key_column_is_reported(spark):
    df = spark.createDataFrame([(1, "a b")], "label int, text string")
    with pytest.raises(ValueError, match="doc_id"):
        Trainer(TrainConfig()).fit(df)


def test_quick_preset_samples_and_caps(spark, labelled):
    from textflow.operators.training import PRESETS

    cfg = PRESETS["quick"].with_(min_doc_freq=1, max_rows=30)
    lr = [s for s in default_model_specs() if s.name == "LogisticRegression"]
    outcome = Trainer(cfg, lr).fit(labelled)
    # 10% keyed sample of ~400 rows, then capped at 30 rows
    assert outcome.profile["total_rows"] == 30
    assert outcome.results[0].metrics["n_rows"] == outcome.split_sizes["eval"]


@pytest.mark.parametrize("mode", ["keyed", "random"])
def test_rows_of_a_training_task_follow_their_number_not_the_files(spark, monkeypatch, mode):
    """A forest holds a bin number for every feature of a row: one partition of many rows
    became a task of gigabytes."""
    seen = {}

    class Seen(LogisticRegression):
        def fit(self, dataset, params=None):
            seen["parts"] = [r["n"] for r in dataset.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
            return super().fit(dataset, params)

    monkeypatch.setattr(training, "TASK_BYTES", 64 * 256 * 4, raising=False)
    rows = spark.range(0, 400, 1, 1).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS label", "concat('w', id % 7, ' v', id % 2) AS text")
    cfg = TrainConfig(num_features=256, min_doc_freq=1, split_mode=mode)
    outcome = Trainer(cfg, [ModelSpec("LR", lambda: Seen(maxIter=2))]).fit(rows)
    assert outcome.profile["total_rows"] == 400 and sum(seen["parts"]) == outcome.split_sizes["train"]
    assert max(seen["parts"]) <= 64
    assert training.feature_partitions(0, 256) == training.feature_partitions(64, 256) == 1
    assert training.feature_partitions(65, 256) == 2
