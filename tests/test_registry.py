import time

from pyspark.ml import PipelineModel
from pyspark.ml.feature import Tokenizer

from textflow.operators import registry as reg
from textflow.schemas import MODEL_VERSIONS, RUN_METRICS, RUN_PARAMS, RUNS
from textflow.streaming.holder import ModelHolder


def _versions(spark, rows):
    return spark.createDataFrame([(n, v, s, u, r, None) for n, v, s, u, r in rows], MODEL_VERSIONS)


def test_newest_version_is_numeric(spark):
    df = _versions(spark, [("text-model", v, "None", f"models:/text-model/{v}", None) for v in ("1", "10", "2")])
    row = reg.latest_versions(df).first()
    assert row["version"] == "10"
    assert row["uri"] == "models:/text-model/10"


def test_stage_filter_and_several_names(spark):
    df = _versions(spark, [
        ("a", "1", "Production", "u1", None), ("a", "3", "Staging", "u3", None),
        ("b", "7", "Production", "u7", None),
    ])
    latest = {r["name"]: r["version"] for r in reg.latest_versions(df).collect()}
    prod = {r["name"]: r["version"] for r in reg.latest_versions(df, stage="Production").collect()}
    assert latest == {"a": "3", "b": "7"} and prod == {"a": "1", "b": "7"}


def test_model_holder_set_get():
    holder = ModelHolder()
    assert holder.due(300)
    holder.set("model", "3", "models:/text-model/3")
    assert holder.get() == ("model", "3", "models:/text-model/3")
    assert not holder.due(300)
    holder.mark_checked(time.time() - 301)
    assert holder.due(300)


def _runs(spark):
    runs = spark.createDataFrame([
        ("r1", None, "exp", "LogisticRegression", 0, None),
        ("r2", None, "exp", "RandomForest", 1, None),
        ("r3", None, "exp", "LinearSVC", 2, None),
    ], RUNS)
    metrics = spark.createDataFrame([
        ("r1", "accuracy", 0.8), ("r1", "auc", 0.9),
        ("r2", "accuracy", 0.8),
        ("r3", "accuracy", 0.5), ("r3", "weighted_f1", 0.4),
    ], RUN_METRICS)
    params = spark.createDataFrame([("r1", "model_type", "LogisticRegression")], RUN_PARAMS)
    return runs, metrics, params


def test_best_run_tie_first_position_and_unknown(spark):
    runs, metrics, params = _runs(spark)
    best = reg.best_run(runs, metrics, params).first()
    assert best["run_id"] == "r1" and best["auc"] == 0.9 and best["model_type"] == "LogisticRegression"
    no_params = spark.createDataFrame([], RUN_PARAMS)
    best2 = reg.best_run(runs.where("run_id != 'r1'"), metrics, no_params).first()
    assert best2["run_id"] == "r2" and best2["auc"] is None and best2["model_type"] == "unknown"


def test_version_metrics_missing_is_null(spark):
    _, metrics, _ = _runs(spark)
    versions = _versions(spark, [("m", "1", None, "u", "r2"), ("m", "2", None, "u", "r3")])
    rows = {r["version"]: r for r in reg.version_metrics(versions, metrics).collect()}
    assert rows["1"]["accuracy"] == 0.8 and rows["1"]["auc"] is None
    assert rows["2"]["weighted_f1"] == 0.4


def test_best_model_none_when_all_zero(spark):
    results = spark.createDataFrame([("a", 0, 0.0), ("b", 1, 0.0)], "model string, position int, accuracy double")
    assert reg.best_model(results).count() == 0
    tied = spark.createDataFrame([("a", 0, 0.7), ("b", 1, 0.7)], "model string, position int, accuracy double")
    assert reg.best_model(tied).first()["model"] == "a"
    assert reg.metric_gate(tied, "accuracy", 0.75).count() == 0


def test_registry_store_roundtrip(spark, tmp_dir):
    store = reg.Registry(spark, tmp_dir)
    assert store.latest("m") == (None, None)
    model = PipelineModel(stages=[Tokenizer(inputCol="text", outputCol="tokens")])
    run = store.start_run("child", "exp", position=0)
    store.log_params(run, {"model_type": "T"})
    store.log_metrics(run, {"accuracy": 0.5})
    v1 = store.register_model("m", model, run)
    v2 = store.register_model("m", model, run, stage="Production")
    assert (v1[0], v2[0]) == ("1", "2")
    assert store.latest("m") == v2
    assert store.latest("m", stage="Production") == v2
    loaded = store.load(v2[1])
    assert loaded.transform(spark.createDataFrame([("A b",)], "text string")).first()["tokens"] == ["a", "b"]
    assert store.table("run_metrics").count() == 1


def test_batched_logging_appends_once_per_table(spark, tmp_dir):
    import os

    store = reg.Registry(spark, tmp_dir)
    model = PipelineModel(stages=[Tokenizer(inputCol="text", outputCol="tokens")])
    with store.batch():
        for i in range(3):
            run = store.start_run(f"r{i}", "exp", position=i)
            store.log_metrics(run, {"accuracy": i / 10})
            store.register_model("m", model, run)
        assert not os.path.exists(f"{tmp_dir}/run_metrics")
    assert store.table("run_metrics").count() == 3
    assert sorted(r["version"] for r in store.table("model_versions").collect()) == ["1", "2", "3"]
    assert len([f for f in os.listdir(f"{tmp_dir}/run_metrics") if f.startswith("part-")]) <= 2
