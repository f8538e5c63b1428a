import argparse
import os

from pyspark.sql import functions as F

from conftest import SF01
from textflow import cli
from textflow.plans.text_plans import raw_corpus
from textflow.sources.corpus import write_raw_corpus
from textflow.sources.predictions import read_predictions


def _parse(argv):
    parser = argparse.ArgumentParser()
    sub = parser.add_subparsers(dest="command", required=True)
    cli._train_args(sub)
    cli._serve_args(sub)
    cli._compact_args(sub)
    return parser.parse_args(argv)


def test_train_then_serve_end_to_end(spark, tmp_dir):
    corpus = f"{tmp_dir}/corpus"
    write_raw_corpus(raw_corpus(spark, SF01), corpus)
    args = _parse(["train", "--input", corpus, "--output", f"{tmp_dir}/out", "--registry", f"{tmp_dir}/reg",
                   "--registered-model-name", "txt", "--num-features", "4096", "--min-doc-freq", "2",
                   "--multi-line", "--parallelism", "3"])
    summary = cli.run_train(spark, args)
    assert set(summary["models"]) == {"LogisticRegression", "RandomForest", "LinearSVC"}
    assert summary["best"] in summary["models"] and len(summary["saved"]) == 3
    assert summary["versions"]["best"][0] == "1"

    stream_in = f"{tmp_dir}/stream_in"
    (spark.read.parquet(f"{SF01}/documents.parquet").select("text").limit(50).coalesce(2)
     .write.option("header", "true").option("escape", '"').csv(stream_in))
    serve = _parse(["serve", "--input-path", stream_in, "--header", "true", "--multi-line", "true",
                    "--max-files-per-trigger", "10", "--output-path", f"{tmp_dir}/preds",
                    "--checkpoint", f"{tmp_dir}/ckpt", "--registry", f"{tmp_dir}/reg",
                    "--model-name", "txt-best", "--available-now", "--write-json", "true",
                    "--json-output-path", f"{tmp_dir}/preds_json"])
    cli.run_serve(spark, serve)
    preds = read_predictions(spark, f"{tmp_dir}/preds")
    assert preds.count() == 50
    assert preds.where(F.col("model_version") != "1").count() == 0
    assert os.path.isdir(f"{tmp_dir}/preds_json")
    day = preds.select("date").first()[0]
    done = cli.run_compact(spark, _parse(["compact", "--output-path", f"{tmp_dir}/preds", "--date", day]))
    assert done == {day: 50}
    assert read_predictions(spark, f"{tmp_dir}/preds").count() == 50


def test_stage_and_monitor_commands(spark, tmp_dir, capsys):
    import argparse
    import json
    from types import SimpleNamespace

    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import Tokenizer
    from pyspark.sql import functions as F

    from textflow import cli
    from textflow.operators.registry import Registry
    from textflow.streaming import manifest, sinks
    from textflow.streaming.progress import ProgressLog

    registry = Registry(spark, f"{tmp_dir}/reg")
    for _ in range(2):
        registry.register_model("m", PipelineModel([Tokenizer(inputCol="text", outputCol="t")]))

    def parsed(*words):
        parser = argparse.ArgumentParser()
        sub = parser.add_subparsers(dest="command")
        cli._stage_args(sub)
        cli._monitor_args(sub)
        cli._compact_args(sub)
        return parser.parse_args(words)

    common = ("stage", "--registry", f"{tmp_dir}/reg", "--model-name", "m")
    cli.run_stage(spark, parsed(*common, "--version", "1", "--to", "Production"))
    told = cli.run_stage(spark, parsed(*common, "--version", "2", "--to", "Production", "--archive-others"))
    assert told == {"version": "2", "from": None, "to": "Production", "newest_there": "2"}
    assert {r["version"]: r["stage"] for r in registry.versions("m").collect()} == {"1": "Archived", "2": "Production"}

    rows = spark.range(9).select("id", F.lit("2024-01-02").alias("date"), F.lit("q").alias("query_id"), F.lit(0).cast("long").alias("batch_id"))
    sinks.write_predictions(rows, f"{tmp_dir}/out")
    manifest.record(spark, f"{tmp_dir}/out", ["2024-01-02"], "q", 0)
    log = ProgressLog(spark, f"{tmp_dir}/log")
    log.onQueryStarted(SimpleNamespace(id="q", runId="r", name="serving", timestamp="t"))
    log.onQueryTerminated(SimpleNamespace(id="q", runId="r", exception=None))
    capsys.readouterr()
    args = ("--output-path", f"{tmp_dir}/out", "--progress-path", f"{tmp_dir}/log")
    cli.run_monitor(spark, parsed("monitor", *args, "--sketch-path", f"{tmp_dir}/none"))
    told = json.loads(capsys.readouterr().out)
    assert told["rows_by_date"] == {"2024-01-02": 9} and len(told["newest_files"]) >= 1
    assert [(r["name"], r["state"]) for r in told["runs"]] == [("serving", "stopped")]
    assert told["running_auc"]["n_pos"] == 0
    assert cli.run_compact(spark, parsed("compact", *args, "--date", "2024-01-02")) == {"2024-01-02": 9}
