"""spark-submit entry points: ``train``, ``serve``, ``compact``, ``stage`` and ``monitor``.

    spark-submit --py-files textflow.zip textflow/cli.py train \
        --input corpus/ --output out/ --registry reg/
    spark-submit --py-files textflow.zip textflow/cli.py serve --input-path in/ \
        --output-path preds/ --checkpoint ckpt/ --registry reg/ --model-name text-model-best

Flags map one-to-one onto ``TrainConfig`` / ``ServingConfig``.
"""

from __future__ import annotations

import argparse
import json
import logging
import sys

from textflow.functions.payload import parse_flag
from textflow.operators.prep import trim_text
from textflow.operators.profile import validate_input
from textflow.operators.monitor import predictions_by_date, recent_files, stream_runs
from textflow.operators.registry import STAGES, Registry
from textflow.operators.score_sketch import running_area
from textflow.operators.training import PRESETS, Trainer, record_outcome, save_outcome
from textflow.schemas import load_schema_file
from textflow.session import build_session
from textflow.sources.corpus import check_arity, read_labelled_csv
from textflow.streaming.progress import attach, merge_date
from textflow.streaming.serving import ServingConfig, start_serving
from textflow.streaming.sinks import compact_date


def _train_args(sub) -> None:
    p = sub.add_parser("train", help="train, evaluate, register and save the classifiers")
    p.add_argument("--input", required=True, help="headerless six-column CSV (file, folder or glob)")
    p.add_argument("--output", required=True, help="folder for saved models and their index")
    p.add_argument("--registry", default=None, help="registry root (runs, metrics, model versions)")
    p.add_argument("--experiment", default="default")
    p.add_argument("--registered-model-name", default="text-model")
    p.add_argument("--preset", choices=sorted(PRESETS), default="full")
    p.add_argument("--num-features", type=int)
    p.add_argument("--min-doc-freq", type=int)
    p.add_argument("--train-ratio", type=float)
    p.add_argument("--val-ratio", type=float)
    p.add_argument("--sample-fraction", type=float)
    p.add_argument("--max-rows", type=int)
    p.add_argument("--enable-cv", action="store_true")
    p.add_argument("--cv-folds", type=int)
    p.add_argument("--split-mode", choices=["keyed", "random"])
    p.add_argument("--select-on", choices=["test", "val"])
    p.add_argument("--select-metric")
    p.add_argument("--parallelism", type=int)
    p.add_argument("--auc-mode", choices=["exact", "evaluator"])
    p.add_argument("--multi-line", action="store_true", help="texts contain newlines")
    p.add_argument("--publish-above", type=float, help="publish the best model only if its metric is above this")
    p.add_argument("--certify", action="store_true", help="log how near logistic regressions are to their optimum")


def _serve_args(sub) -> None:
    p = sub.add_parser("serve", help="score a file or Kafka stream with the newest registered model")
    p.add_argument("--source-type", choices=["file", "kafka"], default="file")
    p.add_argument("--input-path")
    p.add_argument("--file-format", default="csv")
    p.add_argument("--file-schema", help="schema file (JSON or DDL)")
    p.add_argument("--header", default="false")
    p.add_argument("--multi-line", default="false")
    p.add_argument("--max-files-per-trigger", type=int, default=1)
    p.add_argument("--kafka-bootstrap")
    p.add_argument("--kafka-topic")
    p.add_argument("--starting-offsets", default="latest")
    p.add_argument("--max-offsets-per-trigger", type=int)
    p.add_argument("--output-path", required=True)
    p.add_argument("--json-output-path")
    p.add_argument("--write-json", default="false")
    p.add_argument("--write-kafka", default="false")
    p.add_argument("--kafka-output-bootstrap")
    p.add_argument("--kafka-output-topic")
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--registry", required=True)
    p.add_argument("--model-name", required=True)
    p.add_argument("--model-stage")
    p.add_argument("--model-flavor", choices=["spark", "python"], default="spark")
    p.add_argument("--batch-interval-seconds", type=float, default=30.0)
    p.add_argument("--reload-interval-seconds", type=float, default=300.0)
    p.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    p.add_argument("--metrics-path")
    p.add_argument("--sketch-path", help="score sketches of labelled batches (running AUC)")
    p.add_argument("--progress-path", help="table of progress events (monitoring beyond the session)")
    p.add_argument("--on-error", choices=["raise", "warn"], default="raise")
    p.add_argument("--passthrough", default="", help="comma-separated input columns to keep (e.g. kafka_ts,id)")
    p.add_argument("--model-input-cols", nargs="*", help="columns a Python model sees (default: all)")
    p.add_argument("--bytes-per-file", type=int, default=128 << 20, help="size that a batch's output files are planned for")
    p.add_argument("--score-partitions", type=int, help="spread each batch over this many tasks before scoring")
    p.add_argument("--rows-per-file", type=int, default=1_000_000)
    p.add_argument("--query-name")


def _compact_args(sub) -> None:
    p = sub.add_parser("compact", help="merge the micro-batch folders of closed dates")
    p.add_argument("--output-path", required=True, help="the prediction table")
    p.add_argument("--date", required=True, action="append", help="a closed date (repeatable)")
    p.add_argument("--rows-per-file", type=int, default=1_000_000)


    p.add_argument("--progress-path", help="merge the dates' progress events too")


def run_compact(spark, args) -> dict:
    done = {d: compact_date(spark, args.output_path, d, args.rows_per_file) for d in args.date}
    told = {"compacted_rows": done}
    if args.progress_path:
        told["progress_events"] = {d: merge_date(spark, args.progress_path, d) for d in args.date}
    print(json.dumps(told))
    return done


def _stage_args(sub) -> None:
    p = sub.add_parser("stage", help="move a registered version to another stage")
    p.add_argument("--registry", required=True)
    p.add_argument("--model-name", required=True)
    p.add_argument("--version", required=True)
    p.add_argument("--to", required=True, choices=STAGES)
    p.add_argument("--archive-others", action="store_true", help="archive the versions that are in that stage now")


def run_stage(spark, args) -> dict:
    registry = Registry(spark, args.registry)
    before = registry.move(args.model_name, args.version, args.to, args.archive_others)
    told = {"version": args.version, "from": before, "to": args.to, "newest_there": registry.latest(args.model_name, args.to)[0]}
    print(json.dumps(told))
    return told


def _monitor_args(sub) -> None:
    p = sub.add_parser("monitor", help="runs, newest files, rows by date and running AUC of a serving output")
    p.add_argument("--output-path", required=True)
    p.add_argument("--progress-path")
    p.add_argument("--sketch-path")
    p.add_argument("--since", help="first date to look at (yyyy-MM-dd)")
    p.add_argument("--files", type=int, default=5)
    p.add_argument("--within-hours", type=float)
    p.add_argument("--stale-seconds", type=float, default=300.0)


def run_monitor(spark, args) -> dict:
    """What the serving job has done and is doing, from its records alone: it need not run
    in this session, nor run at all."""
    told = {
        "rows_by_date": {r["date"]: r["n_rows"] for r in predictions_by_date(spark, args.output_path, args.since).collect()},
        "newest_files": [r.asDict() for r in recent_files(spark, args.output_path, args.files, args.within_hours, args.since).collect()],
    }
    if args.progress_path:
        runs = stream_runs(spark, args.progress_path, args.stale_seconds, args.since)
        told["runs"] = [r.asDict() for r in runs.orderBy("first_seen").collect()]
    if args.sketch_path:
        told["running_auc"] = running_area(spark, args.sketch_path).first().asDict()
    print(json.dumps(told, default=str))
    return told


def run_train(spark, args) -> dict:
    overrides = {
        k: v for k, v in {
            "num_features": args.num_features, "min_doc_freq": args.min_doc_freq,
            "train_ratio": args.train_ratio, "val_ratio": args.val_ratio,
            "sample_fraction": args.sample_fraction, "max_rows": args.max_rows,
            "cv_folds": args.cv_folds, "split_mode": args.split_mode, "select_on": args.select_on,
            "select_metric": args.select_metric, "parallelism": args.parallelism,
            "auc_mode": args.auc_mode,
        }.items() if v is not None
    }
    for flag in ("enable_cv", "certify"):
        if getattr(args, flag):
            overrides[flag] = True
    cfg = PRESETS[args.preset].with_(key_col="id", **overrides)
    check_arity(spark, args.input, multi_line=args.multi_line)
    labelled = trim_text(read_labelled_csv(spark, args.input, keep=("id",), multi_line=args.multi_line))
    profile = validate_input(labelled)
    outcome = Trainer(cfg).fit(labelled)
    index = save_outcome(spark, outcome, args.output)
    versions = {}
    if args.registry:
        versions = record_outcome(outcome, Registry(spark, args.registry), cfg,
                                  args.registered_model_name, args.experiment, args.publish_above)
    summary = {
        "profile": profile,
        "split_sizes": outcome.split_sizes,
        "models": {r.name: {k: r.metrics.get(k) for k in ("accuracy", "auc", "weighted_f1")}
                   for r in outcome.results},
        "best": outcome.best.name if outcome.best else None,
        "saved": [row["path"] for row in index.collect()],
        "versions": versions,
    }
    print(json.dumps(summary, default=str))
    return summary


def serving_config(args) -> ServingConfig:
    return ServingConfig(
        output_path=args.output_path, checkpoint=args.checkpoint, source_type=args.source_type,
        input_path=args.input_path, file_format=args.file_format,
        schema=load_schema_file(args.file_schema) if args.file_schema else None,
        header=parse_flag(args.header), multi_line=parse_flag(args.multi_line),
        max_files_per_trigger=args.max_files_per_trigger, kafka_bootstrap=args.kafka_bootstrap,
        kafka_topic=args.kafka_topic, starting_offsets=args.starting_offsets,
        max_offsets_per_trigger=args.max_offsets_per_trigger, model_name=args.model_name,
        model_stage=args.model_stage, model_flavor=args.model_flavor, registry_root=args.registry,
        reload_interval_seconds=args.reload_interval_seconds, trigger_seconds=args.batch_interval_seconds,
        available_now=args.available_now, write_json=parse_flag(args.write_json),
        json_output_path=args.json_output_path, write_kafka=parse_flag(args.write_kafka),
        kafka_output_bootstrap=args.kafka_output_bootstrap, kafka_output_topic=args.kafka_output_topic,
        metrics_path=args.metrics_path, sketch_path=args.sketch_path, on_error=args.on_error,
        passthrough=tuple(c.strip() for c in args.passthrough.split(",") if c.strip()),
        score_partitions=args.score_partitions, rows_per_file=args.rows_per_file, bytes_per_file=args.bytes_per_file,
        model_input_cols=tuple(args.model_input_cols) if args.model_input_cols else None,
        query_name=args.query_name,
    ).validate()


def run_serve(spark, args):
    log = attach(spark, args.progress_path) if args.progress_path else None
    query, handler = start_serving(spark, serving_config(args))
    try:
        query.awaitTermination()
    finally:
        if log is not None:
            log.wait_for(query.runId)
            log.flush()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return handler


def main(argv=None) -> int:
    parser = argparse.ArgumentParser(prog="textflow")
    sub = parser.add_subparsers(dest="command", required=True)
    _train_args(sub)
    _serve_args(sub)
    _compact_args(sub)
    _stage_args(sub)
    _monitor_args(sub)
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = build_session(app_name=f"textflow-{args.command}")
    if args.command == "train":
        run_train(spark, args)
    elif args.command in ("compact", "stage", "monitor"):
        {"compact": run_compact, "stage": run_stage, "monitor": run_monitor}[args.command](spark, args)
    else:
        run_serve(spark, args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
