"""Serving plans: the documents are dropped as files into a watched folder,
scored by the streaming job (``availableNow`` trigger, several files per
micro-batch) and the written tables are read back."""

from __future__ import annotations

from dataclasses import replace

from pyspark.errors import StreamingQueryException
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from textflow.operators import auc, monitor, score_sketch
from textflow.operators.layout import spread
from textflow.operators.prep import ensure_text_column
from textflow.operators.registry import Registry
from textflow.operators.training import Trainer, default_model_specs
from textflow.plans.catalog import plan, r6, table
from textflow.plans.text_plans import labelled_text
from textflow.schemas import parse_schema
from textflow.session import scratch_path
from textflow.sources.predictions import read_json_predictions, read_predictions
from textflow.streaming import manifest
from textflow.streaming.pins import BatchVersions
from textflow.streaming.progress import attach
from textflow.streaming.scorers import (
    NearestCentroidModel,
    PythonModelScorer,
    load_scorer,
    save_python_model,
)
from textflow.streaming.serving import (
    KNOWN_COLUMNS,
    BatchScorer,
    ServingConfig,
    build_stream,
    read_batch_metrics,
    registry_resolver,
    start_serving,
    utc_date,
)
from textflow.streaming.sinks import compact_date, write_predictions

MODEL_VERSION = "centroid-1"
FILES_PER_TRIGGER = 10    # the reference's deployed setting
# Input files of the stream plans (test value): with 10 files per trigger a
# micro-batch holds at most 1M rows, about 10^4 batches for 10^10 documents.
ROWS_PER_INPUT_FILE = 100_000

# The nearest-centroid model on two features: class means, then the nearer one.
CENTROID_SQL = """
SELECT l.quality AS c, avg(length(d.text)) AS m1, avg(d.n_chars) AS m2
FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY l.quality
"""
PREDICT_SQL = f"""
SELECT d.doc_id, CAST(arg_min(c, pow(length(d.text) - m1, 2) + pow(d.n_chars - m2, 2)) AS DOUBLE) AS prediction
FROM documents d, ({CENTROID_SQL}) WHERE d.text IS NOT NULL GROUP BY d.doc_id
"""
RULE_SQL = f"SELECT doc_id, prediction, '{MODEL_VERSION}' AS model_version FROM ({PREDICT_SQL})"


def centroid_scorer(spark: SparkSession, sf_dir: str) -> PythonModelScorer:
    """A Python model fitted on the labelled documents; it sees all columns."""
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    return PythonModelScorer(NearestCentroidModel.fit(rows, ("text_chars", "n_chars"), "quality"))


def drop_files(df: DataFrame, name: str) -> str:
    """Write ``df`` as JSON-lines files of at most ``ROWS_PER_INPUT_FILE``
    rows to a fresh folder. JSON lines escape the newlines inside texts, so
    the files stay splittable; the number of files (hence micro-batches)
    grows with the data, not with any session setting."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("maxRecordsPerFile", ROWS_PER_INPUT_FILE).json(path)
    return path


def run_stream(spark: SparkSession, cfg: ServingConfig, **kwargs):
    query, handler = start_serving(spark, cfg, **kwargs)
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"stream failed: {query.exception()}")
    return handler


def _rule_config(spark: SparkSession, input_path: str, schema: str) -> ServingConfig:
    root = scratch_path(spark, "serving")
    return ServingConfig(
        output_path=f"{root}/predictions", checkpoint=f"{root}/checkpoint", input_path=input_path,
        file_format="json", schema=schema,
        max_files_per_trigger=FILES_PER_TRIGGER,
        available_now=True, passthrough=("doc_id",), write_json=True,
        json_output_path=f"{root}/predictions_json", metrics_path=f"{root}/batch_metrics",
    )


def rule_serving_run(spark: SparkSession, sf_dir: str) -> ServingConfig:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    cfg = _rule_config(spark, drop_files(docs, "stream-in"), "doc_id BIGINT, text STRING, n_chars BIGINT")
    run_stream(spark, cfg, scorer=centroid_scorer(spark, sf_dir), scorer_version=MODEL_VERSION)
    return cfg


@plan("stream_score_readback", RULE_SQL)
def q_stream_score_readback(spark, sf_dir):
    """File stream -> Python-model scoring -> partitioned Parquet -> read back."""
    cfg = rule_serving_run(spark, sf_dir)
    return read_predictions(spark, cfg.output_path).select("doc_id", "prediction", "model_version")


@plan("stream_json_readback", RULE_SQL)
def q_stream_json_readback(spark, sf_dir):
    """The JSON-lines copy of the same stream, parsed back."""
    cfg = rule_serving_run(spark, sf_dir)
    back = read_json_predictions(spark, cfg.json_output_path,
                                 "doc_id BIGINT, prediction DOUBLE, model_version STRING")
    return back.select("doc_id", "prediction", "model_version")


@plan("udf_score", RULE_SQL)
def q_udf_score(spark, sf_dir):
    """Batch scoring with the Python model through the Arrow pandas UDF."""
    scored = centroid_scorer(spark, sf_dir).score(spread(table(spark, sf_dir, "documents")))
    return scored.select("doc_id", "prediction", F.lit(MODEL_VERSION).alias("model_version"))


@plan("saved_python_model", RULE_SQL)
def q_saved_python_model(spark, sf_dir):
    """The model flavor switch: the Python model saved, loaded as flavor
    ``python`` with named input columns, and applied."""
    path = scratch_path(spark, "python-model")
    save_python_model(spark, centroid_scorer(spark, sf_dir).model, path)
    scorer = load_scorer(spark, path, "python", ("n_chars", "text"))
    scored = scorer.score(spread(table(spark, sf_dir, "documents")))
    return scored.select("doc_id", "prediction", F.lit(MODEL_VERSION).alias("model_version"))


@plan(
    "stream_null_text",
    f"""
    SELECT d.doc_id, CASE WHEN d.doc_id % 3 = 0 THEN NULL ELSE p.prediction END AS prediction,
           (SELECT count(*) FROM documents WHERE doc_id % 3 = 0) AS null_text_rows
    FROM documents d JOIN ({PREDICT_SQL}) p ON d.doc_id = p.doc_id
    """,
)
def q_stream_null_text(spark, sf_dir):
    """A stream in which every third text is null: those rows are written with a
    null prediction and counted, the others are scored."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("doc_id") % 3 != 0, F.col("text")).alias("text"), "n_chars")
    cfg = _rule_config(spark, drop_files(docs, "stream-null"), "doc_id BIGINT, text STRING, n_chars BIGINT")
    run_stream(spark, cfg, scorer=centroid_scorer(spark, sf_dir), scorer_version=MODEL_VERSION)
    nulls = read_batch_metrics(spark, cfg.metrics_path).agg(F.sum("null_text_rows")).scalar()
    return read_predictions(spark, cfg.output_path).select("doc_id", "prediction", nulls.alias("null_text_rows"))


@plan(
    "stream_ingest_columns",
    """
    SELECT doc_id, 'ingest_time,prediction,text' AS known, TRUE AS dated FROM documents
    """,
)
def q_stream_ingest_columns(spark, sf_dir):
    """Output columns of a stream: the known ones present, the ingest time, and
    the UTC date that follows from it."""
    cfg = rule_serving_run(spark, sf_dir)
    out = read_predictions(spark, cfg.output_path)
    known = ",".join(sorted(c for c in out.columns if c in KNOWN_COLUMNS))
    dated = F.col("ingest_time").isNotNull() & (F.col("date").cast("string") == utc_date("ingest_time"))
    return out.select("doc_id", F.lit(known).alias("known"), dated.alias("dated"))


@plan("stream_restart", f"SELECT doc_id, prediction, 1 AS n_rows FROM ({PREDICT_SQL})")
def q_stream_restart(spark, sf_dir):
    """The stream stopped after half of its input and started again from its
    checkpoint: every document is written once."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    path = scratch_path(spark, "stream-restart")
    cfg = _rule_config(spark, path, "doc_id BIGINT, text STRING, n_chars BIGINT")
    for half in (0, 1):
        docs.where(F.pmod(F.col("doc_id"), F.lit(2)) == half).write.mode("append").option(
            "maxRecordsPerFile", ROWS_PER_INPUT_FILE).json(path)
        run_stream(spark, cfg, scorer=centroid_scorer(spark, sf_dir), scorer_version=MODEL_VERSION)
    return read_predictions(spark, cfg.output_path).groupBy("doc_id").agg(
        F.max("prediction").alias("prediction"), F.count(F.lit(1)).cast("int").alias("n_rows"))


class _FailOnce:
    """A batch callback that fails once, after a batch was written and before its commit."""

    def __init__(self, handler):
        self.handler, self.failed = handler, False

    def __call__(self, batch, batch_id):
        self.handler(batch, batch_id)
        if not self.failed:
            self.failed = True
            raise RuntimeError(f"batch {batch_id} fails after its output was written")


# The second version looks at the characters that the table states alone.
CHARS_SQL = """
SELECT d.doc_id, CAST(arg_min(c, abs(d.n_chars - m2)) AS DOUBLE) AS prediction
FROM documents d, (SELECT l.quality AS c, avg(d.n_chars) AS m2 FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY l.quality)
WHERE d.text IS NOT NULL GROUP BY d.doc_id
"""


@plan(
    "stream_version_pin",
    f"""
    SELECT a.doc_id, CASE WHEN a.doc_id % 2 = 0 THEN a.prediction ELSE b.prediction END AS prediction,
           CASE WHEN a.doc_id % 2 = 0 THEN '1' ELSE '2' END AS model_version, 1 AS versions_in_batch, TRUE AS as_pinned
    FROM ({PREDICT_SQL}) a JOIN ({CHARS_SQL}) b ON a.doc_id = b.doc_id
    """,
)
def q_stream_version_pin(spark, sf_dir):
    """A batch that failed after it was written is replayed after a newer model version
    was registered: its version is the one that it was pinned to, and the next batch's
    the newer one. Each half of the documents is a batch."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    labelled = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    source, registry = scratch_path(spark, "stream-pinned"), Registry(spark, scratch_path(spark, "registry"))
    cfg = replace(_rule_config(spark, source, "doc_id BIGINT, text STRING, n_chars BIGINT"),
                  max_files_per_trigger=1_000_000, registry_root=registry.root, model_name="centroid",
                  model_flavor="python", reload_interval_seconds=0)

    def serve(wrap=lambda handler: handler):
        handler = BatchScorer(cfg, registry_resolver(spark, cfg), lambda uri: load_scorer(spark, uri, "python"))
        query = (build_stream(spark, cfg).writeStream.foreachBatch(wrap(handler)).option("checkpointLocation", cfg.checkpoint)
                 .trigger(availableNow=True).start())
        query.awaitTermination()

    halves = [docs.where(F.pmod(F.col("doc_id"), F.lit(2)) == k) for k in (0, 1)]
    registry.register_python_model("centroid", NearestCentroidModel.fit(labelled, ("text_chars", "n_chars"), "quality"))
    halves[0].write.option("maxRecordsPerFile", ROWS_PER_INPUT_FILE).json(source)
    try:
        serve(_FailOnce)
    except StreamingQueryException:
        pass
    registry.register_python_model("centroid", NearestCentroidModel.fit(labelled, ("n_chars",), "quality"))
    serve()
    halves[1].write.mode("append").option("maxRecordsPerFile", ROWS_PER_INPUT_FILE).json(source)
    serve()
    out = read_predictions(spark, cfg.output_path)
    in_batch = out.groupBy("query_id", "batch_id").agg(F.count_distinct("model_version").cast("int").alias("versions_in_batch"))
    pins = BatchVersions(spark, f"{cfg.output_path}/_batch_versions").table().select(
        "query_id", "batch_id", F.col("model_version").alias("pinned"))
    return out.join(in_batch, ["query_id", "batch_id"]).join(pins, ["query_id", "batch_id"]).select(
        "doc_id", "prediction", "model_version", "versions_in_batch", (F.col("model_version") == F.col("pinned")).alias("as_pinned"))


@plan(
    "stream_progress",
    """
    SELECT run, n_rows, 'stopped' AS state, n_rows AS progress_rows, TRUE AS timed FROM (
      SELECT CAST(1 + doc_id % 3 AS INTEGER) AS run, count(*) AS n_rows FROM documents GROUP BY 1)
    """,
)
def q_stream_progress(spark, sf_dir):
    """Three runs of a stream from its checkpoint, each over a third of the documents, in
    the table of progress events: rows and state of each run, and its batches' rows."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    source, log_path = scratch_path(spark, "stream-watched"), scratch_path(spark, "progress")
    cfg = _rule_config(spark, source, "doc_id BIGINT, text STRING, n_chars BIGINT")
    scorer = centroid_scorer(spark, sf_dir)
    for part in range(3):
        docs.where(F.pmod(F.col("doc_id"), F.lit(3)) == part).write.mode("append").option(
            "maxRecordsPerFile", ROWS_PER_INPUT_FILE).json(source)
        log = attach(spark, log_path)   # a log of its own for each run, as of sessions that follow each other
        try:
            query, _ = start_serving(spark, cfg, scorer=scorer, scorer_version=MODEL_VERSION)
            query.awaitTermination()
            log.wait_for(query.runId)
        finally:
            spark.streams.removeListener(log)
            log.flush()
    runs = monitor.stream_runs(spark, log_path)
    by_batch = log.frame().groupBy("run_id").agg(F.sum("num_input_rows").alias("progress_rows"), (F.min("trigger_ms") > 0).alias("timed"))
    return runs.join(by_batch, "run_id").select(
        F.row_number().over(Window.orderBy("first_seen")).alias("run"), "n_rows", "state", "progress_rows", "timed")   # three rows


@plan(
    "batch_metrics",
    """
    SELECT CAST(count(*) AS BIGINT) AS total_batch_rows, CAST(count(*) AS BIGINT) AS total_written_rows
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id
    """,
)
def q_batch_metrics(spark, sf_dir):
    """Per-batch row counts of a labelled stream, summed over the batches."""
    labelled = labelled_text(spark, sf_dir).select("doc_id", "text", "label", F.length("text").alias("n_chars"))
    cfg = _rule_config(spark, drop_files(labelled, "stream-labelled"),
                       "doc_id BIGINT, text STRING, label INT, n_chars BIGINT")
    run_stream(spark, cfg, scorer=centroid_scorer(spark, sf_dir), scorer_version=MODEL_VERSION)
    metrics = read_batch_metrics(spark, cfg.metrics_path)
    return metrics.agg(F.sum("batch_rows").alias("total_batch_rows"),
                       F.sum("written_rows").alias("total_written_rows"))


def registry_serving_run(spark: SparkSession, sf_dir: str):
    """Train LR, register it, serve the labelled stream from the registry."""
    labelled = labelled_text(spark, sf_dir)
    lr = [s for s in default_model_specs() if s.name == "LogisticRegression"]
    from textflow.plans.training_plans import _config

    outcome = Trainer(_config(), lr).fit(labelled)
    root = scratch_path(spark, "served")
    registry = Registry(spark, f"{root}/registry")
    _, uri = registry.register_model("text-model", outcome.results[0].model)
    cfg = ServingConfig(
        output_path=f"{root}/predictions", checkpoint=f"{root}/checkpoint",
        input_path=drop_files(labelled.select("doc_id", "text", "label"), "stream-model-in"),
        file_format="json", schema="doc_id BIGINT, text STRING, label INT",
        max_files_per_trigger=4, available_now=True, passthrough=("doc_id",),
        registry_root=f"{root}/registry", model_name="text-model", reload_interval_seconds=0,
        metrics_path=f"{root}/batch_metrics", sketch_path=f"{root}/sketches",
    )
    run_stream(spark, cfg)
    return cfg, uri, labelled


@plan(
    "stream_model_score",
    """
    SELECT '1' AS model_version, CAST(count(*) AS BIGINT) AS batch_rows, CAST(count(*) AS BIGINT) AS written_rows,
           CAST(count(*) FILTER (WHERE l.quality = 1) AS BIGINT) AS n_pos, TRUE AS areas_in_range, TRUE AS running_within_bound
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE d.text IS NOT NULL
    """,
)
def q_stream_model_score(spark, sf_dir):
    """Registry-served Spark model on a labelled stream: the newest registered version is
    polled and loaded, each batch gets its AUC, and the running AUC of the batches'
    sketches is within its error bound of the exact one over everything written."""
    cfg, _, _ = registry_serving_run(spark, sf_dir)
    batches = read_batch_metrics(spark, cfg.metrics_path).groupBy("model_version").agg(
        F.sum("batch_rows").alias("batch_rows"), F.sum("written_rows").alias("written_rows"),
        F.bool_and(F.col("batch_auc").isNull() | F.col("batch_auc").between(0, 1)).alias("areas_in_range"))
    written = read_predictions(spark, cfg.output_path).where("prediction IS NOT NULL")
    exact = auc.binary_areas_from_raw(written).select(F.col("roc_auc").alias("exact")).scalar()
    running = score_sketch.running_area(spark, cfg.sketch_path)
    near = F.abs(F.col("roc_auc") - exact) <= F.col("error_bound") + 1e-12
    return batches.crossJoin(running.select("n_pos", near.alias("running_within_bound"))).select(   # a row each
        "model_version", "batch_rows", "written_rows", "n_pos", "areas_in_range", "running_within_bound")


@plan(
    "stream_batch_parity",
    """
    SELECT d.doc_id, TRUE AS same_as_batch, '1' AS model_version
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id
    """,
)
def q_stream_batch_parity(spark, sf_dir):
    """Every streamed prediction (and raw score) equals batch scoring of the
    same registered model, and carries that model's version."""
    cfg, uri, labelled = registry_serving_run(spark, sf_dir)
    streamed = read_predictions(spark, cfg.output_path).select(
        "doc_id", "model_version", "prediction", vector_to_array("rawPrediction").alias("raw"))
    batch = PipelineModel.load(uri).transform(labelled).select(
        "doc_id", F.col("prediction").alias("p_batch"), vector_to_array("rawPrediction").alias("raw_batch"))
    same = (F.col("prediction") == F.col("p_batch")) & (F.col("raw") == F.col("raw_batch"))
    return streamed.join(batch, "doc_id").select("doc_id", same.alias("same_as_batch"), "model_version")


def _events_as_predictions(spark: SparkSession, sf_dir: str) -> str:
    events = table(spark, sf_dir, "events")
    rows = events.select(
        "event_id", F.col("value").alias("prediction"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.lit("events").alias("query_id"), F.lit(0).cast("bigint").alias("batch_id"),
    )
    path = scratch_path(spark, "event-predictions")
    write_predictions(rows, path)
    return path


@plan(
    "predictions_by_date",
    "SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS n_rows FROM events GROUP BY 1",
)
def q_predictions_by_date(spark, sf_dir):
    """Events written as a date-partitioned prediction table, counted per date."""
    return monitor.predictions_by_date(spark, _events_as_predictions(spark, sf_dir))


@plan(
    "predictions_one_date",
    """
    SELECT event_id, prediction FROM (
      SELECT event_id, value AS prediction, strftime(ts, '%Y-%m-%d') AS date FROM events)
    WHERE date = (SELECT min(strftime(ts, '%Y-%m-%d')) FROM events)
    """,
)
def q_predictions_one_date(spark, sf_dir):
    """Read back a single date partition (the folder is pruned, not filtered row by row)."""
    path = _events_as_predictions(spark, sf_dir)
    first = table(spark, sf_dir, "events").agg(F.min(F.date_format("ts", "yyyy-MM-dd"))).first()[0]
    return read_predictions(spark, path, date=first).select("event_id", "prediction")


def _event_dates_rewritten(spark: SparkSession, sf_dir: str) -> str:
    """The events' prediction table with a manifest, its five oldest dates written again
    one by one (late or replayed batches), the oldest last."""
    events = table(spark, sf_dir, "events")
    dated = events.select("event_id", F.col("value").alias("prediction"), F.date_format("ts", "yyyy-MM-dd").alias("date"),
                          F.lit("events").alias("query_id"), F.lit(0).cast("bigint").alias("batch_id"))
    path = scratch_path(spark, "event-predictions")
    write_predictions(dated, path)
    dates = sorted(r["date"] for r in dated.select("date").distinct().collect())   # a row a day
    manifest.record(spark, path, dates, "events", 0)
    for date in reversed(dates[:5]):
        write_predictions(dated.where(F.col("date") == date).coalesce(1), path)
        manifest.record(spark, path, [date], "events", 0)
    return path


@plan(
    "recent_outputs",
    """
    SELECT row_number() OVER (ORDER BY date) AS place, date, n_rows, TRUE AS sized FROM (
      SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS n_rows FROM events GROUP BY 1 ORDER BY 1 LIMIT 5)
    """,
)
def q_recent_outputs(spark, sf_dir):
    """The five newest files of the prediction table, from its manifest: the oldest dates
    were written last, so they stand before all later dates."""
    path = _event_dates_rewritten(spark, sf_dir)
    newest = monitor.recent_files(spark, path, n=5)
    counts = manifest.files(spark, path).select("path", "date", "n_rows", "n_bytes")
    place = F.row_number().over(Window.orderBy(F.desc("modified"), F.desc("path")))   # five rows
    return newest.withColumn("place", place.cast("bigint")).join(counts, "path").select(
        "place", "date", "n_rows", ((F.col("size") == F.col("n_bytes")) & (F.col("size") > 0)).alias("sized"))


@plan(
    "output_manifest",
    """
    SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS n_rows, count(*) AS n_read,
           strftime(ts, '%Y-%m-%d') = (SELECT min(strftime(ts, '%Y-%m-%d')) FROM events) AS compacted
    FROM events GROUP BY 1
    """,
)
def q_output_manifest(spark, sf_dir):
    """Rows of each date by the manifest, after late batches and the compaction of a
    date, beside the rows that are read back."""
    path = _event_dates_rewritten(spark, sf_dir)
    first = manifest.files(spark, path).agg(F.min("date")).first()[0]
    compact_date(spark, path, first)
    told = manifest.files(spark, path).groupBy("date").agg(
        F.sum("n_rows").alias("n_rows"), F.bool_and(F.col("query_id") == manifest.COMPACTED).alias("compacted"))
    read = read_predictions(spark, path).groupBy("date").agg(F.count(F.lit(1)).alias("n_read"))
    return told.join(read, "date").select("date", "n_rows", "n_read", "compacted")


@plan("recent_outputs_24h", "SELECT TRUE AS within_24h, CAST(count(*) AS BIGINT) AS n_rows FROM events")
def q_recent_outputs_24h(spark, sf_dir):
    """The output files that were written within 24 hours (today's table of scored events):
    all are that new, and the rows that their manifest names are all events."""
    today = F.date_format(F.current_date(), "yyyy-MM-dd")
    events = table(spark, sf_dir, "events").select(
        "event_id", F.col("value").alias("prediction"), today.alias("date"),
        F.lit("events").alias("query_id"), F.lit(0).cast("bigint").alias("batch_id"))
    path = scratch_path(spark, "todays-predictions")
    write_predictions(events, path)
    manifest.record(spark, path, [spark.range(1).select(today).first()[0]], "events", 0)
    recent = monitor.recent_files(spark, path, n=1_000_000, within_hours=24)
    counts = manifest.files(spark, path).select("path", "n_rows")
    new = F.col("modified") >= F.current_timestamp() - F.expr("INTERVAL 24 HOURS")
    return recent.join(counts, "path").agg(F.bool_and(new).alias("within_24h"), F.sum("n_rows").alias("n_rows"))


def _third(spark: SparkSession, sf_dir: str, part: int) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    return docs.where(F.pmod(F.col("doc_id"), F.lit(3)) == part)


@plan(
    "stream_hot_swap",
    f"""
    SELECT a.doc_id, CASE WHEN a.doc_id % 3 = 0 THEN a.prediction ELSE b.prediction END AS prediction,
           CASE WHEN a.doc_id % 3 = 0 THEN '1' ELSE '2' END AS model_version
    FROM ({PREDICT_SQL}) a JOIN ({CHARS_SQL}) b ON a.doc_id = b.doc_id
    """,
)
def q_stream_hot_swap(spark, sf_dir):
    """One run of a stream that goes on while a newer version is registered, and then while
    the registry can't be reached: the newer model is swapped in between batches, and
    stays. Each third of the documents is what arrives at a time."""
    labelled = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    source, registry = scratch_path(spark, "stream-swapped"), Registry(spark, scratch_path(spark, "registry"))
    cfg = replace(_rule_config(spark, source, "doc_id BIGINT, text STRING, n_chars BIGINT"), registry_root=registry.root,
                  model_name="centroid", model_flavor="python", reload_interval_seconds=0, available_now=False, trigger_seconds=0)
    newest, reachable = registry_resolver(spark, cfg), [True]

    def resolve():
        if not reachable[0]:
            raise ConnectionError("the registry is away")
        return newest()

    registry.register_python_model("centroid", NearestCentroidModel.fit(labelled, ("text_chars", "n_chars"), "quality"))
    _third(spark, sf_dir, 0).write.option("maxRecordsPerFile", ROWS_PER_INPUT_FILE).json(source)
    query, _ = start_serving(spark, cfg, resolver=resolve)
    try:
        query.processAllAvailable()
        registry.register_python_model("centroid", NearestCentroidModel.fit(labelled, ("n_chars",), "quality"))
        for part in (1, 2):
            _third(spark, sf_dir, part).write.mode("append").option("maxRecordsPerFile", ROWS_PER_INPUT_FILE).json(source)
            query.processAllAvailable()
            reachable[0] = False
    finally:
        query.stop()
    return read_predictions(spark, cfg.output_path).select("doc_id", "prediction", "model_version")


@plan(
    "stream_without_model",
    f"SELECT doc_id, prediction, '1' AS model_version, TRUE AS waited, TRUE AS none_written FROM ({PREDICT_SQL})",
)
def q_stream_without_model(spark, sf_dir):
    """A stream that starts before any model is registered: an empty batch passes, one with
    rows fails without a trace in the output, and is scored by the first version after a
    restart."""
    labelled = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    source, registry = scratch_path(spark, "stream-early"), Registry(spark, scratch_path(spark, "registry"))
    cfg = replace(_rule_config(spark, source, "doc_id BIGINT, text STRING, n_chars BIGINT"), registry_root=registry.root,
                  model_name="centroid", model_flavor="python")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    docs.limit(0).write.json(source)
    run_stream(spark, cfg)    # nothing to score: no model needed
    docs.write.mode("append").option("maxRecordsPerFile", ROWS_PER_INPUT_FILE).json(source)
    try:
        run_stream(spark, cfg)
        waited = False
    except StreamingQueryException as problem:
        waited = "no model available" in str(problem)
    none_written = manifest.files(spark, cfg.output_path).isEmpty()
    registry.register_python_model("centroid", NearestCentroidModel.fit(labelled, ("text_chars", "n_chars"), "quality"))
    run_stream(spark, cfg)
    return read_predictions(spark, cfg.output_path).select(
        "doc_id", "prediction", "model_version", F.lit(waited).alias("waited"), F.lit(none_written).alias("none_written"))


@plan(
    "stream_sink_policy",
    f"SELECT doc_id, prediction, TRUE AS in_json, 1 AS failed_runs FROM ({PREDICT_SQL})",
)
def q_stream_sink_policy(spark, sf_dir):
    """An optional sink that fails (Kafka without a connector): with 'raise' the batch isn't
    committed and the query ends; restarted with 'warn' the same batch replaces what it
    had written, and the stream goes on."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    cfg = replace(_rule_config(spark, drop_files(docs, "stream-sinks"), "doc_id BIGINT, text STRING, n_chars BIGINT"),
                  write_kafka=True, kafka_output_bootstrap="localhost:1", kafka_output_topic="scored")
    scorer, failed = centroid_scorer(spark, sf_dir), 0
    for policy in ("raise", "warn"):
        try:
            run_stream(spark, replace(cfg, on_error=policy), scorer=scorer, scorer_version=MODEL_VERSION)
        except StreamingQueryException:
            failed += 1
    copy = read_json_predictions(spark, cfg.json_output_path, "doc_id BIGINT").select("doc_id", F.lit(True).alias("copied"))
    return read_predictions(spark, cfg.output_path).join(copy, "doc_id", "left").select(
        "doc_id", "prediction", F.coalesce("copied", F.lit(False)).alias("in_json"), F.lit(failed).alias("failed_runs"))


@plan(
    "stream_schema_file",
    "SELECT doc_id, length(text) AS n_text, n_chars, form FROM documents, (VALUES ('ddl'), ('json')) f(form)",
)
def q_stream_schema_file(spark, sf_dir):
    """Streams over files whose schema is given by the user, as DDL and as JSON: every value
    arrives under the type that the schema names."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    source, out = drop_files(docs, "stream-typed"), []
    ddl = "doc_id BIGINT, text STRING, n_chars BIGINT"
    for form, spec in (("ddl", ddl), ("json", StructType.fromDDL(ddl).json())):
        cfg = replace(_rule_config(spark, source, parse_schema(spec)), passthrough=("doc_id", "n_chars"))
        run_stream(spark, cfg, scorer=centroid_scorer(spark, sf_dir), scorer_version=MODEL_VERSION)
        out.append(read_predictions(spark, cfg.output_path).select(
            "doc_id", F.char_length("text").cast("bigint").alias("n_text"), "n_chars", F.lit(form).alias("form")))
    return out[0].unionByName(out[1])


@plan(
    "guarded_text",
    "SELECT CAST(length(text) AS INTEGER) AS n_text, count(*) AS n_rows, TRUE AS refused FROM documents GROUP BY 1",
)
def q_guarded_text(spark, sf_dir):
    """The text guard: a sole column of any name is the text; of several without that name
    it is refused."""
    docs = table(spark, sf_dir, "documents")
    guarded = ensure_text_column(docs.select(F.col("text").alias("body")))
    try:
        ensure_text_column(docs.select("doc_id", F.col("text").alias("body")))
        refused = False
    except ValueError:
        refused = True
    return guarded.groupBy(F.char_length("text").alias("n_text")).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("refused", F.lit(refused))
