"""Micro-batch scoring of a file or Kafka stream with model hot-swap.

Per batch (``foreachBatch``), on the driver:

1. a batch that was tried before is scored by the version it was pinned to
   (``pins.py``). For a new one poll the registry when the reload interval has
   passed (every successful poll restarts the interval) and swap in a newer
   version -- only *between* batches, so one batch is always scored by one
   model; a failed poll or load keeps the cached model, and with no model at all
   a batch with rows *raises* so it is not committed and is replayed after a
   restart. The version is pinned before anything is scored;
2. score the rows that have a text; the rows without one (an ML tokenizer would
   fail the whole batch, and every replay of it) get a null prediction and are
   counted; keep the known output columns, stamp ``model_version`` and the
   UTC ``date`` of ``ingest_time`` (set in the streaming plan, hence equal
   across actions and across a replay of the batch);
3. one job reads, scores and persists the batch (at the source's parallelism);
   its row counts, bytes and dates are observed on the way, so no job counts
   them. An empty batch ends here;
4. write Parquet with as few files as the row count needs (dynamic overwrite by
   date/query/batch), then the optional JSON and Kafka copies, the manifest of
   the files and the batch metrics; unpersist.

Required steps raise; optional sinks follow ``on_error`` ('raise' or 'warn').
"""

from __future__ import annotations

import logging
import time
from contextlib import contextmanager
from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textflow.functions.payload import parse_flag
from textflow.operators import auc as auc_ops
from textflow.operators import score_sketch
from textflow.operators.layout import spread
from textflow.operators.prep import ensure_text_column
from textflow.operators.registry import Registry
from textflow.schemas import BATCH_METRICS
from textflow.sources.stream import FILE_FORMATS, file_stream, kafka_stream
from textflow.streaming import manifest, sinks
from textflow.streaming.holder import ModelHolder
from textflow.streaming.pins import BatchVersions
from textflow.streaming.scorers import INTERNAL, load_scorer

log = logging.getLogger("textflow.serving")

# Fixed values (the output contract): columns kept when present, in this order
# (then pass-through columns).
KNOWN_COLUMNS = ("text", "prediction", "probability", "rawPrediction", "ingest_time", "label")


ROW_BYTES = 200   # of a written row beside its text: scores, time, label


class NoModelError(RuntimeError):
    """No model could be loaded; the batch must not be committed."""


@dataclass
class ServingConfig:
    output_path: str
    checkpoint: str
    source_type: str = "file"                 # "file" | "kafka"
    input_path: str | None = None
    file_format: str = "csv"
    schema: object = None                     # StructType, JSON or DDL; default text STRING
    header: bool = False
    multi_line: bool = False
    max_files_per_trigger: int = 1
    kafka_bootstrap: str | None = None
    kafka_topic: str | None = None
    starting_offsets: str = "latest"
    max_offsets_per_trigger: int | None = None
    kafka_label: bool = False
    model_name: str | None = None
    model_stage: str | None = None            # None = newest version of any stage
    model_flavor: str = "spark"               # "spark" | "python"
    registry_root: str | None = None
    reload_interval_seconds: float = 300.0
    trigger_seconds: float = 30.0
    available_now: bool = False
    passthrough: tuple = ()
    write_json: bool = False
    json_output_path: str | None = None
    write_kafka: bool = False
    kafka_output_bootstrap: str | None = None
    kafka_output_topic: str | None = None
    metrics_path: str | None = None
    sketch_path: str | None = None            # score sketches of labelled batches, for a running AUC
    pin_versions: bool = True                 # a replayed batch keeps the version of its first attempt
    pins_path: str | None = None              # None: _batch_versions beside the output's dates
    write_manifest: bool = True               # record the files of each batch (manifest.py)
    on_error: str = "raise"                   # optional sinks: "raise" | "warn"
    score_partitions: int | None = None       # spread a batch before scoring (None: source's partitions)
    rows_per_file: int = 1_000_000            # a batch's output files: as many as rows_per_file
    bytes_per_file: int = 128 << 20           # or bytes_per_file asks for, whichever is more
    model_input_cols: tuple | None = None     # Python flavor: columns the model sees (None: all)
    arrow_batch_bytes: int | None = 1 << 20   # Python flavor: bytes of rows sent to a worker at once (None: the session's)
    query_id: str | None = None               # only for batches scored outside a streaming query
    query_name: str | None = None

    def validate(self) -> "ServingConfig":
        """Source-specific required settings, checked before anything starts."""
        problems = []
        if self.source_type == "file":
            if not self.input_path:
                problems.append("file source needs input_path")
            if self.file_format not in FILE_FORMATS:
                problems.append(f"file_format must be one of {FILE_FORMATS}")
        elif self.source_type == "kafka":
            if not self.kafka_bootstrap or not self.kafka_topic:
                problems.append("kafka source needs kafka_bootstrap and kafka_topic")
        else:
            problems.append(f"unknown source_type {self.source_type!r}")
        if not self.output_path:
            problems.append("output_path is required")
        if not self.checkpoint:
            problems.append("checkpoint is required")
        if parse_flag(self.write_json):
            if not self.json_output_path:
                problems.append("write_json needs json_output_path (a folder beside output_path)")
            else:
                try:
                    sinks._check_sibling(self.output_path, self.json_output_path)
                except ValueError as exc:
                    problems.append(str(exc))
        if parse_flag(self.write_kafka) and not (self.kafka_output_bootstrap and self.kafka_output_topic):
            problems.append("write_kafka needs kafka_output_bootstrap and kafka_output_topic")
        if self.model_flavor not in ("spark", "python"):
            problems.append("model_flavor must be 'spark' or 'python'")
        if self.on_error not in ("raise", "warn"):
            problems.append("on_error must be 'raise' or 'warn'")
        if problems:
            raise ValueError("; ".join(problems))
        return self


def build_stream(spark: SparkSession, cfg: ServingConfig) -> DataFrame:
    """The source as a streaming DataFrame with ``ingest_time`` added in the
    streaming plan (the micro-batch timestamp: stable across a replay)."""
    if cfg.source_type == "file":
        df = file_stream(spark, cfg.input_path, cfg.schema, cfg.file_format, cfg.header,
                         cfg.max_files_per_trigger, cfg.multi_line)
    else:
        df = kafka_stream(spark, cfg.kafka_bootstrap, cfg.kafka_topic, cfg.starting_offsets,
                          cfg.max_offsets_per_trigger, cfg.kafka_label)
    return df.withColumn("ingest_time", F.current_timestamp())


def registry_resolver(spark: SparkSession, cfg: ServingConfig) -> Callable[[], tuple]:
    """``() -> (version, uri)`` of the newest registered version (stage filter optional)."""
    registry = Registry(spark, cfg.registry_root)
    return lambda: registry.latest(cfg.model_name, cfg.model_stage)


def utc_date(ts_col: str = "ingest_time"):
    """``yyyy-MM-dd`` of a timestamp in UTC, whatever the session time zone."""
    return F.date_format(F.to_utc_timestamp(F.col(ts_col), F.current_timezone()), "yyyy-MM-dd")


def shape_predictions(scored: DataFrame, passthrough=(), model_version: str | None = None) -> DataFrame:
    """Known columns present (fixed order), pass-through columns, model version, date."""
    keep = [c for c in KNOWN_COLUMNS if c in scored.columns]
    keep += [c for c in passthrough if c in scored.columns and c not in keep]
    out = scored.select(*keep).withColumn("model_version", F.lit(model_version).cast("string"))
    if "ingest_time" in out.columns:
        return out.withColumn("date", utc_date("ingest_time"))
    return out.withColumn("date", F.date_format(F.current_date(), "yyyy-MM-dd"))


def _query_id(spark: SparkSession, given: str | None) -> str:
    """The streaming query id (stable for a checkpoint) inside a batch callback,
    else the configured one. Output is replaced by ``(date, query_id, batch_id)``,
    so without an id of its own a query would overwrite others': that raises."""
    found = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or given
    if not found:
        raise ValueError("no streaming query id: set ServingConfig.query_id to score batches outside a stream")
    return found


def score_rows_with_text(scorer, batch: DataFrame) -> DataFrame:
    """``scorer`` over the rows with a text; the others get a null in every column
    that it adds. One pass: a null text is scored as an empty one and what comes of
    it left out, so the batch isn't read once for each kind of row."""
    none = INTERNAL + "no_text"
    marked = batch.withColumn(none, F.col("text").isNull()).withColumn("text", F.coalesce("text", F.lit("")))
    scored = scorer.score(marked)
    given = {c for c in batch.columns if c != "text"}
    return scored.select(*[F.col(f"`{c}`") if c in given else F.when(~F.col(none), F.col(f"`{c}`")).alias(c)
                           for c in scored.columns if c != none])


ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def arrow_batches(spark: SparkSession, most: int | None):
    """Within the block rows go to Python workers in Arrow batches of about ``most`` bytes
    (None: as the session says). A worker's memory follows the batch, by default 10,000
    rows or 64 MB, of which it holds several copies."""
    before = spark.conf.get(ARROW_BYTES)
    if most:
        spark.conf.set(ARROW_BYTES, str(most))
    try:
        yield
    finally:
        spark.conf.set(ARROW_BYTES, before)


@dataclass
class BatchScorer:
    """The ``foreachBatch`` callback."""

    cfg: ServingConfig
    resolver: Callable[[], tuple] | None = None     # () -> (version, uri)
    loader: Callable[[str], object] | None = None   # uri -> scorer
    holder: ModelHolder = field(default_factory=ModelHolder)
    history: list = field(default_factory=list)     # rows of the last batches; metrics_path keeps them all
    keep_history: int = 1000
    batches: int = 0                                # batches scored, also those that history has dropped

    # model ---------------------------------------------------------------
    def current_model(self):
        model, version, uri = self.holder.get()
        if self.resolver is not None and self.holder.due(self.cfg.reload_interval_seconds):
            try:
                new_version, new_uri = self.resolver()
                self.holder.mark_checked()
                if new_version is not None and (model is None or str(new_version) != str(version)):
                    log.info("loading model version %s from %s", new_version, new_uri)
                    self.holder.set(self.loader(new_uri), str(new_version), new_uri)
            except Exception:  # noqa: BLE001 -- keep serving the cached model
                if model is None:
                    raise
                log.exception("model reload failed; keeping version %s", version)
        model, version, uri = self.holder.get()
        if model is None:
            raise NoModelError("no model available; batch not committed")
        return model, version

    def pins(self, spark: SparkSession) -> BatchVersions | None:
        if not self.cfg.pin_versions:
            return None
        return BatchVersions(spark, self.cfg.pins_path or f"{self.cfg.output_path.rstrip('/')}/_batch_versions")

    def model_for(self, spark: SparkSession, query_id: str, batch_id: int):
        """The model of a batch: the version that an earlier attempt was pinned to, else
        the current one, which is pinned now.

        A pinned version that can't be loaded raises: to score the batch by another one
        would mix versions. Only a fixed scorer, which has no place to be loaded from,
        scores a replay whatever its version; that is pinned anew."""
        pins = self.pins(spark)
        found = pins.pinned(query_id, batch_id) if pins else None
        if found is not None:
            version, uri = found
            held = self.holder.get()
            if held[0] is not None and str(held[1]) == str(version):
                return held[0], version
            if uri is not None and self.loader is not None:
                log.info("batch %s is a replay: model version %s from %s", batch_id, version, uri)
                self.holder.set(self.loader(uri), version, uri, polled_at=0.0)   # the next batch polls
                return self.holder.get()[0], version
            log.warning("batch %s was scored by version %s, which has no place to load it from", batch_id, version)
        model, version = self.current_model()
        if pins:
            pins.pin(query_id, batch_id, version, self.holder.get()[2])
        return model, version

    # sinks -----------------------------------------------------------------
    def _optional(self, name: str, fn) -> None:
        try:
            fn()
        except Exception:  # noqa: BLE001
            if self.cfg.on_error == "raise":
                raise
            log.exception("optional sink %s failed; continuing", name)

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        started = time.time()
        spark = batch_df.sparkSession
        query_id = _query_id(spark, self.cfg.query_id)
        try:
            scorer, version = self.model_for(spark, query_id, batch_id)
        except Exception:
            if batch_df.isEmpty():   # nothing to score: no model needed
                return
            raise
        batch = ensure_text_column(batch_df)
        if self.cfg.score_partitions:
            batch = spread(batch, self.cfg.score_partitions)
        arrived, made = Observation(), Observation()
        batch = batch.observe(arrived, F.count(F.lit(1)).alias("batch_rows"),
                              F.count_if(F.col("text").isNull()).alias("null_text_rows"))
        shaped = shape_predictions(score_rows_with_text(scorer, batch), self.cfg.passthrough, version)
        shaped = shaped.withColumn("query_id", F.lit(query_id)).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        size = F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES)
        with arrow_batches(spark, self.cfg.arrow_batch_bytes):
            shaped = shaped.observe(made, F.count(F.lit(1)).alias("written_rows"), size.alias("n_bytes"),
                                    F.collect_set("date").alias("dates")).persist()
            try:
                shaped.write.format("noop").mode("overwrite").save()   # the one pass over the source
                seen = {**arrived.get, **made.get}
                if seen["batch_rows"]:
                    self._write(spark, shaped, seen, query_id, batch_id, version, started)
            finally:
                shaped.unpersist()

    def _write(self, spark: SparkSession, shaped: DataFrame, seen: dict, query_id: str, batch_id: int,
               version: str, started: float) -> None:
        cfg = self.cfg
        # as few files as rows and bytes need (no small-file explosion per batch)
        files = max(-(-seen["written_rows"] // max(1, cfg.rows_per_file)), -(-int(seen["n_bytes"] or 0) // max(1, cfg.bytes_per_file)))
        out = shaped.coalesce(max(1, files))
        sinks.write_predictions(out, cfg.output_path)
        if parse_flag(cfg.write_json):
            self._optional("json", lambda: sinks.write_json_lines(out, cfg.json_output_path, cfg.output_path))
        if parse_flag(cfg.write_kafka):
            self._optional("kafka", lambda: sinks.write_kafka(
                out.drop(*sinks.PARTITION_COLS), cfg.kafka_output_bootstrap, cfg.kafka_output_topic))
        if cfg.write_manifest:
            self._optional("manifest", lambda: manifest.record(spark, cfg.output_path, seen["dates"], query_id, batch_id))
        batch_auc = None
        if "label" in shaped.columns and "rawPrediction" in shaped.columns:
            scored = shaped.where("prediction IS NOT NULL")
            batch_auc = auc_ops.area_values_from_raw(scored, "label")["roc_auc"]
            if cfg.sketch_path:
                self._optional("sketch", lambda: score_sketch.write_batch(scored, cfg.sketch_path, query_id, batch_id))
        row = {
            "query_id": query_id, "batch_id": int(batch_id), "model_version": version,
            **{k: int(seen[k]) for k in ("batch_rows", "written_rows", "null_text_rows")},
            "batch_auc": batch_auc, "elapsed_seconds": time.time() - started,
        }
        if cfg.metrics_path:
            self._optional("metrics", lambda: sinks.write_batch_metrics(spark, cfg.metrics_path, row))
        self.batches += 1
        self.history.append(row)
        del self.history[:-self.keep_history]
        log.info("batch %s: %s rows in %.2fs (model %s)", batch_id, row["written_rows"], row["elapsed_seconds"], version)


def start_serving(
    spark: SparkSession,
    cfg: ServingConfig,
    scorer=None,
    scorer_version: str = "static",
    resolver=None,
    loader=None,
) -> tuple[StreamingQuery, BatchScorer]:
    """Start the stream. Either pass a fixed ``scorer`` or let versions come
    from the registry (``registry_root`` + ``model_name``)."""
    cfg.validate()
    handler = BatchScorer(cfg)
    if scorer is not None:
        handler.holder.set(scorer, scorer_version, None)
    else:
        handler.resolver = resolver or registry_resolver(spark, cfg)
        handler.loader = loader or (lambda uri: load_scorer(spark, uri, cfg.model_flavor, cfg.model_input_cols))
    writer = (
        build_stream(spark, cfg).writeStream.foreachBatch(handler)
        .outputMode("append").option("checkpointLocation", cfg.checkpoint)
    )
    if cfg.query_name:
        writer = writer.queryName(cfg.query_name)
    if cfg.available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{cfg.trigger_seconds} seconds")
    return writer.start(), handler


def read_batch_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BATCH_METRICS).parquet(path)
