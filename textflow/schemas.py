"""Fixed schemas of every table the toolkit reads or writes."""

from __future__ import annotations

import json

from pyspark.sql import types as T

# Headerless six-column labelled corpus (polarity, id, date, query, user, text).
RAW_CORPUS = T.StructType(
    [
        T.StructField("polarity", T.StringType(), True),
        T.StructField("id", T.LongType(), True),
        T.StructField("date", T.StringType(), True),
        T.StructField("query", T.StringType(), True),
        T.StructField("user", T.StringType(), True),
        T.StructField("text", T.StringType(), True),
    ]
)

STREAM_TEXT = T.StructType([T.StructField("text", T.StringType(), True)])

KAFKA_PAYLOAD = T.StructType([T.StructField("text", T.StringType(), True)])

MODEL_VERSIONS = T.StructType(
    [
        T.StructField("name", T.StringType(), False),
        T.StructField("version", T.StringType(), False),
        T.StructField("stage", T.StringType(), True),
        T.StructField("uri", T.StringType(), True),
        T.StructField("run_id", T.StringType(), True),
        T.StructField("created_at", T.TimestampType(), True),
    ]
)

# Moves of versions from stage to stage; a version's newest move (by time, then id) says where it is.
STAGE_LOG = T.StructType(
    [
        T.StructField("name", T.StringType(), False),
        T.StructField("version", T.StringType(), False),
        T.StructField("from_stage", T.StringType(), True),
        T.StructField("to_stage", T.StringType(), True),
        T.StructField("moved_at", T.TimestampType(), False),
        T.StructField("move_id", T.StringType(), False),
    ]
)

RUNS = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("parent_run_id", T.StringType(), True),
        T.StructField("experiment", T.StringType(), True),
        T.StructField("run_name", T.StringType(), True),
        T.StructField("position", T.IntegerType(), True),
        T.StructField("started_at", T.TimestampType(), True),
    ]
)

RUN_PARAMS = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("value", T.StringType(), True),
    ]
)

RUN_METRICS = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("value", T.DoubleType(), True),
    ]
)

BATCH_METRICS = T.StructType(
    [
        T.StructField("query_id", T.StringType(), False),
        T.StructField("batch_id", T.LongType(), False),
        T.StructField("model_version", T.StringType(), True),
        T.StructField("batch_rows", T.LongType(), True),
        T.StructField("written_rows", T.LongType(), True),
        T.StructField("null_text_rows", T.LongType(), True),
        T.StructField("batch_auc", T.DoubleType(), True),
        T.StructField("elapsed_seconds", T.DoubleType(), True),
    ]
)

# Which model version a batch is scored by, written before it is scored.
BATCH_VERSIONS = T.StructType(
    [
        T.StructField("query_id", T.StringType(), False),
        T.StructField("batch_id", T.LongType(), False),
        T.StructField("model_version", T.StringType(), True),
        T.StructField("uri", T.StringType(), True),
        T.StructField("pinned_at", T.TimestampType(), True),
    ]
)

# Files of the prediction table; ``committed_at`` is when their batch (or compaction) was recorded.
OUTPUT_FILES = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("n_rows", T.LongType(), True),
        T.StructField("n_bytes", T.LongType(), True),
        T.StructField("modified", T.TimestampType(), True),
        T.StructField("committed_at", T.TimestampType(), True),
        T.StructField("date", T.StringType(), True),
        T.StructField("query_id", T.StringType(), True),
        T.StructField("batch_id", T.LongType(), True),
    ]
)

# Events of streaming queries: kind is started, progress or terminated.
STREAM_EVENTS = T.StructType(
    [
        T.StructField("kind", T.StringType(), False),
        T.StructField("id", T.StringType(), False),
        T.StructField("run_id", T.StringType(), False),
        T.StructField("name", T.StringType(), True),
        T.StructField("batch_id", T.LongType(), True),
        T.StructField("num_input_rows", T.LongType(), True),
        T.StructField("input_rows_per_second", T.DoubleType(), True),
        T.StructField("processed_rows_per_second", T.DoubleType(), True),
        T.StructField("trigger_ms", T.LongType(), True),
        T.StructField("timestamp", T.StringType(), True),
        T.StructField("error", T.StringType(), True),
        T.StructField("logged_at", T.TimestampType(), False),
    ]
)


def parse_schema(spec: str | dict | T.StructType) -> T.StructType:
    """Accept a StructType, a JSON schema (string or dict) or a DDL string."""
    if isinstance(spec, T.StructType):
        return spec
    if isinstance(spec, dict):
        return T.StructType.fromJson(spec)
    text = spec.strip()
    if text.startswith("{"):
        return T.StructType.fromJson(json.loads(text))
    return T.StructType.fromDDL(text)


def load_schema_file(path: str) -> T.StructType:
    """Read a schema file holding JSON or DDL."""
    with open(path, encoding="utf-8") as handle:
        return parse_schema(handle.read())
