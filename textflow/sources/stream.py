"""Streaming sources: a watched folder of files, or a Kafka topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from textflow.functions.payload import decode_kafka_frame
from textflow.schemas import STREAM_TEXT, parse_schema

FILE_FORMATS = ("csv", "json", "text", "parquet")


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    fmt: str = "csv",
    header: bool = False,
    max_files_per_trigger: int = 1,
    multi_line: bool = False,
    escape: str = '"',
) -> DataFrame:
    """New files under ``path`` as a stream, with a fixed schema (default
    ``text STRING``) and at most ``max_files_per_trigger`` files per batch."""
    if fmt not in FILE_FORMATS:
        raise ValueError(f"file format must be one of {FILE_FORMATS}, got {fmt!r}")
    reader = spark.readStream.format(fmt).option("maxFilesPerTrigger", str(max_files_per_trigger))
    if fmt == "text":
        return reader.load(path).withColumnRenamed("value", "text")
    reader = reader.schema(parse_schema(schema) if schema is not None else STREAM_TEXT)
    if fmt == "csv":
        reader = (reader.option("header", str(header).lower()).option("escape", escape)
                  .option("quote", '"').option("multiLine", str(multi_line).lower()))
    elif fmt == "json":
        reader = reader.option("multiLine", str(multi_line).lower())
    return reader.load(path)


def kafka_source_options(
    bootstrap: str, topic: str, starting_offsets: str = "latest", max_offsets_per_trigger: int | None = None
) -> dict:
    opts = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "true",
    }
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def kafka_stream(
    spark: SparkSession,
    bootstrap: str,
    topic: str,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
    keep_label: bool = False,
) -> DataFrame:
    """Kafka topic to ``text, kafka_ts`` (``label`` too when asked). Needs the
    spark-sql-kafka package on the classpath."""
    raw = spark.readStream.format("kafka").options(
        **kafka_source_options(bootstrap, topic, starting_offsets, max_offsets_per_trigger)
    ).load()
    return decode_kafka_frame(raw, keep_label=keep_label)
