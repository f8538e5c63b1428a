"""Sinks of scored micro-batches.

Predictions and their JSON copy are written with *dynamic partition
overwrite* on ``(date, query_id, batch_id)``: a batch that is replayed after a
failure replaces its own partitions instead of appending duplicates, and a
new query (fresh checkpoint, batch ids from 0 again) never touches another
query's output. Kafka stays at-least-once.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textflow.functions.payload import jsonable, pack_json
from textflow.schemas import BATCH_METRICS
from textflow.streaming import manifest

PARTITION_COLS = ("date", "query_id", "batch_id")


def _check_sibling(root: str, other: str) -> None:
    a, b = root.rstrip("/") + "/", other.rstrip("/") + "/"
    if b.startswith(a) or a.startswith(b):
        raise ValueError(f"JSON output {other} must not be inside (or contain) the Parquet table {root}")


def write_predictions(df: DataFrame, path: str, compression: str = "snappy") -> None:
    """Parquet table partitioned by ``date, query_id, batch_id``."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .partitionBy(*PARTITION_COLS)
        .parquet(path)
    )


def write_json_lines(df: DataFrame, path: str, table_root: str | None = None) -> None:
    """One JSON object per line, same partitions as the Parquet table, in a
    folder beside it (a nested folder would break reading the table)."""
    if table_root:
        _check_sibling(table_root, path)
    body = df.drop(*PARTITION_COLS)
    value = F.to_json(F.struct(*jsonable(body)))
    (
        df.select(value.alias("value"), *PARTITION_COLS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITION_COLS)
        .text(path)
    )


def kafka_sink_options(bootstrap: str, topic: str) -> dict:
    return {"kafka.bootstrap.servers": bootstrap, "topic": topic}


def kafka_payload(df: DataFrame) -> DataFrame:
    """Rows as the Kafka ``value`` column (JSON text)."""
    return pack_json(df)


def write_kafka(df: DataFrame, bootstrap: str, topic: str) -> None:
    kafka_payload(df).write.format("kafka").options(**kafka_sink_options(bootstrap, topic)).save()


def write_batch_metrics(spark, path: str, row: dict) -> None:
    """One row per batch, partitioned by ``query_id, batch_id`` (replays overwrite)."""
    values = tuple(row.get(f.name) for f in BATCH_METRICS.fields)
    frame = spark.createDataFrame([values], BATCH_METRICS).coalesce(1)
    (
        frame.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("query_id", "batch_id")
        .parquet(path)
    )


def compact_date(spark, path: str, date: str, rows_per_file: int = 1_000_000) -> int:
    """Rewrite one *closed* date of the prediction table into few files.

    Every micro-batch keeps its own ``(query_id, batch_id)`` folder so that a
    replay overwrites only itself; once no stream writes the date any more,
    those folders are merged into ``query_id=compacted/batch_id=0`` with
    ``ceil(rows / rows_per_file)`` files. The rows are first staged in the
    table's own ``_compacting`` folder (a path cannot be read and overwritten in
    one job; readers skip names with an underscore), then a static ``INSERT
    OVERWRITE ... PARTITION (date=...)`` through a temporary external table makes
    Spark replace exactly that date's folders, and the stage is deleted last.

    The overwrite deletes the old files before the new ones are committed. If the
    job dies in between, the finished stage (its ``_SUCCESS`` file) is still
    there: the next call starts from it instead of from the damaged date.
    Returns the number of rows compacted.
    """
    from textflow.sources.predictions import read_predictions

    stage = f"{path.rstrip('/')}/_compacting/date={date}"
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(stage)
    files = folder.getFileSystem(conf)
    if not files.exists(jvm.org.apache.hadoop.fs.Path(stage, "_SUCCESS")):
        current = read_predictions(spark, path, date=date)
        n = current.count()
        if n == 0:
            return 0
        (current.drop(*PARTITION_COLS).coalesce(max(1, -(-n // max(1, rows_per_file))))
         .write.mode("overwrite").parquet(stage))
    staged = spark.read.parquet(stage).drop(*PARTITION_COLS)
    data_cols, n = staged.columns, staged.count()
    tag = uuid.uuid4().hex[:12]
    table, view = f"textflow_compact_{tag}", f"textflow_compact_rows_{tag}"
    staged.createOrReplaceTempView(view)
    # schema (ML vector columns included) and partitions come from the files
    spark.sql(
        f"CREATE TABLE {table} USING parquet OPTIONS (partitionOverwriteMode 'static') "
        f"LOCATION '{path}'"
    )
    try:
        select = ", ".join(f"`{c}`" for c in data_cols)
        spark.sql(
            f"INSERT OVERWRITE TABLE {table} PARTITION (`date` = '{date}', `query_id`, `batch_id`) "
            f"SELECT {select}, 'compacted' AS query_id, CAST(0 AS BIGINT) AS batch_id FROM {view}"
        )
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.catalog.dropTempView(view)
    manifest.compacted(spark, path, date)   # before the stage goes: a call after a crash does both again
    files.delete(folder, True)
    return n
