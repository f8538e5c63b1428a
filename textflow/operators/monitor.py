"""Monitoring of the serving output and of running streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textflow.sources.predictions import read_predictions
from textflow.streaming import manifest
from textflow.streaming.progress import progress_table

#: Date folders whose files the driver holds at a time.
FOLDERS_LISTED = 200


def predictions_by_date(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """True prediction row counts per date partition: from the manifest of a table
    that has one, else counted."""
    if manifest.exists(spark, path):
        return manifest.rows_by_date(spark, path, since)
    return read_predictions(spark, path, since=since).groupBy("date").agg(F.count(F.lit(1)).alias("n_rows"))


def output_files(spark: SparkSession, path: str | list[str], pattern: str = "part-*") -> DataFrame:
    """Files under ``path`` (recursively) as ``path, modified, size`` rows.

    A ``binaryFile`` scan that never selects ``content`` lists files without
    reading them; the driver holds the listing, so give it the folders of
    interest, not a whole table."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(path)
        .select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"))
    )


def date_folders(spark: SparkSession, path: str) -> list[str]:
    """The ``date=...`` folders of a prediction table, newest first (one listing of
    the table's top level)."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    found = [s.getPath().toString() for s in root.getFileSystem(conf).listStatus(root)]
    return sorted((f for f in found if f.rsplit("/", 1)[-1].startswith("date=")), reverse=True)


def recent_files(spark: SparkSession, path: str, n: int = 5, within_hours: float | None = None,
                 since: str | None = None) -> DataFrame:
    """The ``n`` output files with the newest modification time, optionally only
    those of the last hours, or of dates from ``since`` on.

    A query over the manifest of a table that has one. Of others the folders are
    listed: any date may have been written last (compaction, late or replayed
    batches), so all of them unless ``since`` says otherwise, newest first, in groups
    of ``FOLDERS_LISTED``, of which only the ``n`` newest files are kept."""
    if manifest.exists(spark, path):
        return manifest.newest(spark, path, n, within_hours, since)
    folders = date_folders(spark, path)
    if folders and since is not None:
        folders = [f for f in folders if f.rsplit("/date=", 1)[-1] >= since]
    elif not folders:
        folders = [path]   # a folder without dates: as it is
    oldest = None
    if within_hours is not None:
        cutoff = F.current_timestamp() - F.make_interval(secs=F.lit(float(within_hours * 3600)))
        oldest = spark.range(1).select(F.unix_micros(cutoff)).first()[0]
    newest: list = []
    for k in range(0, len(folders), FOLDERS_LISTED):
        files = output_files(spark, folders[k:k + FOLDERS_LISTED])
        files = files.select("path", F.unix_micros("modified").alias("modified"), "size")
        if oldest is not None:
            files = files.where(F.col("modified") >= oldest)
        found = files.orderBy(F.desc("modified"), F.desc("path")).limit(n).collect()
        newest = sorted([*newest, *map(tuple, found)], key=lambda f: (f[1], f[0]), reverse=True)[:n]
    rows = spark.createDataFrame(newest, "path string, modified long, size long")
    return rows.select("path", F.timestamp_micros("modified").alias("modified"), "size").orderBy(
        F.desc("modified"), F.desc("path"))


def active_streams(spark: SparkSession) -> DataFrame:
    """Running queries of this session with their latest progress."""
    rows = []
    for q in spark.streams.active:
        p = q.lastProgress or {}
        rows.append((
            str(q.id), str(q.runId), q.name, bool(q.isActive),
            p.get("batchId"), p.get("numInputRows"), p.get("processedRowsPerSecond"),
            q.status.get("message") if q.status else None,
        ))
    schema = ("id string, run_id string, name string, is_active boolean, batch_id long, "
              "num_input_rows long, rows_per_second double, status string")
    return spark.createDataFrame(rows, schema)


def stream_runs(spark: SparkSession, log_path: str, stale_seconds: float = 300.0, since: str | None = None) -> DataFrame:
    """Every run of every streaming query that logs to ``log_path``, of this and other
    sessions, past and present: its batches and rows so far, its latest progress and
    its state.

    ``failed`` and ``stopped`` runs have said so. A run that has not is ``running``
    while it has logged within ``stale_seconds``, else ``lost``: its driver died, or
    it is idle (an idle query logs too, at Spark's idle interval)."""
    told = progress_table(spark, log_path, since)
    batch = F.col("kind") == "progress"
    runs = told.groupBy("id", "run_id").agg(
        F.max("name").alias("name"), F.min("logged_at").alias("first_seen"), F.max("logged_at").alias("last_seen"),
        F.count_if(batch & (F.col("num_input_rows") > 0)).alias("n_batches"),
        F.coalesce(F.sum(F.when(batch, F.col("num_input_rows"))), F.lit(0)).alias("n_rows"),
        F.max_by(F.struct("batch_id", "processed_rows_per_second"), F.when(batch, F.struct("batch_id", "logged_at"))).alias("last"),
        F.bool_or(F.col("kind") == "terminated").alias("ended"), F.max("error").alias("error"))
    quiet = F.col("last_seen") < F.current_timestamp() - F.make_interval(secs=F.lit(float(stale_seconds)))
    state = (F.when(F.col("error").isNotNull(), "failed").when(F.col("ended"), "stopped").when(quiet, "lost").otherwise("running"))
    return runs.select("id", "run_id", "name", state.alias("state"), "n_batches", "n_rows", F.col("last.batch_id").alias("last_batch"),
                       F.col("last.processed_rows_per_second").alias("rows_per_second"), "first_seen", "last_seen", "error")
