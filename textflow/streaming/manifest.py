"""Manifest of the prediction table: which files each batch has written.

A record for each file (path, rows, bytes, modification time) is written after its
batch's output, into ``_manifest`` of the table, by the same partitions: a replayed
batch replaces its records as it replaces its files. The newest files and the rows
of each date are then queries over the records, in place of a listing of all
folders on the driver. Only the folders of the batch at hand are listed.

Compaction of a date writes one set of records for the date, which stands for all
that were committed before it; the others are deleted after that, so a call that
dies in between leaves nothing wrong.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from textflow.schemas import OUTPUT_FILES

COMPACTED = "compacted"   # query_id of compacted files
_KEYS = ("date", "query_id", "batch_id")
# Characters that Spark escapes in the names of partition folders.
_ESCAPED = re.compile("[\x01-\x1f\"#%'*/:=?\\\\\x7f{\\[\\]^]")


def location(path: str) -> str:
    return f"{path.rstrip('/')}/_manifest"


def _folder(date: str, query_id: str, batch_id: int) -> str:
    values = (_ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", str(v)) for v in (date, query_id, batch_id))
    return "/".join(f"{k}={v}" for k, v in zip(_KEYS, values))


def _files(found: DataFrame) -> DataFrame:
    """Files of a frame of the table, with their rows: the columns are not read."""
    meta = F.col("_metadata")
    named = found.select(meta["file_path"].alias("path"), meta["file_size"].alias("n_bytes"),
                         meta["file_modification_time"].alias("modified"), *_KEYS)
    counted = named.groupBy("path", "n_bytes", "modified", *_KEYS).agg(F.count(F.lit(1)).alias("n_rows"))
    counted = counted.withColumn("committed_at", F.current_timestamp())
    return counted.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in OUTPUT_FILES.fields])


def _table(spark: SparkSession, path: str, folders: list[str]) -> DataFrame:
    """Folders of the table, with its partition columns as text."""
    parts = ", ".join(f"{k} STRING" for k in _KEYS)
    return spark.read.schema(parts).option("basePath", path).parquet(*folders)


def _write(files: DataFrame, path: str) -> None:
    (files.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*_KEYS).parquet(location(path)))


def record(spark: SparkSession, path: str, dates: list[str], query_id: str, batch_id: int) -> None:
    """Record the files that a batch has written under ``dates``."""
    if dates:
        _write(_files(_table(spark, path, [f"{path.rstrip('/')}/{_folder(d, query_id, batch_id)}" for d in sorted(dates)])), path)


def rebuild(spark: SparkSession, path: str) -> None:
    """Records for all files of a table, in place of those it has: to begin with, or
    after its files were changed by other means. Spark lists the folders."""
    merged_at = F.when(F.col("query_id") == COMPACTED, F.col("modified")).otherwise(F.col("committed_at"))
    files = _files(_table(spark, path, [path])).withColumn("committed_at", merged_at).persist()   # all of them are live
    try:
        files.count()   # before the old records go
        files.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*_KEYS).parquet(location(path))
    finally:
        files.unpersist()


def exists(spark: SparkSession, path: str) -> bool:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(location(path))
    return folder.getFileSystem(conf).exists(folder)


def files(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """The records of the files that make up the table now, optionally of dates from
    ``since`` on (other dates' records aren't read): those of a compacted date's last
    compaction, and those committed after it."""
    try:
        found = spark.read.schema(OUTPUT_FILES).option("basePath", location(path)).parquet(location(path))
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], OUTPUT_FILES)
    if since is not None:
        found = found.where(F.col("date") >= F.lit(since))
    merged = found.where(F.col("query_id") == COMPACTED).groupBy(F.col("date").alias("of")).agg(F.max("committed_at").alias("merged_at"))
    live = found.join(merged, F.col("date") == F.col("of"), "left")
    newer = F.when(F.col("query_id") == COMPACTED, F.col("committed_at") >= F.col("merged_at")).otherwise(
        F.col("merged_at").isNull() | (F.col("committed_at") > F.col("merged_at")))
    return live.where(newer).select(*[f.name for f in OUTPUT_FILES.fields])


def newest(spark: SparkSession, path: str, n: int = 5, within_hours: float | None = None, since: str | None = None) -> DataFrame:
    """``(path, modified, size)`` of the ``n`` files with the newest modification time."""
    found = files(spark, path, since)
    if within_hours is not None:
        found = found.where(F.col("modified") >= F.current_timestamp() - F.make_interval(secs=F.lit(float(within_hours * 3600))))
    return found.select("path", "modified", F.col("n_bytes").alias("size")).orderBy(F.desc("modified"), F.desc("path")).limit(n)


def rows_by_date(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    return files(spark, path, since).groupBy("date").agg(F.sum("n_rows").alias("n_rows"))


def compacted(spark: SparkSession, path: str, date: str) -> None:
    """Replace a date's records by those of its compacted files, if the table has a manifest."""
    if not exists(spark, path):
        return
    record(spark, path, [date], COMPACTED, 0)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(f"{location(path)}/date={_ESCAPED.sub(lambda m: f'%{ord(m[0]):02X}', date)}")
    store = folder.getFileSystem(conf)
    for other in store.listStatus(folder):   # a folder for each query that wrote the date
        if other.getPath().getName() != f"query_id={COMPACTED}":
            store.delete(other.getPath(), True)
