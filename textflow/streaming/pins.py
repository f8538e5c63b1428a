"""Write-ahead record of the model version that scores a batch.

A version is written down before its batch is scored. When the batch is replayed
(the query failed or was stopped after scoring, before its commit), the record
names the version again, whatever the registry holds by then: everything that a
batch has written, and the copies sent elsewhere, come from one version.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from textflow.schemas import BATCH_VERSIONS


class BatchVersions:
    """One small file for each batch, in a folder of its own under ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folder(self, query_id: str, batch_id: int) -> str:
        # any query id makes a valid folder name; the record itself holds it
        return f"{self.path}/{hashlib.md5(query_id.encode()).hexdigest()}/{batch_id}"

    def _read(self, path: str) -> DataFrame | None:
        try:
            return self.spark.read.schema(BATCH_VERSIONS).option("recursiveFileLookup", "true").parquet(path)
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _merged(self, query_id: str) -> str:
        return f"{self.path}/merged/{hashlib.md5(query_id.encode()).hexdigest()}"

    def pinned(self, query_id: str, batch_id: int) -> tuple[str, str | None] | None:
        """``(version, uri)`` that an earlier attempt of the batch was scored by. A
        record that was cut off while it was written counts as none: its batch had
        not been scored yet."""
        found = self._read(self._folder(query_id, batch_id))
        if found is None and (found := self._read(self._merged(query_id))) is not None:
            found = found.where((F.col("batch_id") == batch_id) & (F.col("query_id") == query_id)).orderBy(F.desc("pinned_at"))
        row = found.first() if found is not None else None
        return None if row is None else (row["model_version"], row["uri"])

    def pin(self, query_id: str, batch_id: int, version: str, uri: str | None) -> None:
        row = self.spark.createDataFrame([(query_id, batch_id, version, uri, None)], BATCH_VERSIONS).coalesce(1)
        row.withColumn("pinned_at", F.current_timestamp()).write.mode("overwrite").parquet(self._folder(query_id, batch_id))

    def table(self) -> DataFrame:
        """All records, the newest of each batch: ``query_id, batch_id, model_version, uri,
        pinned_at``."""
        found = self._read(self.path)
        if found is None:
            return self.spark.createDataFrame([], BATCH_VERSIONS)
        newest = F.max_by(F.struct("model_version", "uri", "pinned_at"), "pinned_at").alias("r")
        return found.groupBy("query_id", "batch_id").agg(newest).select("query_id", "batch_id", "r.*")

    def merge(self, query_id: str, before: int) -> int:
        """Put the records of a query's batches below ``before`` (all of them committed) into
        one file; the number of folders that go. A call that dies after the write leaves
        records twice, which ``table`` counts once, and the next call removes the rest."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        root = jvm.org.apache.hadoop.fs.Path(self._folder(query_id, 0)).getParent()
        store = root.getFileSystem(conf)
        if not store.exists(root):
            return 0
        done = [s.getPath() for s in store.listStatus(root) if int(s.getPath().getName()) < before]
        if done:
            self._read_all([p.toString() for p in done]).coalesce(1).write.mode("append").parquet(self._merged(query_id))
        for folder in done:
            store.delete(folder, True)
        return len(done)

    def _read_all(self, folders: list[str]) -> DataFrame:
        return self.spark.read.schema(BATCH_VERSIONS).parquet(*folders)
