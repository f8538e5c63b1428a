"""Batch timing and throughput of streaming queries, kept in a table.

A listener writes the events of a session's queries (started, progress of each
batch, terminated) to an append table in a shared folder, by date: every session
that logs there shares it, and it outlives them all. Events are buffered and written
when there are enough of them, when the oldest has waited long enough, and when a
query ends. Nothing is dropped: what could not be written stays in the buffer for
the next time. A driver that is killed loses at most what it had buffered.
"""

from __future__ import annotations

import datetime as _dt
import logging
import time
from threading import Lock

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.utils import AnalysisException

from textflow.schemas import STREAM_EVENTS
from textflow.session import scratch_path

log = logging.getLogger("textflow.progress")

#: What makes an event the same one, should it be written twice.
EVENT_KEY = ("kind", "run_id", "batch_id", "timestamp")


class ProgressLog(StreamingQueryListener):
    """Writes the events of the session's streaming queries to ``path``."""

    def __init__(self, spark: SparkSession, path: str, flush_events: int = 100, flush_seconds: float = 30.0):
        self.spark, self.path = spark, path.rstrip("/")
        self.flush_events, self.flush_seconds = flush_events, flush_seconds
        self.ended: set = set()          # runs whose end has been seen
        self._buffer: list = []
        self._oldest = 0.0
        self._lock, self._writing = Lock(), Lock()

    # events ------------------------------------------------------------------
    def _add(self, kind: str, query, timestamp=None, error=None, progress=None) -> None:
        values = {"kind": kind, "id": str(query.id), "run_id": str(query.runId), "name": getattr(query, "name", None),
                  "timestamp": timestamp, "error": error, "logged_at": _dt.datetime.now(_dt.timezone.utc)}
        if progress is not None:
            took = (progress.durationMs or {}).get("triggerExecution", 0)
            values.update(batch_id=int(progress.batchId), num_input_rows=int(progress.numInputRows),
                          input_rows_per_second=float(progress.inputRowsPerSecond or 0.0),
                          processed_rows_per_second=float(progress.processedRowsPerSecond or 0.0), trigger_ms=int(took))
        with self._lock:
            if not self._buffer:
                self._oldest = time.time()
            self._buffer.append(tuple(values.get(f.name) for f in STREAM_EVENTS.fields))
            full = len(self._buffer) >= self.flush_events or time.time() - self._oldest >= self.flush_seconds
        if full or kind == "terminated":
            self._try_flush()

    def onQueryStarted(self, event):
        self._add("started", event, event.timestamp)

    def onQueryProgress(self, event):
        self._add("progress", event.progress, event.progress.timestamp, progress=event.progress)

    def onQueryIdle(self, event):
        self._add("idle", event, event.timestamp)

    def onQueryTerminated(self, event):
        self._add("terminated", event, error=event.exception)
        self.ended.add(str(event.runId))

    # table --------------------------------------------------------------------
    def _try_flush(self) -> None:
        try:
            self.flush()
        except Exception:  # noqa: BLE001 -- monitoring never ends a query; the events wait
            log.exception("progress events could not be written to %s; they are kept", self.path)

    def flush(self) -> int:
        """Write what is buffered (one small file for each date); the number of events."""
        with self._writing:
            with self._lock:
                taken = list(self._buffer)
            if not taken:
                return 0
            rows = self.spark.createDataFrame(taken, STREAM_EVENTS).coalesce(1)
            day = F.date_format(F.to_utc_timestamp("logged_at", F.current_timezone()), "yyyy-MM-dd")
            rows.withColumn("date", day).write.mode("append").partitionBy("date").parquet(self.path)
            with self._lock:   # only now: events that come meanwhile stand behind those taken
                del self._buffer[:len(taken)]
                self._oldest = time.time()
            return len(taken)

    def frame(self, spark: SparkSession | None = None) -> DataFrame:
        """The progress of every batch that was ever logged here, this session's included."""
        self.flush()
        return progress_table(spark or self.spark, self.path).where("kind = 'progress'").drop("kind", "error")

    def wait_for(self, run_id, seconds: float = 30.0) -> bool:
        """Whether the end of a run was seen (events reach a listener after the query ends)."""
        until = time.time() + seconds
        while str(run_id) not in self.ended and time.time() < until:
            time.sleep(0.05)
        return str(run_id) in self.ended


def attach(spark: SparkSession, path: str | None = None, **kwargs) -> ProgressLog:
    """Log the session's queries to ``path``, by default a fresh folder of the shared one."""
    listener = ProgressLog(spark, path or scratch_path(spark, "progress"), **kwargs)
    spark.streams.addListener(listener)
    return listener


def progress_table(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """All logged events, each once; of dates from ``since`` on, if given."""
    parts = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in STREAM_EVENTS.fields) + ", date string"
    try:
        found = spark.read.schema(parts).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], parts).drop("date")
    if since is not None:
        found = found.where(F.col("date") >= F.lit(since))
    once = Window.partitionBy(*EVENT_KEY).orderBy("logged_at")
    return found.withColumn("copy", F.row_number().over(once)).where("copy = 1").drop("copy", "date")


def merge_date(spark: SparkSession, path: str, date: str) -> int:
    """Rewrite the events of a closed date into one file; their number.

    The merged copy is written beside the small files, which are deleted after it is
    complete. If a call dies in between, some events are there twice, which readers
    leave out, and the next call merges all again."""
    folder = f"{path.rstrip('/')}/date={date}"
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(folder)
    store = where.getFileSystem(conf)
    if not store.exists(where):
        return 0
    small = [s.getPath() for s in store.listStatus(where) if not s.getPath().getName().startswith(("_", "."))]
    events = spark.read.schema(STREAM_EVENTS).parquet(*[p.toString() for p in small]).dropDuplicates(list(EVENT_KEY))
    events.coalesce(1).write.mode("append").parquet(folder)
    for p in small:
        store.delete(p, False)
    return spark.read.schema(STREAM_EVENTS).parquet(folder).count()
