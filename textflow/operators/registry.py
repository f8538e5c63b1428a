"""Runs, parameters, metrics and model versions kept as plain Parquet tables.

Experiment tracking and the model registry become four long tables under one
root folder; picking the newest version or the best run is then an ordinary
query (``latest_versions``, ``best_run``, ``version_metrics``), which scales
with the number of runs/versions like any other aggregation.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from textflow.schemas import MODEL_VERSIONS, RUN_METRICS, RUN_PARAMS, RUNS, STAGE_LOG

TABLES = {
    "runs": RUNS,
    "run_params": RUN_PARAMS,
    "run_metrics": RUN_METRICS,
    "model_versions": MODEL_VERSIONS,
    "stage_log": STAGE_LOG,
}

STAGES = ("None", "Staging", "Production", "Archived")


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


# --------------------------------------------------------------------------
# queries over the tables
# --------------------------------------------------------------------------

def latest_versions(versions: DataFrame, stage: str | None = None) -> DataFrame:
    """Newest version per model name by *numeric* order ("10" > "2").

    ``max_by`` is a partial aggregate, so a name with millions of versions
    costs one row per task before the shuffle."""
    if stage is not None:
        versions = versions.where(F.col("stage") == F.lit(stage))
    numeric = F.col("version").try_cast("bigint")
    newest = F.max_by(F.struct("version", "stage", "uri", "run_id"), numeric)
    return (
        versions.where(numeric.isNotNull())
        .groupBy("name")
        .agg(newest.alias("v"))
        .select("name", "v.version", "v.stage", "v.uri", "v.run_id")
    )


def staged_versions(versions: DataFrame, stage_log: DataFrame, as_of=None) -> DataFrame:
    """``versions`` with the stage that each is in, or was in at ``as_of`` (a timestamp;
    versions registered later are left out then).

    The last move wins, by time and then by move id; a version that was never moved is
    in the stage it was registered with. ``max_by`` is a partial aggregate: a version
    with any number of moves costs a row a task before the shuffle."""
    if as_of is not None:
        at = F.lit(as_of).cast("timestamp")
        stage_log = stage_log.where(F.col("moved_at") <= at)
        versions = versions.where(F.col("created_at").isNull() | (F.col("created_at") <= at))
    last = stage_log.groupBy(F.col("name").alias("of"), F.col("version").alias("of_version")).agg(
        F.max_by(F.struct("to_stage"), F.struct("moved_at", "move_id")).alias("last"))
    joined = versions.join(last, (F.col("name") == F.col("of")) & (F.col("version") == F.col("of_version")), "left")
    stage = F.when(F.col("last").isNotNull(), F.col("last.to_stage")).otherwise(F.col("stage"))
    return joined.select(*[stage.alias("stage") if c == "stage" else F.col(c) for c in versions.columns])


def metrics_wide(run_metrics: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Long ``(run_id, name, value)`` to one row per run with a column per name
    (conditional aggregation over a fixed name list: no pivot discovery job)."""
    return run_metrics.groupBy("run_id").agg(
        *[F.max(F.when(F.col("name") == F.lit(n), F.col("value"))).alias(n) for n in names]
    )


def params_wide(run_params: DataFrame, names: tuple[str, ...]) -> DataFrame:
    return run_params.groupBy("run_id").agg(
        *[F.max(F.when(F.col("name") == F.lit(n), F.col("value"))).alias(n) for n in names]
    )


def best_run(runs: DataFrame, run_metrics: DataFrame, run_params: DataFrame,
             metric: str = "accuracy", experiment: str | None = None) -> DataFrame:
    """The run with the highest ``metric`` (first position wins ties), with its
    AUC, model type and run name; missing text fields read ``unknown``."""
    if experiment is not None:
        runs = runs.where(F.col("experiment") == F.lit(experiment))
    wide = metrics_wide(run_metrics, (metric, "auc"))
    params = params_wide(run_params, ("model_type",))
    return (
        runs.join(wide, "run_id").join(params, "run_id", "left")
        .where(F.col(metric).isNotNull())
        .orderBy(F.desc(metric), F.asc_nulls_last("position"), F.asc("run_id"))
        .limit(1)
        .select(
            "run_id",
            F.col(metric).alias(metric),
            F.col("auc"),
            F.coalesce(F.col("model_type"), F.lit("unknown")).alias("model_type"),
            F.coalesce(F.col("run_name"), F.lit("unknown")).alias("run_name"),
        )
    )


def version_metrics(versions: DataFrame, run_metrics: DataFrame,
                    names: tuple[str, ...] = ("accuracy", "auc", "weighted_f1")) -> DataFrame:
    """Each version with the metrics of the run that produced it (null = N/A)."""
    wide = metrics_wide(run_metrics, names)
    return versions.join(wide, "run_id", "left").select("name", "version", "run_id", *names)


def metric_gate(df: DataFrame, metric: str = "accuracy", minimum: float = 0.75) -> DataFrame:
    """Rows whose ``metric`` is strictly above ``minimum`` (go-live check)."""
    return df.where(F.col(metric) > F.lit(minimum))


def best_model(results: DataFrame, metric: str = "accuracy", position_col: str = "position") -> DataFrame:
    """Highest ``metric`` above 0; the first position wins ties; empty when all are 0."""
    return (
        results.where(F.col(metric) > 0)
        .orderBy(F.desc(metric), F.asc(position_col))
        .limit(1)
    )


# --------------------------------------------------------------------------
# the table store
# --------------------------------------------------------------------------

class Registry:
    """Append-only store of runs, params, metrics and model versions."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._buffer: dict | None = None

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def table(self, name: str) -> DataFrame:
        schema = TABLES[name]
        try:
            return self.spark.read.schema(schema).parquet(self.path(name))
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":   # only a missing table is an empty one
                raise
            return self.spark.createDataFrame([], schema)

    def append(self, name: str, df: DataFrame) -> None:
        schema = TABLES[name]
        cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
        df.select(*cols).write.mode("append").parquet(self.path(name))

    def _append_rows(self, name: str, rows: list[tuple]) -> None:
        if not rows:
            return
        if self._buffer is not None:
            self._buffer.setdefault(name, []).extend(rows)
            return
        # a few driver-side rows: one file, not one per core
        self.append(name, self.spark.createDataFrame(rows, TABLES[name]).coalesce(1))

    def batch(self) -> "_Batch":
        """Buffer every row logged inside the block and append each table once
        at the end (one small file per table instead of one per call)."""
        return _Batch(self)

    # runs --------------------------------------------------------------
    def start_run(self, run_name: str, experiment: str = "default",
                  parent_run_id: str | None = None, position: int | None = None) -> str:
        run_id = uuid.uuid4().hex
        self._append_rows("runs", [(run_id, parent_run_id, experiment, run_name, position, _now())])
        return run_id

    def log_params(self, run_id: str, params: dict) -> None:
        self._append_rows("run_params", [(run_id, str(k), None if v is None else str(v)) for k, v in params.items()])

    def log_metrics(self, run_id: str, metrics: dict) -> None:
        rows = [(run_id, str(k), None if v is None else float(v)) for k, v in metrics.items()]
        self._append_rows("run_metrics", rows)

    # versions ----------------------------------------------------------
    def next_version(self, name: str) -> int:
        row = (
            self.table("model_versions").where(F.col("name") == F.lit(name))
            .agg(F.max(F.col("version").try_cast("bigint")).alias("v")).first()
        )
        stored = 0 if row is None or row["v"] is None else int(row["v"])
        pending = [int(r[1]) for r in (self._buffer or {}).get("model_versions", []) if r[0] == name]
        return max([stored] + pending) + 1

    def _claim(self, name: str, version: int) -> int:
        """A number from ``version`` on that is this caller's alone, also when two
        trainings that read the same newest version register at once: each puts a
        file of its own into the number's folder and then looks; who finds another
        file there goes on to the next number. Of two callers at least the later
        one finds the other's file, so no number is used twice (some may be
        skipped). No file system needs an atomic create for this."""
        Path, conf = self.spark._jvm.org.apache.hadoop.fs.Path, self.spark._jsc.hadoopConfiguration()
        while True:
            folder = Path(f"{self.root}/claims/{name}/{version}")
            files = folder.getFileSystem(conf)
            files.create(Path(folder, uuid.uuid4().hex)).close()
            if len(files.listStatus(folder)) == 1:
                return version
            version += 1

    def register_model(self, name: str, model: PipelineModel, run_id: str | None = None,
                       stage: str | None = None) -> tuple[str, str]:
        """Save ``model`` under ``<root>/models/<name>/<version>`` and record it.
        The version is claimed first, and a saved model is never overwritten."""
        return self._register(name, lambda uri: model.write().save(uri), run_id, stage)

    def register_python_model(self, name: str, model, run_id: str | None = None,
                              stage: str | None = None) -> tuple[str, str]:
        """The same for a Python model, saved as the ``python`` flavor loads it."""
        from textflow.streaming.scorers import save_python_model

        return self._register(name, lambda uri: save_python_model(self.spark, model, uri), run_id, stage)

    def _register(self, name: str, save, run_id: str | None, stage: str | None) -> tuple[str, str]:
        version = str(self._claim(name, self.next_version(name)))
        uri = f"{self.root}/models/{name}/{version}"
        save(uri)
        self._append_rows("model_versions", [(name, version, stage, uri, run_id, _now())])
        return version, uri

    # stages --------------------------------------------------------------
    def versions(self, name: str | None = None, as_of=None) -> DataFrame:
        """The versions with the stages they are in (or were in at ``as_of``)."""
        mine = F.lit(True) if name is None else F.col("name") == F.lit(name)
        return staged_versions(self.table("model_versions").where(mine), self.table("stage_log").where(mine), as_of)

    def move(self, name: str, version: str, stage: str, archive_others: bool = False) -> str | None:
        """Move a version to ``stage`` (one of ``STAGES``); where it was before.

        The move is a row appended to the log; nothing is rewritten, so what was in
        production at any time can be asked later. With ``archive_others`` the versions
        that are in that stage now are archived by the same append."""
        if stage not in STAGES:
            raise ValueError(f"stage must be one of {STAGES}")
        mine = {r["version"]: r["stage"] for r in self.versions(name).where(
            (F.col("version") == F.lit(str(version))) | (F.col("stage") == F.lit(stage))).select("version", "stage").collect()}
        if str(version) not in mine:
            raise ValueError(f"no version {version} of {name}")
        moves = [(str(version), mine[str(version)], stage)]
        if archive_others:
            moves += [(v, stage, "Archived") for v, at in sorted(mine.items()) if v != str(version) and at == stage]
        rows = self.spark.createDataFrame([(name, *m, _now(), uuid.uuid4().hex) for m in moves], STAGE_LOG).coalesce(1)
        self.append("stage_log", rows.withColumn("moved_at", F.current_timestamp()))
        return mine[str(version)]

    def latest(self, name: str, stage: str | None = None, as_of=None) -> tuple[str | None, str | None]:
        """``(version, uri)`` of the newest version of ``name`` (that is in ``stage``; as of
        a time), or ``(None, None)``."""
        rows = latest_versions(self.versions(name, as_of), stage).collect()
        if not rows:
            return None, None
        return rows[0]["version"], rows[0]["uri"]

    def load(self, uri: str) -> PipelineModel:
        return PipelineModel.load(uri)


class _Batch:
    def __init__(self, registry: Registry):
        self.registry = registry

    def __enter__(self) -> Registry:
        self.registry._buffer = {}
        return self.registry

    def __exit__(self, exc_type, *exc) -> bool:
        buffered, self.registry._buffer = self.registry._buffer, None
        if exc_type is None:
            for name, rows in buffered.items():
                self.registry._append_rows(name, rows)
        return False
