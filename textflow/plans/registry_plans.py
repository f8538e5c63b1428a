"""Registry plans over pseudo-runs derived from the labelled corpus.

Each ``(lang, source)`` group of labelled documents acts as a run whose
accuracy is that of the rule prediction ``1 - toxic`` against ``quality``;
each labelled document is a version (``doc_id`` as the version string, so
numeric and string order differ) of the model ``model-<lang>``. The tables
grow with the data, like a real registry under many runs and versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textflow.operators import registry as reg
from textflow.plans.catalog import plan, r6, table
from textflow.session import scratch_path

GATE = 0.75   # go-live accuracy threshold (test value)

RUNS_SQL = """
SELECT d.lang || '/' || d.source AS run_id, d.lang, d.source,
       count(*) FILTER (WHERE (1 - l.toxic) = l.quality) / count(*) AS accuracy,
       avg(l.quality) AS pos_rate, count(*) AS n_rows, CAST(min(d.doc_id) AS INTEGER) AS position,
       CASE WHEN min(d.doc_id) % 3 <> 0 THEN avg(l.toxic) END AS auc,
       CASE WHEN min(d.doc_id) % 2 = 0 THEN avg(l.quality * (1 - l.toxic)) END AS weighted_f1,
       CASE WHEN min(d.doc_id) % 4 <> 1 THEN d.lang END AS model_type,
       CASE WHEN min(d.doc_id) % 5 <> 2 THEN d.source END AS run_name
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
GROUP BY d.lang, d.source
"""

VERSIONS_SQL = """
SELECT 'model-' || d.lang AS name, CAST(d.doc_id AS VARCHAR) AS version,
       CASE WHEN l.quality = 1 THEN 'Production' ELSE 'Staging' END AS stage,
       'models:/model-' || d.lang || '/' || CAST(d.doc_id AS VARCHAR) AS uri,
       d.lang || '/' || d.source AS run_id
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
"""


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = _labelled(spark, sf_dir)
    return lab.groupBy("lang", "source").agg(
        (F.count_if((1 - F.col("toxic")) == F.col("quality")) / F.count(F.lit(1))).alias("accuracy"),
        F.avg("quality").alias("pos_rate"),
        F.count(F.lit(1)).alias("n_rows"),
        F.min("doc_id").cast("int").alias("position"),
        # fields that some runs lack
        F.when(F.min("doc_id") % 3 != 0, F.avg("toxic")).alias("auc"),
        F.when(F.min("doc_id") % 2 == 0, F.avg(F.col("quality") * (1 - F.col("toxic")))).alias("weighted_f1"),
        F.when(F.min("doc_id") % 4 != 1, F.first("lang")).alias("model_type"),
        F.when(F.min("doc_id") % 5 != 2, F.first("source")).alias("run_name"),
    ).withColumn("run_id", F.concat_ws("/", "lang", "source"))


def pseudo_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """``runs``, ``run_params``, ``run_metrics`` frames."""
    path = scratch_path(spark, "run-summary")   # derived once, read by three tables
    run_summary(spark, sf_dir).write.parquet(path)
    summary = spark.read.parquet(path)
    runs = summary.select(
        "run_id", F.lit(None).cast("string").alias("parent_run_id"), F.col("lang").alias("experiment"),
        "run_name", "position", F.lit(None).cast("timestamp").alias("started_at"),
    )
    metrics = summary.selectExpr(
        "run_id",
        "stack(5, 'accuracy', CAST(accuracy AS DOUBLE), 'pos_rate', CAST(pos_rate AS DOUBLE),"
        " 'n_rows', CAST(n_rows AS DOUBLE), 'auc', CAST(auc AS DOUBLE), 'weighted_f1', CAST(weighted_f1 AS DOUBLE)) AS (name, value)",
    ).where("value IS NOT NULL")
    params = summary.where("model_type IS NOT NULL").select("run_id", F.lit("model_type").alias("name"), F.col("model_type").alias("value"))
    return {"runs": runs, "run_params": params, "run_metrics": metrics}


def pseudo_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``model_versions`` frame; plans that use it alone don't derive the runs."""
    return _labelled(spark, sf_dir).select(
        F.concat(F.lit("model-"), "lang").alias("name"),
        F.col("doc_id").cast("string").alias("version"),
        F.when(F.col("quality") == 1, F.lit("Production")).otherwise(F.lit("Staging")).alias("stage"),
        F.concat(F.lit("models:/model-"), "lang", F.lit("/"), F.col("doc_id").cast("string")).alias("uri"),
        F.concat_ws("/", "lang", "source").alias("run_id"),
        F.lit(None).cast("timestamp").alias("created_at"),
    )


LATEST_SQL = f"""
SELECT name, arg_max(version, CAST(version AS BIGINT)) AS version,
       arg_max(stage, CAST(version AS BIGINT)) AS stage,
       arg_max(uri, CAST(version AS BIGINT)) AS uri,
       arg_max(run_id, CAST(version AS BIGINT)) AS run_id
FROM ({VERSIONS_SQL}) {{where}} GROUP BY name
"""


@plan("latest_version", LATEST_SQL.format(where=""))
def q_latest_version(spark, sf_dir):
    return reg.latest_versions(pseudo_versions(spark, sf_dir))


@plan("latest_production_version", LATEST_SQL.format(where="WHERE stage = 'Production'"))
def q_latest_production_version(spark, sf_dir):
    return reg.latest_versions(pseudo_versions(spark, sf_dir), stage="Production")


# Moves derived from the labelled documents: every version goes to Staging, those of good
# quality to Production some minutes later (some at the same time), toxic ones out of it.
AS_OF = "2024-01-03 06:00:00"
MOVES_SQL = """
SELECT 'model-' || d.lang AS name, CAST(d.doc_id AS VARCHAR) AS version, m.step, m.stage,
       TIMESTAMP '2024-01-01 00:00:00' + to_minutes(d.doc_id * 37 % 4320 + (m.step - 1) * (d.doc_id % 3) * 60) AS moved_at
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
JOIN (VALUES (1, 'Staging'), (2, 'Production'), (3, 'Archived')) m(step, stage)
  ON m.step = 1 OR m.step = 2 AND l.quality = 1 OR m.step = 3 AND l.toxic = 1
"""


def pseudo_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stage log that goes with the pseudo-runs' versions."""
    step = F.explode(F.array(*[F.struct(F.lit(k).alias("step"), F.lit(s).alias("stage")) for k, s in
                               enumerate(("Staging", "Production", "Archived"), 1)]))
    moves = _labelled(spark, sf_dir).withColumn("m", step).where(
        (F.col("m.step") == 1) | ((F.col("m.step") == 2) & (F.col("quality") == 1)) | ((F.col("m.step") == 3) & (F.col("toxic") == 1)))
    minutes = F.col("doc_id") * 37 % 4320 + (F.col("m.step") - 1) * (F.col("doc_id") % 3) * 60
    start = F.unix_timestamp(F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return moves.select(F.concat(F.lit("model-"), "lang").alias("name"), F.col("doc_id").cast("string").alias("version"),
                        F.lit(None).cast("string").alias("from_stage"), F.col("m.stage").alias("to_stage"),
                        F.timestamp_seconds(start + 60 * minutes).alias("moved_at"), F.col("m.step").cast("string").alias("move_id"))


@plan(
    "production_as_of",
    f"""
    SELECT name, arg_max(version, CAST(version AS BIGINT)) AS version, count(*) AS n_production FROM (
      SELECT name, version, arg_max(stage, row(moved_at, step)) AS stage FROM ({MOVES_SQL})
      WHERE moved_at <= TIMESTAMP '{AS_OF}' GROUP BY name, version)
    WHERE stage = 'Production' GROUP BY name
    """,
)
def q_production_as_of(spark, sf_dir):
    """The newest version in production at a time in the past, of each model, and how many
    were: from a registry's append-only log of stage moves."""
    registry = reg.Registry(spark, scratch_path(spark, "registry"))
    registry.append("model_versions", pseudo_versions(spark, sf_dir).withColumn("stage", F.lit(None).cast("string")))
    registry.append("stage_log", pseudo_moves(spark, sf_dir))
    then = registry.versions(as_of=AS_OF)
    newest = reg.latest_versions(then, "Production").select("name", "version")
    counts = then.where("stage = 'Production'").groupBy("name").agg(F.count(F.lit(1)).alias("n_production"))
    return newest.join(counts, "name")


@plan(
    "best_run",
    f"""
    SELECT run_id, lang, round(accuracy, 6) AS accuracy, round(auc, 6) AS auc, coalesce(model_type, 'unknown') AS model_type,
           coalesce(run_name, 'unknown') AS run_name
    FROM ({RUNS_SQL}) QUALIFY row_number() OVER (PARTITION BY lang ORDER BY accuracy DESC, position ASC, run_id ASC) = 1
    """,
)
def q_best_run(spark, sf_dir):
    """The best run of each experiment (language); runs may lack an AUC, a model type or a name."""
    t = pseudo_tables(spark, sf_dir)
    langs = [r["experiment"] for r in t["runs"].select("experiment").distinct().collect()]   # a handful
    found = [reg.best_run(t["runs"], t["run_metrics"], t["run_params"], experiment=lang).select(
        "run_id", F.lit(lang).alias("lang"), r6("accuracy").alias("accuracy"), r6("auc").alias("auc"), "model_type", "run_name") for lang in langs]
    out = found[0]
    for best in found[1:]:
        out = out.unionByName(best)
    return out


@plan(
    "version_metrics",
    f"""
    SELECT v.name, v.version, v.run_id, round(r.accuracy, 6) AS accuracy, round(r.auc, 6) AS auc, round(r.weighted_f1, 6) AS weighted_f1
    FROM ({VERSIONS_SQL}) v LEFT JOIN ({RUNS_SQL}) r ON v.run_id = r.run_id
    """,
)
def q_version_metrics(spark, sf_dir):
    """Every version with the metrics of its run, as far as the run has them."""
    t = pseudo_tables(spark, sf_dir)
    out = reg.version_metrics(pseudo_versions(spark, sf_dir), t["run_metrics"])
    return out.select("name", "version", "run_id", *[r6(c).alias(c) for c in ("accuracy", "auc", "weighted_f1")])


@plan(
    "metric_gate",
    f"SELECT run_id, round(accuracy, 6) AS accuracy FROM ({RUNS_SQL}) WHERE accuracy > {GATE}",
)
def q_metric_gate(spark, sf_dir):
    t = pseudo_tables(spark, sf_dir)
    wide = reg.metrics_wide(t["run_metrics"], ("accuracy",))
    return reg.metric_gate(wide, "accuracy", GATE).select("run_id", r6("accuracy").alias("accuracy"))


@plan(
    "best_model",
    f"""
    SELECT run_id AS model, round(accuracy, 6) AS accuracy, position
    FROM ({RUNS_SQL}) WHERE accuracy > 0 ORDER BY accuracy DESC, position ASC LIMIT 1
    """,
)
def q_best_model(spark, sf_dir):
    results = run_summary(spark, sf_dir).select(F.col("run_id").alias("model"), "accuracy", "position")
    return reg.best_model(results).select("model", r6("accuracy").alias("accuracy"), "position")


@plan(
    "registry_readback",
    f"""
    SELECT run_id, name, round(value, 6) AS value FROM (
      SELECT run_id, 'accuracy' AS name, accuracy AS value FROM ({RUNS_SQL})
      UNION ALL SELECT run_id, 'pos_rate', pos_rate FROM ({RUNS_SQL})
      UNION ALL SELECT run_id, 'n_rows', CAST(n_rows AS DOUBLE) FROM ({RUNS_SQL})
      UNION ALL SELECT run_id, 'auc', auc FROM ({RUNS_SQL}) WHERE auc IS NOT NULL
      UNION ALL SELECT run_id, 'weighted_f1', weighted_f1 FROM ({RUNS_SQL}) WHERE weighted_f1 IS NOT NULL)
    """,
)
def q_registry_readback(spark, sf_dir):
    """Append the pseudo-run tables to a registry folder and read them back."""
    registry = reg.Registry(spark, scratch_path(spark, "registry"))
    for name, frame in {**pseudo_tables(spark, sf_dir), "model_versions": pseudo_versions(spark, sf_dir)}.items():
        registry.append(name, frame)
    metrics = registry.table("run_metrics")
    return metrics.select("run_id", "name", r6("value").alias("value"))
