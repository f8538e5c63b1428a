"""Spark session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins and coalesces small
# shuffle partitions, skew-join splits hot partitions of a sort-merge join.
SCALE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # SQL lower() with Java case mapping, as the ML text stages use; ICU root
    # mapping differs only in context rules such as Greek final sigma
    "spark.sql.icu.caseMappings.enabled": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "textflow",
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the defaults above.

    On a cluster leave ``master`` unset so spark-submit decides; tests pass
    ``local[N]`` and a small ``shuffle_partitions``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SCALE_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints and written intermediate tables.

    Read from the session (``spark.checkpoint.dir`` or the context's checkpoint
    dir). Only when neither is set -- local runs and tests -- a folder is
    created and registered as the checkpoint dir.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return (sc.getCheckpointDir() or conf_dir).rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; set it to a shared folder on the cluster"
        )
    local = tempfile.mkdtemp(prefix="textflow-ckpt-")
    sc.setCheckpointDir(local)
    return (sc.getCheckpointDir() or local).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of :func:`shared_dir` for one job's tables."""
    return f"{shared_dir(spark)}/textflow/{name}-{uuid.uuid4().hex[:12]}"
