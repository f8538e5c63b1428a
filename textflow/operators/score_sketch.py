"""Mergeable sketches of scored, labelled rows, for areas under the ROC curve.

A sketch counts positives and negatives in buckets of scores whose bounds are a
fixed factor apart (``accuracy`` is the relative width), so sketches of batches,
days or models' shards are merged by adding up counts, and merging loses nothing.
Its size hangs on the range of the scores, not on the rows: a few thousand buckets
where an exact curve needs a row for each distinct score.

The area of a sketch counts a positive and a negative in one bucket as half. Only
those pairs can be wrong, each by a half at most, so the area's error is at most
``sum(pos * neg) / (2 P N)`` over the buckets -- a bound that the sketch itself
gives, for these data, not an estimate.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from textflow.operators import auc

ACCURACY = 0.001
LEAST = 1e-12     # scores nearer to zero are one bucket
SKETCH = "query_id string, batch_id long, bucket long, pos long, neg long"


def bucket_of(score: Column, accuracy: float = ACCURACY) -> Column:
    """A whole number that ascends with the score; infinities have the last ones."""
    step = math.log((1 + accuracy) / (1 - accuracy))
    ends = math.ceil(math.log(LEAST) / step)
    last = math.ceil(math.log(1.7976931348623157e308) / step) - ends + 2
    size = F.abs(score)
    steps = F.when(size == float("inf"), F.lit(last)).otherwise(F.ceil(F.log(size) / step) - ends + 1)
    return F.when(size < LEAST, F.lit(0)).otherwise(F.signum(score) * steps).cast("long")


def sketch(df: DataFrame, label_col: str = "label", score_col: str = "score", accuracy: float = ACCURACY,
           by: tuple = ()) -> DataFrame:
    """``(*by, bucket, pos, neg)``: one partial aggregation. Null and NaN scores and null
    labels are left out, as of the exact curves."""
    score, label = F.col(score_col).cast("double"), F.col(label_col).cast("double")
    rows = df.select(*by, bucket_of(score, accuracy).alias("bucket"), label.alias("__label"), score.alias("__score"))
    rows = rows.where(F.col("__score").isNotNull() & ~F.isnan("__score") & F.col("__label").isNotNull())
    return rows.groupBy(*by, "bucket").agg(F.count_if(F.col("__label") > 0.5).alias("pos"), F.count_if(F.col("__label") <= 0.5).alias("neg"))


def merged(sketches: DataFrame, by: tuple = ()) -> DataFrame:
    """Sketches (of one accuracy) added up, for each group ``by``."""
    return sketches.groupBy(*by, "bucket").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def roc_area(sketches: DataFrame) -> DataFrame:
    """One row ``roc_auc, error_bound, n_pos, n_neg``: the area of all sketches together
    and how far from the exact one it can be (null when a class is missing)."""
    counts = merged(sketches).select(F.col("bucket").cast("double").alias("score"), F.col("pos").cast("double").alias("pos"),
                                     F.col("neg").cast("double").alias("neg"))
    points = auc.curve_points(counts)
    sums = points.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"), F.sum(F.col("pos") * F.col("neg")).alias("within"),
                      F.sum(F.col("neg") * (F.col("pos_above") + F.col("pos") / 2.0)).alias("area"))
    pairs = F.when((F.col("p") > 0) & (F.col("n") > 0), F.col("p") * F.col("n"))
    return sums.select((F.col("area") / pairs).alias("roc_auc"), (F.col("within") / 2.0 / pairs).alias("error_bound"),
                       *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(n) for c, n in (("p", "n_pos"), ("n", "n_neg"))])


# -- sketches of batches --------------------------------------------------------

def write_batch(scored: DataFrame, path: str, query_id: str, batch_id: int, label_col: str = "label",
                raw_col: str = "rawPrediction", accuracy: float = ACCURACY) -> None:
    """The sketch of a scored batch; a replay of the batch replaces it."""
    rows = sketch(scored.withColumn("__raw", auc.raw_score(raw_col)), label_col, "__raw", accuracy)
    tagged = rows.withColumns({"query_id": F.lit(query_id), "batch_id": F.lit(batch_id).cast("long")})
    (tagged.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("query_id", "batch_id").parquet(path))


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """``(query_id, batch_id, bucket, pos, neg)`` of all batches."""
    try:
        return spark.read.schema(SKETCH).parquet(path).select("query_id", "batch_id", "bucket", "pos", "neg")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SKETCH)


def running_area(spark: SparkSession, path: str, query_id: str | None = None) -> DataFrame:
    """The area over all batches so far (of one query, or of all)."""
    batches = read_batches(spark, path)
    return roc_area(batches if query_id is None else batches.where(F.col("query_id") == F.lit(query_id)))
