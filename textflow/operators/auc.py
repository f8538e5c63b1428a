"""Exact area under the ROC and precision-recall curves, without a global sort.

Same curves as Spark's ``BinaryClassificationMetrics`` with ``numBins=0``:
one point per distinct score in descending order; ROC is closed with (0,0)
and (1,1), PR starts at (0, precision of the top score); areas by trapezoids.
With ``P`` positives and ``N`` negatives, and for each distinct score ``s``
its counts ``pos_s, neg_s`` and the counts ``pos_above, neg_above`` of all
higher scores::

    ROC = sum_s neg_s * (pos_above + pos_s / 2) / (P * N)
    PR  = sum_s pos_s / P * (prec_s + prec_prev) / 2

So all that is needed is a prefix sum over the distinct scores. A plain
``Window.orderBy(score)`` would pull every row into one task; instead:

1. ``groupBy(score)`` -- partial aggregation, one row per distinct score
   (ties, however hot, collapse into one row);
2. approximate quantiles of the distinct scores give ``B`` range buckets
   (``percentile_approx`` as a scalar subquery; a score finds its bucket by
   binary search over the ``B - 1`` boundaries);
3. per-bucket totals (``B`` rows) -> prefix offsets over buckets -> broadcast
   join back (size bound ``B``);
4. a window partitioned by bucket gives the prefix inside each bucket;
5. one global aggregate sums the trapezoids.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def raw_score(col: str = "rawPrediction") -> Column:
    """The positive-class score of a raw prediction vector (index 1), as
    the binary evaluator uses it."""
    return vector_to_array(F.col(col))[1]


def _default_buckets(df: DataFrame) -> int:
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(4, 4 * partitions)


def score_counts(df: DataFrame, label_col: str = "label", score_col: str = "score") -> DataFrame:
    """``(score, pos, neg)`` per distinct score; null/NaN scores and null labels dropped."""
    score = F.col(score_col).cast("double")
    label = F.col(label_col).cast("double")
    return (
        df.select(score.alias("score"), label.alias("label"))
        .where(F.col("score").isNotNull() & ~F.isnan("score") & F.col("label").isNotNull())
        .groupBy("score")
        .agg(
            F.count_if(F.col("label") > 0.5).cast("double").alias("pos"),
            F.count_if(F.col("label") <= 0.5).cast("double").alias("neg"),
        )
    )


def unscored(df: DataFrame, label_col: str = "label", score_col: str = "score") -> DataFrame:
    """One row ``n_unscored``: the rows that the curves leave out (null or NaN
    score, null label)."""
    score = F.col(score_col).cast("double")
    return df.agg(F.count_if(score.isNull() | F.isnan(score) | F.col(label_col).isNull()).alias("n_unscored"))


def _bucket_of(score: Column, boundaries: Column, size: int) -> Column:
    """Number of ``boundaries`` (sorted, ``size`` of them) strictly below
    ``score``: a binary-lifting search in ``log2(size)`` steps, so each
    distinct score costs O(log B) comparisons."""
    steps, step = [], 1
    while step <= size:
        steps.append(step)
        step *= 2
    steps.reverse()

    def lift(idx, s):
        nxt = idx + s
        return F.when((nxt <= F.lit(size)) & (F.element_at(boundaries, nxt) < score), nxt).otherwise(idx)

    return F.aggregate(F.array(*[F.lit(x) for x in steps]), F.lit(0), lift)


def curve_points(counts: DataFrame, num_buckets: int | None = None,
                 relative_error: float | None = None) -> DataFrame:
    """``counts`` plus ``pos_above``/``neg_above``: totals of strictly higher scores.

    Range buckets come from approximate quantiles of the distinct scores,
    computed as a scalar subquery of the same query (no eager job); the
    quantile error defaults to a quarter of a bucket's share, so buckets stay
    balanced however many there are."""
    buckets = num_buckets or _default_buckets(counts)
    if relative_error is None:
        relative_error = max(1e-5, min(1e-3, 0.25 / max(buckets, 1)))
    if buckets < 2:
        bucketed = counts.withColumn("bucket", F.lit(0))
    else:
        probs = [i / buckets for i in range(1, buckets)]
        accuracy = int(round(1.0 / relative_error))
        # ``pos + neg > 0`` always holds; it keeps the count columns in this
        # branch so the subquery reads the same score-count shuffle as the
        # main query (ReusedExchange) instead of scanning and scoring again
        boundaries = counts.where((F.col("pos") + F.col("neg")) > 0).select(
            F.percentile_approx("score", F.array(*[F.lit(p) for p in probs]), accuracy)
        ).scalar()
        # a subquery may not sit inside a lambda: carry the boundaries as a column
        bucketed = (
            counts.withColumn("__bounds", boundaries)
            .withColumn("bucket", _bucket_of(F.col("score"), F.col("__bounds"), buckets - 1))
            .drop("__bounds")
        )
    # B rows; the window over them runs in one task but B is bounded
    totals = bucketed.groupBy("bucket").agg(F.sum("pos").alias("b_pos"), F.sum("neg").alias("b_neg"))
    higher = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "bucket",
        F.coalesce(F.sum("b_pos").over(higher), F.lit(0.0)).alias("off_pos"),
        F.coalesce(F.sum("b_neg").over(higher), F.lit(0.0)).alias("off_neg"),
    )
    inside = Window.partitionBy("bucket").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    return (
        bucketed.join(F.broadcast(offsets), "bucket")
        .select(
            "score", "pos", "neg",
            (F.col("off_pos") + F.coalesce(F.sum("pos").over(inside), F.lit(0.0))).alias("pos_above"),
            (F.col("off_neg") + F.coalesce(F.sum("neg").over(inside), F.lit(0.0))).alias("neg_above"),
        )
    )


def curve_areas(points: DataFrame) -> DataFrame:
    """One row: ``roc_auc, pr_auc, n_pos, n_neg`` (areas null when a class is missing)."""
    pos, neg = F.col("pos"), F.col("neg")
    pos_above, neg_above = F.col("pos_above"), F.col("neg_above")
    prec = (pos_above + pos) / (pos_above + pos + neg_above + neg)
    prev = F.when(pos_above + neg_above == 0, prec).otherwise(pos_above / (pos_above + neg_above))
    sums = points.agg(
        F.sum(pos).alias("P"),
        F.sum(neg).alias("N"),
        F.sum(neg * (pos_above + pos / 2.0)).alias("roc_num"),
        F.sum(pos * (prec + prev) / 2.0).alias("pr_num"),
    )
    valid = (F.col("P") > 0) & (F.col("N") > 0)
    return sums.select(
        F.when(valid, F.col("roc_num") / (F.col("P") * F.col("N"))).alias("roc_auc"),
        F.when(valid, F.col("pr_num") / F.col("P")).alias("pr_auc"),
        F.coalesce(F.col("P"), F.lit(0.0)).cast("bigint").alias("n_pos"),
        F.coalesce(F.col("N"), F.lit(0.0)).cast("bigint").alias("n_neg"),
    )


def binary_areas(df: DataFrame, label_col: str = "label", score_col: str = "score",
                 num_buckets: int | None = None) -> DataFrame:
    """Exact ROC and PR areas of ``score_col`` against a 0/1 ``label_col``."""
    counts = score_counts(df, label_col, score_col)
    return curve_areas(curve_points(counts, num_buckets))


def binary_areas_from_raw(df: DataFrame, label_col: str = "label",
                          raw_col: str = "rawPrediction", num_buckets: int | None = None) -> DataFrame:
    """Same, scoring with element 1 of a raw prediction vector."""
    return binary_areas(df.withColumn("__score", raw_score(raw_col)), label_col, "__score", num_buckets)


def area_values(df: DataFrame, label_col: str = "label", score_col: str = "score",
                num_buckets: int | None = None) -> dict:
    """Eager form for driver-side reporting: the distinct-score table is
    persisted once for the quantile pass and the prefix-sum pass, then freed."""
    counts = score_counts(df, label_col, score_col).persist()
    try:
        areas = curve_areas(curve_points(counts, num_buckets)).first().asDict()
        return areas | unscored(df, label_col, score_col).first().asDict()
    finally:
        counts.unpersist()


def area_values_from_raw(df: DataFrame, label_col: str = "label", raw_col: str = "rawPrediction",
                         num_buckets: int | None = None) -> dict:
    return area_values(df.withColumn("__score", raw_score(raw_col)), label_col, "__score", num_buckets)
