"""Evaluation plans: confusion counts, per-class and weighted metrics, exact
ROC / PR areas. Fixture: ``labels`` with ``label = quality`` and the rule
prediction ``1 - toxic``; scores for the areas come from ``n_chars``."""

from __future__ import annotations

from pyspark.sql import functions as F

from textflow.functions.keyed import keyed_bucket_sql
from textflow.operators import auc, evaluate as ev, profile, score_sketch
from textflow.operators.layout import persisted
from textflow.operators.splits import with_split
from textflow.plans.catalog import plan, r6, table

PREDICTED_SQL = """
SELECT CAST(quality AS DOUBLE) AS label, CAST(1 - toxic AS DOUBLE) AS prediction FROM labels
"""

COUNTS_SQL = f"""
SELECT count(*) FILTER (WHERE label = 0 AND prediction = 0) AS c00,
       count(*) FILTER (WHERE label = 0 AND prediction = 1) AS c01,
       count(*) FILTER (WHERE label = 1 AND prediction = 0) AS c10,
       count(*) FILTER (WHERE label = 1 AND prediction = 1) AS c11
FROM ({PREDICTED_SQL})
"""

# per-class precision / recall / f1 with 0 for undefined ratios
CLASS_SQL = f"""
WITH c AS ({COUNTS_SQL}),
k AS (
  SELECT 0 AS class, c00 AS tp, c10 AS fp, c01 AS fn, c00 + c01 AS support, c00+c01+c10+c11 AS total FROM c
  UNION ALL
  SELECT 1, c11, c01, c10, c10 + c11, c00+c01+c10+c11 FROM c),
m AS (
  SELECT class, support, total,
         CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision,
         CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall,
         tp FROM k)
SELECT class, precision, recall,
       CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1,
       support, total, tp
FROM m
"""


def predicted(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    return labels.select(
        F.col("quality").cast("double").alias("label"), (1 - F.col("toxic")).cast("double").alias("prediction")
    )


def _row(spark, sf_dir):
    return ev.confusion_row(predicted(spark, sf_dir))


@plan(
    "confusion_matrix",
    f"""
    WITH c AS ({COUNTS_SQL})
    SELECT 0 AS label, c00 AS pred_0, c01 AS pred_1 FROM c
    UNION ALL SELECT 1, c10, c11 FROM c
    """,
)
def q_confusion_matrix(spark, sf_dir):
    return ev.confusion_matrix(_row(spark, sf_dir))


@plan(
    "class_metrics",
    f"""
    SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall,
           round(f1, 6) AS f1, CAST(support AS BIGINT) AS support
    FROM ({CLASS_SQL})
    """,
)
def q_class_metrics(spark, sf_dir):
    m = ev.class_metrics(_row(spark, sf_dir))
    return m.select("class", r6("precision").alias("precision"), r6("recall").alias("recall"),
                    r6("f1").alias("f1"), "support")


@plan(
    "weighted_metrics",
    f"""
    SELECT round(sum(tp) / max(total), 6) AS accuracy,
           round(sum(precision * support) / max(total), 6) AS weighted_precision,
           round(sum(recall * support) / max(total), 6) AS weighted_recall,
           round(sum(f1 * support) / max(total), 6) AS weighted_f1,
           CAST(max(total) AS BIGINT) AS n_rows
    FROM ({CLASS_SQL})
    """,
)
def q_weighted_metrics(spark, sf_dir):
    m = ev.weighted_metrics(_row(spark, sf_dir))
    return m.select(*[r6(c).alias(c) for c in ("accuracy", "weighted_precision", "weighted_recall",
                                                 "weighted_f1")], "n_rows")


@plan(
    "binary_counts",
    f"""
    SELECT c00 AS tn, c01 AS fp, c10 AS fn, c11 AS tp,
           round((c00 + c11) / (c00 + c01 + c10 + c11), 6) AS accuracy
    FROM ({COUNTS_SQL})
    """,
)
def q_binary_counts(spark, sf_dir):
    m = ev.binary_counts(_row(spark, sf_dir))
    return m.select("tn", "fp", "fn", "tp", r6("accuracy").alias("accuracy"))


def _areas_sql(score_sql: str) -> str:
    """Exact ROC / PR areas with a plain global window (fine for the check size)."""
    return f"""
    WITH s AS (
      SELECT {score_sql} AS score, CAST(l.quality AS DOUBLE) AS label
      FROM labels l JOIN documents d ON l.doc_id = d.doc_id
      WHERE l.quality IS NOT NULL AND d.n_chars IS NOT NULL),
    g AS (SELECT score, count(*) FILTER (WHERE label > 0.5) AS pos,
                 count(*) FILTER (WHERE label <= 0.5) AS neg FROM s GROUP BY score),
    c AS (SELECT score, pos, neg,
                 coalesce(sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pa,
                 coalesce(sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS na
          FROM g),
    p AS (SELECT *, (pa + pos) / (pa + pos + na + neg) AS prec,
                 CASE WHEN pa + na = 0 THEN (pa + pos) / (pa + pos + na + neg) ELSE pa / (pa + na) END AS prev
          FROM c)
    SELECT round(sum(neg * (pa + pos / 2.0)) / (sum(pos) * sum(neg)), 6) AS roc_auc,
           round(sum(pos * (prec + prev) / 2.0) / sum(pos), 6) AS pr_auc,
           CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg
    FROM p
    """


def _areas(spark, sf_dir, score):
    labels = table(spark, sf_dir, "labels")
    docs = table(spark, sf_dir, "documents")
    scored = labels.join(docs, "doc_id").select(F.col("quality").alias("label"), score.alias("score"))
    out = auc.binary_areas(scored, "label", "score")
    return out.select(r6("roc_auc").alias("roc_auc"), r6("pr_auc").alias("pr_auc"), "n_pos", "n_neg")


@plan("roc_auc", _areas_sql("floor(d.n_chars / 500.0)"))
def q_roc_auc(spark, sf_dir):
    """Coarse score (many ties) -- ties must share one curve point."""
    return _areas(spark, sf_dir, F.floor(F.col("n_chars") / 500.0))


@plan("pr_auc", _areas_sql("CAST(d.n_chars AS DOUBLE)"))
def q_pr_auc(spark, sf_dir):
    """Fine score (mostly distinct)."""
    return _areas(spark, sf_dir, F.col("n_chars").cast("double"))


@plan("sketched_auc", f"SELECT roc_auc, n_pos, n_neg, TRUE AS within_bound, TRUE AS bound_is_small FROM ({_areas_sql('CAST(d.n_chars AS DOUBLE)')})")
def q_sketched_auc(spark, sf_dir):
    """Sketches of seven batches of scores, merged: their area is within their own error
    bound of the exact one, and the bound is under a hundredth."""
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents"), "doc_id").select(
        F.col("quality").alias("label"), F.col("n_chars").cast("double").alias("score"), (F.col("doc_id") % 7).alias("batch"))
    area = score_sketch.roc_area(score_sketch.sketch(rows, by=("batch",))).select("roc_auc", "error_bound", "n_pos", "n_neg")
    exact = auc.binary_areas(rows).select(F.col("roc_auc").alias("exact")).scalar()
    near = F.abs(F.col("roc_auc") - exact) <= F.col("error_bound") + 1e-12
    return area.select(r6(exact).alias("roc_auc"), "n_pos", "n_neg", near.alias("within_bound"), (F.col("error_bound") < 0.01).alias("bound_is_small"))


@plan(
    "class_balance",
    """
    SELECT source AS run_id, name, CAST(CASE name WHEN 'pos_count' THEN pos WHEN 'neg_count' THEN n - pos ELSE n END AS DOUBLE) AS value
    FROM (SELECT d.source, count(*) AS n, count(*) FILTER (WHERE l.quality = 1) AS pos
          FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1),
         (VALUES ('pos_count'), ('neg_count'), ('total_rows')) t(name)
    """,
)
def q_class_balance(spark, sf_dir):
    """The class balance of each source's labelled documents as metric rows of a run."""
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents"), "doc_id").select(
        "source", F.col("quality").alias("label"), "text")
    sources = [r["source"] for r in rows.select("source").distinct().collect()]   # a handful
    parts = [profile.class_balance_rows(profile.profile_labelled(rows.where(F.col("source") == s)), s) for s in sources]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@plan(
    "cached_splits",
    f"""
    SELECT split, count(*) AS n_rows, count(*) FILTER (WHERE label = 1) AS n_pos, TRUE AS cached, TRUE AS released FROM (
      SELECT CAST(l.quality AS INTEGER) AS label, CASE WHEN {keyed_bucket_sql('d.doc_id')} < 8000 THEN 'train'
             WHEN {keyed_bucket_sql('d.doc_id')} < 9000 THEN 'val' ELSE 'test' END AS split
      FROM documents d JOIN labels l ON d.doc_id = l.doc_id) GROUP BY 1
    """,
)
def q_cached_splits(spark, sf_dir):
    """Splits that are cached and counted for a block, and released after it."""
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents"), "doc_id").select(
        "doc_id", F.col("quality").cast("int").alias("label"))
    tagged = with_split(rows, "doc_id", 0.8, 0.1, 42)
    with persisted(tagged, materialise=True) as kept:
        cached = kept.storageLevel.useMemory
        counts = kept.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("label") == 1).alias("n_pos")).collect()
    released = not tagged.storageLevel.useMemory
    return spark.createDataFrame([(*r, cached, released) for r in counts], "split string, n_rows long, n_pos long, cached boolean, released boolean")
