"""Physical-plan properties the operators rely on for scale."""

import contextlib
import io
import re

from pyspark.sql import functions as F

from conftest import SF01

import __spark_entry__ as entry
from textflow.operators import layout

QUERIES = entry.queries()


def _plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_tfidf_tokenises_once_and_reuses_the_tf_shuffle(spark):
    from textflow.operators import features as feat

    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    # the threshold path of top_k (taken on large inputs), forced here
    df = layout.top_k(feat.tfidf(docs), 100, "tfidf", "doc_id", "term")
    df.collect()
    plan = _plan(df, "simple")   # final adaptive plan after execution
    assert "ReusedExchange" in plan
    assert "TakeOrderedAndProject" in plan or "TakeOrdered" in plan


def test_no_tokenisation_pushed_into_filters(spark):
    for name in ("term_tf", "term_df_idf", "token_counts", "stopword_filtered"):
        plan = _plan(QUERIES[name](spark, SF01))
        conditions = [line for line in plan.splitlines() if line.strip().startswith("Condition")]
        assert not any("split(" in c for c in conditions), name


def test_auc_windows_are_partitioned_by_bucket(spark):
    df = QUERIES["roc_auc"](spark, SF01)
    plan = _plan(df, "simple")
    specs = re.findall(r"windowspecdefinition\(([^)]*)\)", plan)
    # only the B-row bucket-offset window has no partition key; the per-score
    # prefix window is partitioned by bucket
    assert any(s.startswith("bucket") and "score" in s for s in specs)
    assert not any(s.startswith("score") for s in specs)


def test_partition_and_column_pruning_reach_the_scan(spark):
    plan = _plan(QUERIES["predictions_one_date"](spark, SF01))
    assert re.search(r"PartitionFilters: \[isnotnull\(date#\d+\), \(.*date#\d+.* = \d{4}-\d\d-\d\d\)\]", plan)
    plan = _plan(QUERIES["labelled_text"](spark, SF01))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
    assert "ReadSchema: struct<doc_id:bigint,quality:int>" in plan


def test_metrics_are_one_global_aggregate(spark):
    plan = _plan(QUERIES["weighted_metrics"](spark, SF01), "simple")
    assert plan.count("HashAggregate") == 2       # partial + final, no join, no sort
    assert "SortMergeJoin" not in plan and "Window" not in plan


def _executed(df):
    """The final adaptive plan without any (nested) initial-plan blocks."""
    df.collect()
    text = re.split(r"\n\+- == Initial Plan ==", _plan(df, "simple"))[0]
    out, skip = [], None
    for line in text.splitlines():
        if "== Initial Plan ==" in line:
            skip = line.index("+-")
            continue
        if skip is not None and "+-" in line and line.index("+-") <= skip:
            skip = None
        if skip is None:
            out.append(line)
    return "\n".join(out)


def test_term_statistics_tokenise_the_corpus_once(spark):
    from textflow.operators import features as feat

    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    for df in (QUERIES["term_df_idf"](spark, SF01),
               layout.top_k(feat.tfidf(docs), 100, "tfidf", "doc_id", "term")):
        plan = _executed(df)
        assert plan.count("Generate explode") == 1, plan
        assert "ReusedExchange" in plan


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_dir):
    from textflow.operators.prep import labelled_from_raw

    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    d = layout.write_bucketed(docs, "tf_docs_bucketed", "doc_id", 8, f"{tmp_dir}/docs")
    l = layout.write_bucketed(labels, "tf_labels_bucketed", "doc_id", 8, f"{tmp_dir}/labels")
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")     # force the sort-merge join
    try:
        joined = d.join(l, "doc_id").select(
            (F.col("quality") * 4).alias("polarity"), F.col("doc_id").alias("id"), "text")
        out = labelled_from_raw(joined, keep=("id",))
        plan = _executed(out)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert out.count() == labels.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)
        spark.sql("DROP TABLE IF EXISTS tf_docs_bucketed")
        spark.sql("DROP TABLE IF EXISTS tf_labels_bucketed")
