import corpus_pipeline
import pytest

from helpers import SF001, odd_docs
from textflow.llm.common import written


def test_stages_keep_the_columns_and_only_drop(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        after = written(stage(spark, now, SF001), "t")
        assert set(docs.columns) <= set(after.columns)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == docs.columns and after.dtypes == docs.dtypes
        assert after.count() <= now.count() and after.select("doc_id").distinct().count() == after.count()
        now = after
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF001).select("doc_id", "taken").collect())) == \
        sorted(map(tuple, now.select("doc_id", "taken").collect()))


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_odd_rows(spark, name, stage):
    docs = odd_docs(spark)
    out = stage(spark, docs, SF001)
    if name != "source mixing":
        assert out.columns == docs.columns
    assert 0 < out.count() <= docs.count()
    assert stage(spark, docs.limit(0), SF001).count() == 0


def test_exact_and_near_copies(spark):
    text = " ".join(f"w{i * i % 997}" for i in range(400))
    rows = [(i, text if i % 2 else text + f" extra{i // 2}", "en", "s", 1) for i in range(10)] + [(50, "quite another text of some words", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted(r["doc_id"] for r in dict(corpus_pipeline.STAGES)["simhash near-dedup"](spark, docs, SF001).collect())
    assert kept == [0, 50]
