import math

import pytest
from pyspark.ml.feature import HashingTF, StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from conftest import SF01
from textflow.functions.text import default_stop_words, remove_stop_words, tokenize
from textflow.operators import features as feat

EDGE_TEXTS = [" a  b ", "", "   ", "Hello\tWorld\n", "x\x0by", "ÉTÉ été", "a\r\nb", "trailing   ", "  lead"]


def test_stop_words_match_spark(spark):
    words = default_stop_words()
    assert len(words) == 181
    assert list(words) == list(StopWordsRemover.loadDefaultStopWords("english"))


def test_tokenize_matches_ml_tokenizer_on_edge_cases(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(EDGE_TEXTS)], "id int, text string")
    ml = Tokenizer(inputCol="text", outputCol="ml").transform(df)
    rows = ml.select("id", "ml", tokenize("text").alias("native")).collect()
    for r in rows:
        assert r["ml"] == r["native"], (EDGE_TEXTS[r["id"]], r["ml"], r["native"])


def test_tokenize_and_stop_words_match_ml_on_corpus(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    ml = StopWordsRemover(inputCol="tokens", outputCol="ml_f").transform(
        Tokenizer(inputCol="text", outputCol="tokens").transform(docs)
    )
    out = ml.select(
        (F.col("tokens") == tokenize("text")).alias("tok_eq"),
        (F.col("ml_f") == remove_stop_words(tokenize("text"))).alias("f_eq"),
    )
    assert out.where(~F.col("tok_eq") | ~F.col("f_eq")).count() == 0


def test_term_idf_matches_ml_idf_without_collisions(spark):
    """Per-term IDF equals the ML IDF of the term's hash bucket when the
    bucket holds only that term."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    n = 1 << 18
    model = feat.feature_pipeline(n, 5).fit(docs)
    idf_vec = model.stages[-1].idf.toArray()
    terms = feat.idf_table(docs, 5).withColumn("one", F.array("term"))
    hashed = HashingTF(numFeatures=n, inputCol="one", outputCol="h").transform(terms)
    buckets = {}
    for r in hashed.select("idf", feat.vector_entries("h")[0]["index"].alias("b")).collect():
        buckets.setdefault(r["b"], []).append(r)
    checked = 0
    for idx, rows in buckets.items():
        if len(rows) == 1:
            assert abs(rows[0]["idf"] - idf_vec[idx]) < 1e-9
            checked += 1
    assert checked > 1000


def test_top_tfidf_is_ordered_and_bounded(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    top = feat.top_tfidf(docs, k=10).collect()
    assert len(top) == 10
    weights = [r["tfidf"] for r in top]
    assert weights == sorted(weights, reverse=True)


def test_hashed_features_total_equals_filtered_tokens(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    out = feat.hashed_features(docs, 1 << 12, 1)
    bad = out.where(F.col("n_filtered").cast("double") != feat.vector_total("rawFeatures"))
    assert bad.count() == 0 and out.count() == docs.count()
    assert isinstance(out.schema["features"].dataType, type(out.schema["rawFeatures"].dataType))
    # same IDF weights as fitting the whole ML pipeline
    ml = feat.feature_pipeline(1 << 12, 1).fit(docs).transform(docs).select("doc_id", F.col("features").alias("f2"))
    joined = out.join(ml, "doc_id")
    assert joined.where(F.col("features") != F.col("f2")).count() == 0


def test_tokenize_fuzz_matches_ml_tokenizer(spark):
    """Random strings over all six whitespace characters and letters whose
    lower-casing is special (Turkish dotted I, Greek final sigma, German ß)."""
    import random

    rnd = random.Random(11)
    alphabet = [" ", "\t", "\n", "\x0b", "\f", "\r", "a", "B", "é", "İ", "Σ", "ΟΔΟΣ", "ß", "ẞ", "x1", "'"]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 12))) for _ in range(2000)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    ml = Tokenizer(inputCol="text", outputCol="ml").transform(df)
    previous = spark.conf.get("spark.sql.icu.caseMappings.enabled")
    spark.conf.set("spark.sql.icu.caseMappings.enabled", "false")   # Java case mapping
    try:
        bad = ml.where(F.col("ml") != tokenize("text")).select("id").collect()
    finally:
        spark.conf.set("spark.sql.icu.caseMappings.enabled", previous)
    assert not bad, [texts[r["id"]] for r in bad[:5]]


def test_term_counts_take_rows_of_one_id_as_one_document(spark):
    rows = [(1, "q b b"), (2, "b c"), (2, "b d  d"), (None, "q e"), (None, "e"), (3, ""), (4, None), (5, "   ")]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    tf = feat.term_frequencies(docs).groupBy("term").agg(F.sum("tf").alias("o"), F.count(F.lit(1)).alias("d"))
    want = {r["term"]: (r["o"], r["d"]) for r in tf.collect()}
    counts = feat.corpus_term_counts(docs)
    assert {r["term"]: (r["n_occurrences"], r["n_docs"]) for r in counts.collect()} == want
    assert want["b"] == (4, 2) and want["e"] == (2, 1) and want[""] == (2, 2)
    assert counts.dtypes == [("term", "string"), ("n_occurrences", "bigint"), ("n_docs", "bigint")]
    # documents with a text: 1, 2, null, 3, 5
    idf = {r["term"]: (r["df"], r["idf"]) for r in feat.idf_table(docs, 1).collect()}
    assert idf["q"] == (2, pytest.approx(math.log(6 / 3))) and {t: d for t, (d, _) in idf.items()} == {t: d for t, (_, d) in want.items()}


def test_terms_of_unshared_ids_are_counted_before_the_shuffle(spark):
    """They were shuffled by (id, term), a row for each document and term."""
    docs = spark.range(50).selectExpr("id AS doc_id", "concat('x y ', id) AS text")
    for counts in (feat.corpus_term_counts(docs), feat.idf_table(docs, 1)):
        plan = counts._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(term" in plan and "hashpartitioning(doc_id" not in plan
