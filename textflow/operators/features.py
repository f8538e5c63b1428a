"""Text features: Spark ML stages, and term-level forms of the same maths.

The ML stages (Tokenizer -> StopWordsRemover -> HashingTF -> IDF) are what a
model is trained with. The term-level functions compute the same tokens,
term frequencies, document frequencies and IDF weights per *term* (no hashing)
with plain DataFrame aggregations, for reports and for checking the ML stages.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, StopWordsRemover, Tokenizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textflow.functions.text import remove_stop_words, tokenize
from textflow.operators.layout import spread, top_k

def feature_stages(
    num_features: int = 1 << 15,
    min_doc_freq: int = 5,
    text_col: str = "text",
    features_col: str = "features",
) -> list:
    """Tokenizer, StopWordsRemover, HashingTF(num_features), IDF(min_doc_freq)."""
    return [
        Tokenizer(inputCol=text_col, outputCol="tokens"),
        StopWordsRemover(inputCol="tokens", outputCol="filtered"),
        HashingTF(inputCol="filtered", outputCol="rawFeatures", numFeatures=num_features),
        IDF(inputCol="rawFeatures", outputCol=features_col, minDocFreq=min_doc_freq),
    ]


def feature_pipeline(num_features: int = 1 << 15, min_doc_freq: int = 5, text_col: str = "text") -> Pipeline:
    return Pipeline(stages=feature_stages(num_features, min_doc_freq, text_col))


def hashing_model(num_features: int = 1 << 15, text_col: str = "text") -> PipelineModel:
    """The three stateless stages as a model (nothing to fit): text -> rawFeatures."""
    return PipelineModel(stages=feature_stages(num_features, 1, text_col)[:3])


def hashed_features(docs: DataFrame, num_features: int = 1 << 15, min_doc_freq: int = 5,
                    text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(id, n_tokens, n_filtered, rawFeatures, features)`` with the IDF fitted on ``docs``.

    The text is tokenised and hashed once: the term-frequency vectors (and
    token counts) are checkpointed to the shared checkpoint folder, and the
    IDF is fitted on and applied to that table. Fitting and transforming a
    ``Pipeline`` directly would tokenise the corpus twice; the checkpoint
    also cuts the lineage, so a lost executor does not re-tokenise."""
    from textflow.session import shared_dir

    shared_dir(docs.sparkSession)      # checkpoint() needs the folder set
    hashed = (
        hashing_model(num_features, text_col).transform(spread(docs.where(F.col(text_col).isNotNull())))
        .select(F.col(id_col), F.size("tokens").alias("n_tokens"), F.size("filtered").alias("n_filtered"),
                "rawFeatures")
        .checkpoint(eager=True)
    )
    idf = IDF(inputCol="rawFeatures", outputCol="features", minDocFreq=min_doc_freq).fit(hashed)
    return idf.transform(hashed)


def vector_total(col: str):
    """Sum of a vector column's stored values: of a sparse vector the non-zero
    ones, never its dense form (JVM-side, no Python)."""
    return F.aggregate(F.unwrap_udt(F.col(col))["values"], F.lit(0.0), lambda acc, x: acc + x)


def vector_entries(col: str):
    """``(index, value)`` structs of a sparse vector column's stored entries."""
    inner = F.unwrap_udt(F.col(col))
    return F.arrays_zip(inner["indices"].alias("index"), inner["values"].alias("value"))


def bucket_frequencies(hashed: DataFrame, vector_col: str = "rawFeatures") -> DataFrame:
    """``(bucket, df)``: the number of rows whose vector has an entry in the bucket, from
    the stored entries alone (what the IDF is fitted from). Entries are counted per
    task before the shuffle: at most as many rows a task as there are buckets."""
    entries = hashed.select(F.explode(vector_entries(vector_col)).alias("e")).where(F.col("e.value") != 0)
    return entries.groupBy(F.col("e.index").alias("bucket")).agg(F.count(F.lit(1)).alias("df"))


def term_buckets(terms: DataFrame, num_features: int = 1 << 15, term_col: str = "term") -> DataFrame:
    """``terms`` with the ``bucket`` that HashingTF puts each into: the stage itself hashes
    every term as a document of one word."""
    stage = HashingTF(inputCol="__word", outputCol="__vector", numFeatures=num_features)
    hashed = stage.transform(terms.withColumn("__word", F.array(F.col(term_col))))
    return hashed.withColumn("bucket", F.unwrap_udt(F.col("__vector"))["indices"][0]).drop("__word", "__vector")


def bucket_collisions(term_counts: DataFrame, num_features: int = 1 << 15) -> DataFrame:
    """``(bucket, n_terms, most, total)`` of the buckets' terms, from ``(term, n_docs)``:
    a bucket's frequency lies between its most frequent term's and the sum of all."""
    return term_buckets(term_counts, num_features).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n_terms"), F.max("n_docs").alias("most"), F.sum("n_docs").alias("total"))


# --------------------------------------------------------------------------
# term-level forms
# --------------------------------------------------------------------------

def doc_terms(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              drop_stop_words: bool = True) -> DataFrame:
    """``(id, terms)``: ML-identical tokens, stop words removed by default."""
    tokens = tokenize(text_col)
    terms = remove_stop_words(tokens) if drop_stop_words else tokens
    rows = spread(docs.where(F.col(text_col).isNotNull()).select(id_col, text_col))
    return rows.select(F.col(id_col), terms.alias("terms"))


def _marked_tf(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, term, tf)`` plus one ``(id, NULL, 1)`` marker row per document.

    The marker's document frequency is the number of documents (those with
    no term left included), so the IDF's document count comes out of the
    same aggregation instead of a second scan of the text column.
    Exploded tokens are combined per task before the shuffle (partial
    aggregation): a long document or a hot term costs one row per
    (document, term) on the wire. ``explode_outer`` keeps Catalyst from
    inferring ``size(terms) > 0`` and pushing the tokenisation below the
    repartition (which would tokenise every document twice)."""
    terms = doc_terms(docs, id_col, text_col)
    marked = F.concat(F.array(F.lit(None).cast("string")), F.col("terms"))
    return (
        terms.select(F.col(id_col), F.explode_outer(marked).alias("term"))
        .groupBy(id_col, "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def term_frequencies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, term, tf)`` for every document and term."""
    return _marked_tf(docs, id_col, text_col).where(F.col("term").isNotNull())


def _marked_counts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(term, n_occurrences, n_docs)`` and a row of the null term, whose ``n_docs`` is the
    number of documents (rows of one id are one document).

    A row whose id no other has is a document by itself: its terms and its distinct terms
    are counted per task before the shuffle, which then carries a task's vocabulary and
    not a row for each document and term. Only rows that share an id are put together by
    ``(id, term)`` first; whether there are any is found from the ids alone (one job)."""
    texts = docs.where(F.col(text_col).isNotNull())
    shared = texts.groupBy(F.col(id_col).alias("__id")).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select("__id")
    any_shared = not shared.isEmpty()
    same = docs[id_col].eqNullSafe(shared["__id"])
    terms = doc_terms(docs.join(shared, same, "left_anti") if any_shared else docs, id_col, text_col)

    def part(term, occurrences: int, documents: int):
        return F.struct(term.alias("term"), F.lit(occurrences).cast("long").alias("n_occurrences"),
                        F.lit(documents).cast("long").alias("n_docs"))

    parts = F.concat(F.array(part(F.lit(None).cast("string"), 0, 1)),
                     F.transform(F.array_distinct("terms"), lambda t: part(t, 0, 1)),
                     F.transform("terms", lambda t: part(t, 1, 0)))
    rows = terms.select(F.explode_outer(parts).alias("p")).select("p.*")   # outer: see _marked_tf
    if any_shared:
        tf = _marked_tf(docs.join(shared, same, "left_semi"), id_col, text_col)
        rows = rows.union(tf.select("term", "tf", F.lit(1).cast("long")))
    return rows.groupBy("term").agg(F.sum("n_occurrences").alias("n_occurrences"), F.sum("n_docs").alias("n_docs"))


def corpus_term_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(term, n_occurrences, n_docs)`` over the whole corpus."""
    return _real_terms(_marked_counts(docs, id_col, text_col), "n_docs")


def _real_terms(df: DataFrame, count_col: str) -> DataFrame:
    """Drop the marker rows above the aggregation that produced ``df``.

    The predicate also reads the aggregate's output (``count_col >= 1``
    always), so Catalyst keeps it above the aggregation; a plain
    ``term IS NOT NULL`` would be pushed below it, and this branch's shuffle
    would no longer be the one the marker-reading branch reuses (the corpus
    would be tokenised twice)."""
    keep = F.when(F.col("term").isNull(), F.lit(False)).otherwise(F.col(count_col) > 0)
    return df.where(keep)


def _idf_from_marked(marked: DataFrame, min_doc_freq: int, n_docs: int | None = None) -> DataFrame:
    # count_if(tf > 0) equals count(*) (tf >= 1) but keeps the tf column alive
    # (count(tf) would be rewritten to count(1) and tf pruned), so this branch
    # and a join back to the term frequencies share one shuffle (ReusedExchange)
    return _idf_weights(marked.groupBy("term").agg(F.count_if(F.col("tf") > 0).alias("df")), min_doc_freq, n_docs)


def _idf_weights(freq: DataFrame, min_doc_freq: int, n_docs: int | None = None) -> DataFrame:
    """``(term, df, idf)`` from ``(term, df)`` with the marker row."""
    if n_docs is None:
        # the marker row's frequency, as a filter-free scalar subquery over the
        # same (reused) aggregate
        n = freq.select(F.max(F.when(F.col("term").isNull(), F.col("df")))).scalar()
    else:
        n = F.lit(n_docs)
    df_col = F.col("df")
    idf = F.when(df_col >= F.lit(min_doc_freq),
                 F.log((n.cast("double") + 1.0) / (df_col + 1.0))).otherwise(F.lit(0.0))
    return _real_terms(freq, "df").withColumn("idf", idf)


def idf_table(docs: DataFrame, min_doc_freq: int = 5, id_col: str = "doc_id",
              text_col: str = "text", n_docs: int | None = None) -> DataFrame:
    """``(term, df, idf)`` with Spark ML's ``ln((n+1)/(df+1))``, 0 below
    ``min_doc_freq``; ``n`` counts every document with non-null text."""
    counts = _marked_counts(docs, id_col, text_col)
    return _idf_weights(counts.select("term", F.col("n_docs").alias("df")), min_doc_freq, n_docs)


def tfidf(docs: DataFrame, min_doc_freq: int = 5, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``(id, term, tf, idf, tfidf)`` per document and term.

    Term frequencies, document frequencies and the document count all come
    from one tokenisation and one shuffle (reused by every branch). Only
    terms with a non-zero weight are joined (rare terms get 0), which keeps
    the join side small."""
    marked = _marked_tf(docs, id_col, text_col)
    tf = _real_terms(marked, "tf")
    idf = _idf_from_marked(marked, min_doc_freq).where(F.col("idf") > 0)
    # The join key is an expression over the aggregate's output (df >= 1, so
    # it equals term): the join's inferred ``term IS NOT NULL`` then stays
    # above the aggregation instead of being pushed into the shared branch.
    weights = idf.select(F.when(F.col("df") > 0, F.col("term")).alias("term"), "idf")
    # No hint and no eager count: AQE materialises the weights stage first and
    # broadcasts it only if its measured size is under the broadcast threshold;
    # otherwise it stays a sort-merge join whose hot-term partitions the
    # skew-join rule splits.
    joined = tf.join(weights, "term", "left")
    weight = F.coalesce(F.col("idf"), F.lit(0.0))
    return joined.select(id_col, "term", "tf", weight.alias("idf"), (F.col("tf") * weight).alias("tfidf"))


def top_tfidf(docs: DataFrame, k: int = 100, min_doc_freq: int = 5, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """The ``k`` highest (document, term) TF-IDF weights; ties by id, term.
    No global sort, and a final merge of about k*k rows (see ``top_k``)."""
    return top_k(tfidf(docs, min_doc_freq, id_col, text_col), k, "tfidf", id_col, "term")
