"""Plans over the labelled corpus and its text: prep, profile, splits, tokens,
term statistics, hashed features, JSON and flag handling."""

from __future__ import annotations

from pyspark.ml.feature import IDF
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textflow.functions.keyed import keyed_bucket_sql
from textflow.functions.payload import TRUE_FLAGS, decode_kafka_frame, flag_column, pack_json
from textflow.functions.text import (
    default_stop_words,
    remove_stop_words,
    sql_string_list,
    tokenize,
    tokenize_sql,
)
from textflow.operators import features as feat
from textflow.operators.layout import spread
from textflow.operators.prep import cap_rows, labelled_from_raw, sample_rows, trim_text
from textflow.operators.profile import profile_labelled
from textflow.operators.splits import split_sizes, with_folds, with_split
from textflow.plans.catalog import plan, r6, table
from textflow.session import scratch_path
from textflow.sources.corpus import corrupt_rows, read_labelled_csv, write_raw_corpus

STOP_SQL = sql_string_list(default_stop_words())  # fixed text: no session needed
TOKENS_SQL = tokenize_sql("text")
FILTERED_SQL = f"list_filter({TOKENS_SQL}, lambda t: NOT list_contains([{STOP_SQL}], lower(t)))"

# Test values of the plans (not reference values).
SAMPLE_FRACTION = 0.3
ROW_CAP = 50000
SMALL_CAP = 100
CV_FOLDS = 2
MIN_DOC_FREQ = 5
TOP_K = 100


def raw_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents joined with labels in the six-column corpus shape
    (``polarity = quality * 4``)."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    return docs.join(labels, "doc_id").select(
        (F.col("quality") * 4).cast("string").alias("polarity"),
        F.col("doc_id").alias("id"),
        F.lit(None).cast("string").alias("date"),
        F.col("lang").alias("query"),
        F.col("source").alias("user"),
        F.col("text"),
    )


def labelled_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, label, text)`` -- the prepared labelled corpus."""
    prepared = trim_text(labelled_from_raw(raw_corpus(spark, sf_dir), keep=("id",)))
    return prepared.withColumnRenamed("id", "doc_id")


LABELLED_SQL = """
SELECT d.doc_id AS doc_id,
       CAST((l.quality * 4) = 4 AS INTEGER) AS label,
       trim(d.text) AS text
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
"""


@plan("labelled_text", LABELLED_SQL)
def q_labelled_text(spark, sf_dir):
    return labelled_text(spark, sf_dir)


@plan("labelled_csv_scan", LABELLED_SQL)
def q_labelled_csv_scan(spark, sf_dir):
    """The corpus written as headerless CSV (quoted, doubled quotes, newlines
    in text) and read back with the explicit six-column schema."""
    path = scratch_path(spark, "corpus-csv")
    write_raw_corpus(raw_corpus(spark, sf_dir), path)
    df = read_labelled_csv(spark, path, keep=("id",), multi_line=True)
    return trim_text(df).withColumnRenamed("id", "doc_id")


@plan(
    "csv_corrupt_rows",
    """
    SELECT count(*) + count(*) FILTER (WHERE d.doc_id % 7 = 0) AS total_rows,
           count(*) FILTER (WHERE d.doc_id % 7 = 0) AS corrupt_rows
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id
    """,
)
def q_csv_corrupt_rows(spark, sf_dir):
    """The corpus as CSV with a ragged line for every seventh document, counted."""
    path = scratch_path(spark, "ragged-csv")
    raw = raw_corpus(spark, sf_dir).withColumn("text", F.translate("text", "\n", " "))
    write_raw_corpus(raw, path)
    cut = F.when(F.col("id") % 2 == 0, F.lit("4,x")).otherwise(F.lit("0,1,d,q,u,text,one,more"))
    raw.where(F.col("id").cast("long") % 7 == 0).select(cut.alias("value")).write.mode("append").text(path)
    return corrupt_rows(spark, path)


@plan(
    "input_profile",
    f"""
    WITH t AS ({LABELLED_SQL})
    SELECT count(*) AS total_rows,
           count(*) FILTER (WHERE label = 1) AS pos_count,
           count(*) FILTER (WHERE label = 0) AS neg_count,
           count(*) FILTER (WHERE label IS NULL) AS null_label_count,
           count(*) FILTER (WHERE text IS NULL) AS null_text_count,
           count(*) FILTER (WHERE trim(text) = '') AS empty_text_count
    FROM t
    """,
)
def q_input_profile(spark, sf_dir):
    return profile_labelled(labelled_text(spark, sf_dir))


@plan(
    "keyed_split_sizes",
    f"""
    SELECT split, count(*) AS n_rows FROM (
      SELECT CASE WHEN {keyed_bucket_sql('doc_id')} < 8000 THEN 'train'
                  WHEN {keyed_bucket_sql('doc_id')} < 9000 THEN 'val'
                  ELSE 'test' END AS split
      FROM documents) GROUP BY split
    """,
)
def q_keyed_split_sizes(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return split_sizes(with_split(docs, "doc_id", 0.8, 0.1, seed=42))


@plan(
    "keyed_folds",
    f"""
    SELECT CAST({keyed_bucket_sql('doc_id', 'fold:42')} % {CV_FOLDS} AS INTEGER) AS fold,
           count(*) AS n_rows
    FROM documents GROUP BY 1
    """,
)
def q_keyed_folds(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return with_folds(docs, "doc_id", CV_FOLDS, seed=42).groupBy("fold").agg(F.count(F.lit(1)).alias("n_rows"))


@plan(
    "keyed_sample",
    f"""
    SELECT doc_id, lang, n_chars FROM documents
    WHERE {keyed_bucket_sql('doc_id', 'sample:42')} < {int(round(SAMPLE_FRACTION * 10000))}
    """,
)
def q_keyed_sample(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return sample_rows(docs, SAMPLE_FRACTION, seed=42, key="doc_id")


@plan(
    "row_cap",
    f"""
    SELECT doc_id, lang, n_chars FROM documents
    ORDER BY {keyed_bucket_sql('doc_id', 'cap')}, doc_id LIMIT {ROW_CAP}
    """,
)
def q_row_cap(spark, sf_dir):
    """Deterministic cap of ``ROW_CAP`` rows (the quick preset's limit)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return cap_rows(docs, ROW_CAP, key="doc_id")


@plan(
    "row_cap_small",
    f"""
    SELECT doc_id, lang, n_chars FROM documents
    ORDER BY {keyed_bucket_sql('doc_id', 'cap')}, doc_id LIMIT {SMALL_CAP}
    """,
)
def q_row_cap_small(spark, sf_dir):
    """A cap below the size of any test table, so rows are dropped."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return cap_rows(docs, SMALL_CAP, key="doc_id")


@plan(
    "token_counts",
    f"""
    SELECT doc_id, CAST(len(tk) AS INTEGER) AS n_tokens,
           CAST(len(list_distinct(tk)) AS INTEGER) AS n_distinct_tokens
    FROM (SELECT doc_id, {TOKENS_SQL} AS tk FROM documents WHERE text IS NOT NULL)
    """,
)
def q_token_counts(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents").where(F.col("text").isNotNull()).select("doc_id", "text"))
    tokens = docs.select("doc_id", tokenize("text").alias("tokens"))
    return tokens.select(
        "doc_id", F.size("tokens").alias("n_tokens"), F.size(F.array_distinct("tokens")).alias("n_distinct_tokens")
    )


@plan(
    "stopword_filtered",
    f"""
    SELECT doc_id, CAST(len(f) AS INTEGER) AS n_kept,
           CAST(len(tk) - len(f) AS INTEGER) AS n_removed,
           CAST(coalesce(list_sum(list_transform(f, lambda x: length(x))), 0) AS BIGINT) AS kept_chars
    FROM (SELECT doc_id, {TOKENS_SQL} AS tk, {FILTERED_SQL} AS f FROM documents WHERE text IS NOT NULL)
    """,
)
def q_stopword_filtered(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents").where(F.col("text").isNotNull()).select("doc_id", "text"))
    tokens = docs.select("doc_id", tokenize("text").alias("tokens"))
    kept = tokens.select("doc_id", "tokens", remove_stop_words("tokens").alias("kept"))
    kept_chars = F.aggregate("kept", F.lit(0).cast("bigint"), lambda acc, t: acc + F.length(t))
    return kept.select(
        "doc_id",
        F.size("kept").alias("n_kept"),
        (F.size("tokens") - F.size("kept")).alias("n_removed"),
        kept_chars.alias("kept_chars"),
    )


TERM_TF_SQL = f"""
    SELECT doc_id, term, count(*) AS tf
    FROM (SELECT doc_id, unnest({FILTERED_SQL}) AS term FROM documents WHERE text IS NOT NULL)
    GROUP BY doc_id, term
"""


@plan(
    "term_tf",
    f"""
    SELECT term, CAST(sum(tf) AS BIGINT) AS n_occurrences, count(*) AS n_docs
    FROM ({TERM_TF_SQL}) GROUP BY term
    """,
)
def q_term_tf(spark, sf_dir):
    return feat.corpus_term_counts(table(spark, sf_dir, "documents"))


IDF_SQL = f"""
    SELECT term, count(*) AS df,
           CASE WHEN count(*) >= {MIN_DOC_FREQ}
                THEN ln(((SELECT count(*) FROM documents WHERE text IS NOT NULL) + 1.0) / (count(*) + 1.0))
                ELSE 0.0 END AS idf
    FROM ({TERM_TF_SQL}) GROUP BY term
"""


@plan("term_df_idf", f"SELECT term, df, round(idf, 6) AS idf FROM ({IDF_SQL})")
def q_term_df_idf(spark, sf_dir):
    idf = feat.idf_table(table(spark, sf_dir, "documents"), MIN_DOC_FREQ)
    return idf.select("term", "df", r6("idf").alias("idf"))


@plan("bucket_frequencies", f"SELECT term, df AS n_docs, TRUE AS between, TRUE AS as_fitted, TRUE AS counted FROM ({IDF_SQL})")
def q_bucket_frequencies(spark, sf_dir):
    """Every term with its hash bucket's figures checked: the bucket's document frequency
    lies between its terms' greatest and their sum (equal to it without collisions), and
    is what the fitted IDF holds for the bucket."""
    docs = table(spark, sf_dir, "documents").where("text IS NOT NULL")
    hashed = feat.hashing_model().transform(docs).select("rawFeatures")
    path = scratch_path(spark, "hashed")
    hashed.write.parquet(path)
    hashed = spark.read.parquet(path)
    fitted = IDF(inputCol="rawFeatures", outputCol="features", minDocFreq=MIN_DOC_FREQ).fit(hashed)
    # a row for each of the 2^15 buckets
    model = spark.createDataFrame([(k, int(n)) for k, n in enumerate(fitted.docFreq)], "bucket int, fitted_df long")
    buckets = feat.bucket_frequencies(hashed).join(model, "bucket").withColumnRenamed("df", "bucket_df")
    # read by two branches below, which would each tokenise the corpus: a row for each term
    counted = scratch_path(spark, "terms")
    feat.corpus_term_counts(table(spark, sf_dir, "documents")).select("term", "n_docs").write.parquet(counted)
    terms = spark.read.parquet(counted)
    shared = feat.bucket_collisions(terms)
    told = feat.term_buckets(terms).join(shared, "bucket").join(buckets, "bucket")
    kept = F.when(F.col("bucket_df") >= MIN_DOC_FREQ, F.col("bucket_df")).otherwise(0)   # the model holds 0 below it
    alone = (F.col("n_terms") > 1) | (F.col("bucket_df") == F.col("n_docs"))
    return told.select("term", "n_docs", F.col("bucket_df").between(F.col("most"), F.col("total")).alias("between"),
                       (F.col("fitted_df") == kept).alias("as_fitted"), alone.alias("counted"))


@plan(
    "top_tfidf",
    f"""
    SELECT doc_id, term, tf, round(idf, 6) AS idf, round(tfidf, 6) AS tfidf FROM (
      SELECT t.doc_id, t.term, t.tf, coalesce(i.idf, 0.0) AS idf, t.tf * coalesce(i.idf, 0.0) AS tfidf
      FROM ({TERM_TF_SQL}) t LEFT JOIN ({IDF_SQL}) i ON t.term = i.term
      ORDER BY tfidf DESC, t.doc_id, t.term LIMIT {TOP_K})
    """,
)
def q_top_tfidf(spark, sf_dir):
    top = feat.top_tfidf(table(spark, sf_dir, "documents"), TOP_K, MIN_DOC_FREQ)
    return top.select("doc_id", "term", "tf", r6("idf").alias("idf"), r6("tfidf").alias("tfidf"))


@plan(
    "hashed_features",
    f"""
    SELECT doc_id, CAST(len(tk) AS INTEGER) AS n_tokens, CAST(len(f) AS INTEGER) AS n_filtered,
           CAST(len(f) AS DOUBLE) AS tf_total
    FROM (SELECT doc_id, {TOKENS_SQL} AS tk, {FILTERED_SQL} AS f FROM documents WHERE text IS NOT NULL)
    """,
)
def q_hashed_features(spark, sf_dir):
    """The ML stages (Tokenizer, StopWordsRemover, HashingTF 2^15, IDF fitted
    on the corpus). Hash-independent columns only, so the SQL check holds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = feat.hashed_features(docs, 1 << 15, MIN_DOC_FREQ)
    return out.select("doc_id", "n_tokens", "n_filtered", feat.vector_total("rawFeatures").alias("tf_total"))


# --- JSON / Kafka payloads ------------------------------------------------

def kafka_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka-shaped rows (``value`` binary, ``timestamp``) built from documents:
    English as JSON with text, French as plain text, German as JSON without a
    text field, Spanish as malformed JSON."""
    docs = table(spark, sf_dir, "documents")
    lang = F.col("lang")
    value = (
        F.when(lang == "en", F.to_json(F.struct(F.col("text"), F.col("doc_id").cast("string").alias("id"))))
        .when(lang == "de", F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"))))
        .when(lang == "es", F.concat(F.lit("{"), F.col("text")))
        .otherwise(F.col("text"))
    )
    return docs.select("doc_id", value.cast("binary").alias("value"),
                       F.lit(None).cast("timestamp").alias("timestamp"))


@plan(
    "kafka_decode",
    """
    SELECT doc_id,
           CASE WHEN lang = 'en' THEN text
                WHEN lang = 'de' THEN '{"id":"' || CAST(doc_id AS VARCHAR) || '"}'
                WHEN lang = 'es' THEN '{' || text
                ELSE text END AS text
    FROM documents
    """,
)
def q_kafka_decode(spark, sf_dir):
    # the function the Kafka stream uses, with the id carried as the message key
    msgs = kafka_messages(spark, sf_dir)
    return decode_kafka_frame(msgs, keep=("doc_id",)).select("doc_id", "text")


@plan(
    "json_pack",
    """
    SELECT d.doc_id,
           '{"doc_id":' || CAST(d.doc_id AS VARCHAR) || ',"label":' || CAST(l.quality AS VARCHAR)
             || ',"lang":"' || d.lang || '","n_chars":' || CAST(d.n_chars AS VARCHAR) || '}' AS value
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id
    """,
)
def q_json_pack(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    rows = docs.join(labels, "doc_id").select("doc_id", F.col("quality").alias("label"), "lang", "n_chars")
    return rows.select("doc_id", F.to_json(F.struct("doc_id", "label", "lang", "n_chars")).alias("value"))


@plan(
    "json_parse",
    """
    SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, event_type
    FROM events
    """,
)
def q_json_parse(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    parsed = F.from_json("props", "k INT")
    return events.select("event_id", parsed.getField("k").alias("k"), "event_type")


@plan(
    "json_roundtrip",
    """
    SELECT d.doc_id, d.text, l.quality AS label
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id
    """,
)
def q_json_roundtrip(spark, sf_dir):
    """Pack rows (text with quotes, newlines, accents) to JSON and parse them back."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    rows = docs.join(labels, "doc_id").select("doc_id", "text", F.col("quality").alias("label"))
    packed = pack_json(rows)
    return packed.select(F.from_json("value", "doc_id BIGINT, text STRING, label INT").alias("r")).select("r.*")


@plan(
    "flag_parse",
    f"""
    SELECT doc_id,
           lower(trim(CAST(toxic AS VARCHAR))) IN ({sql_string_list(TRUE_FLAGS)}) AS is_toxic,
           lower(trim(CASE WHEN quality = 1 THEN 'Yes' ELSE 'no' END)) IN ({sql_string_list(TRUE_FLAGS)}) AS is_quality
    FROM labels
    """,
)
def q_flag_parse(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    word = F.when(F.col("quality") == 1, F.lit("Yes")).otherwise(F.lit("no"))
    return labels.select(
        "doc_id",
        flag_column(F.col("toxic").cast("string")).alias("is_toxic"),
        flag_column(word).alias("is_quality"),
    )
