"""Tables with everything that a column can hold, and brute-force helpers."""

import duckdb
import pandas as pd

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
TABLES = ("documents", "pages", "benchmark", "labels", "conversations", "embeddings")

LONG = " ".join(f"word{i % 977} of line" for i in range(40_000))
ODD_TEXTS = [
    (1, "Some plain text of a few words.\nA second line of the text."),
    (1, "Some plain text of a few words.\nA second line of the text."),   # a repeated row
    (2, None), (3, ""), (4, "   \n\t \r\n"), (5, LONG), (6, LONG + " end"),
    (None, "Some plain text of a few words.\nA second line of the text."),
    (None, None), (7, "żółć \U0001F600 ßÉİ   x"), (8, "a\x00b \x1c c"), (9, "Q" * 30),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that a careless operator would use itself.
CLASHING = ("row", "line", "size", "taken", "offset", "first", "words", "fp", "u", "range", "score", "label", "found", "pos", "id")


def odd_docs(spark, texts=ODD_TEXTS, clashing=True):
    rows = [(i, t, None if k % 5 == 0 else "en", None if k % 4 == 0 else f"s{k % 3}", None if t is None else len(t))
            for k, (i, t) in enumerate(texts)]
    df = spark.createDataFrame(rows, SCHEMA)
    if clashing:
        from pyspark.sql import functions as F

        for k, name in enumerate(CLASHING):
            df = df.withColumn(name, F.lit(k))
        df = df.withColumn("a.b", F.lit("dotted"))
    return df


def duck(sf=SF001):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def oracle_rows(sql, sf=SF001):
    cur = duck(sf).execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), sorted((tuple(_plain(r[i]) for i in order) for r in cur.fetchall()), key=repr)


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted((tuple(_plain(r[n]) for n in names) for r in df.collect()), key=repr)


def _plain(v):
    return round(v, 6) if isinstance(v, float) else v


def documents(sf=SF001):
    return pd.read_parquet(f"{sf}/documents.parquet")
