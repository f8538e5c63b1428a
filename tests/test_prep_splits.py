import os

import pytest

from conftest import SF01
from textflow.operators.prep import (
    binarise_label,
    cap_rows,
    ensure_text_column,
    sample_rows,
    split_null_text,
    trim_text,
)
from textflow.operators.profile import class_balance_rows, profile_labelled, validate_input
from textflow.operators.splits import keyed_splits, random_splits, split_sizes, with_folds, with_split
from textflow.schemas import parse_schema
from textflow.sources.corpus import check_arity, read_labelled_csv


def test_binarise_label(spark):
    df = spark.createDataFrame([("4",), ("0",), ("2",), (None,), ("x",)], "polarity string")
    got = [r[0] for r in df.select(binarise_label("polarity")).collect()]
    assert got == [1, 0, 0, None, None]


def test_csv_reader_handles_quotes_commas_and_nulls(spark, tmp_dir):
    path = os.path.join(tmp_dir, "corpus.csv")
    lines = [
        '4,1,"Mon Apr 06 22:19:45 PDT 2009",NO_QUERY,u1,"Not bad, could be better"',
        '0,2,"d",NO_QUERY,u2,"@x is ""bummer"" today"',
        '2,3,"d",NO_QUERY,u3,"  padded   text  "',
        ',4,"d",NO_QUERY,u4,',
    ]
    with open(path, "w", encoding="utf-8") as handle:
        handle.write("\n".join(lines) + "\n")
    df = trim_text(read_labelled_csv(spark, path, keep=("id",)))
    rows = {r["id"]: r for r in df.collect()}
    assert rows[1]["label"] == 1 and rows[1]["text"] == "Not bad, could be better"
    assert rows[2]["label"] == 0 and rows[2]["text"] == '@x is "bummer" today'
    assert rows[3]["label"] == 0 and rows[3]["text"] == "padded   text"
    assert rows[4]["label"] is None and rows[4]["text"] is None
    valid, nulls = split_null_text(df)
    assert valid.count() == 3 and nulls.count() == 1
    profile = profile_labelled(df).first()
    assert (profile["total_rows"], profile["pos_count"], profile["neg_count"], profile["null_text_count"]) == (4, 1, 2, 1)


def test_check_arity_fails_early(spark, tmp_dir):
    path = os.path.join(tmp_dir, "two.csv")
    with open(path, "w") as handle:
        handle.write("I love this!,1\n")
    with pytest.raises(ValueError, match="columns"):
        check_arity(spark, path)


def test_validate_input_rejects_empty(spark):
    empty = spark.createDataFrame([], "label int, text string")
    with pytest.raises(ValueError, match="empty"):
        validate_input(empty)


def test_class_balance_rows(spark):
    df = spark.createDataFrame([(1, "a"), (0, "b"), (1, "c")], "label int, text string")
    rows = {r["name"]: r["value"] for r in class_balance_rows(profile_labelled(df), "run1").collect()}
    assert rows == {"pos_count": 2.0, "neg_count": 1.0, "total_rows": 3.0}


def test_keyed_splits_disjoint_exhaustive_and_stable(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id")
    train, val, test = keyed_splits(docs, "doc_id")
    ids = [set(r[0] for r in d.collect()) for d in (train, val, test)]
    assert not (ids[0] & ids[1]) and not (ids[0] & ids[2]) and not (ids[1] & ids[2])
    assert len(ids[0] | ids[1] | ids[2]) == docs.count()
    again = keyed_splits(docs.repartition(7), "doc_id")[0]
    assert set(r[0] for r in again.collect()) == ids[0]
    sizes = {r["split"]: r["n_rows"] for r in split_sizes(with_split(docs, "doc_id")).collect()}
    assert sum(sizes.values()) == docs.count()
    _, val0, _ = keyed_splits(docs, "doc_id", val_ratio=0.0)
    assert set(r[0] for r in val0.collect()) == set(r[0] for r in keyed_splits(docs, "doc_id", val_ratio=0.0)[0].collect())


def test_random_splits_disjoint_exhaustive(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id").cache()
    parts = random_splits(docs)
    ids = [set(r[0] for r in d.collect()) for d in parts]
    assert sum(len(s) for s in ids) == docs.count() == len(ids[0] | ids[1] | ids[2])
    docs.unpersist()


def test_folds_cover_all_rows(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id")
    folds = with_folds(docs, "doc_id", 3).groupBy("fold").count().collect()
    assert sorted(r["fold"] for r in folds) == [0, 1, 2]
    assert sum(r["count"] for r in folds) == docs.count()


def test_sampling_and_cap(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id")
    assert sample_rows(docs, 1.0) is docs
    keyed = sample_rows(docs, 0.3, key="doc_id")
    assert set(r[0] for r in keyed.collect()) == set(r[0] for r in sample_rows(docs.repartition(5), 0.3, key="doc_id").collect())
    assert 200 < keyed.count() < 400
    import hashlib

    def bucket(i):
        return int(hashlib.md5(f"{i}:cap".encode()).hexdigest()[:8], 16) % 10000

    want = sorted(range(docs.count()), key=lambda i: (bucket(i), i))[:10]
    assert sorted(r[0] for r in cap_rows(docs, 10, key="doc_id").collect()) == sorted(want)
    assert cap_rows(docs, 10).count() == 10
    assert cap_rows(docs, 10**6, key="doc_id").count() == docs.count()


def test_ensure_text_column(spark):
    one = spark.createDataFrame([("hi",)], "value string")
    assert ensure_text_column(one).columns == ["text"]
    two = spark.createDataFrame([("hi", 1)], "a string, b int")
    with pytest.raises(ValueError):
        ensure_text_column(two)


def test_parse_schema_forms(spark):
    ddl = parse_schema("text STRING, label INT")
    as_json = parse_schema(ddl.json())
    assert ddl == as_json and ddl.fieldNames() == ["text", "label"]
