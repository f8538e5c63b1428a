import zlib

import pandas as pd

from helpers import SF01, odd_docs
from pyspark.sql import functions as F
from textflow.llm import toxicity as tx


def test_folding():
    assert tx.fold("ІDІ0T!! 1d10t mor0n$$$ пoser st\u200bupid $cum a1 7th") == ["idiot", "idiot", "moron", "пoser", "stupid", "scum", "a", "tth"]
    assert tx.fold(None) == tx.fold("  \n 12 !! ") == []
    assert tx.fold("ｆｏｏ–bar") == ["foo", "bar"]


def test_folding_of_runs_edges_and_styled_letters():
    assert tx.fold("l053r \"5cum (1diot id1o7 @55h0le") == ["loser", "scum", "idiot", "idiot", "asshole"]
    assert tx.fold("ïdïöt \U0001d422\U0001d41d\U0001d422\U0001d428\U0001d42d ⓘⓓⓘⓞⓣ ＩＤＩＯＴ İdiot") == ["idiot"] * 5
    assert tx.fold("й が für") == ["й", "が", "fur"]


def test_signs_match_by_any_reading():
    made = tx.Lexicon({" clown ": 2.0, " idiot ": 5.0, " silly ": 3.0, " scun": 4.0, " scunthorpe ": 0.0}).automaton()
    for text in ("c1own", "c|own!", "«c10wn»"):
        assert tx.matched(made, text) > 1.9
    for text in ("1d1o7", "(1diot", "idiot1", "100idiot", "idiot!!!", "$idiot$", "idiot!!!you", "x!!!idiot"):
        assert tx.matched(made, text) > 4.9
    assert tx.matched(made, "s1!1y s1lly") > 5.8
    assert tx.matched(made, "5cunthorpe") == 0.0 < tx.matched(made, "5cunner")
    assert tx.matched(made, "a" + "1" * 5000) == tx.matched(made, "1" * 5000) == 0.0
    # a plain letter is itself only
    assert tx.matched(made, "ciown ciown1 sliiy") == 0.0


def test_exception_phrases_and_length():
    lexicon = tx.Lexicon({" scun": 3.0, " scunthorpe ": 0.0, " idiot ": 5.0})
    made = lexicon.automaton()
    assert tx.matched(made, "Scunthorpe") == 0.0
    assert tx.matched(made, "scunner idiot IDIOT") > tx.matched(made, "scunner idiot IDIOT" + " and" * 500) > 0
    assert tx.matched(tx.Lexicon({}).automaton(), "idiot") == tx.matched(made, None) == 0.0


def test_held_out_accuracy(spark):
    rows = tx.op9_toxicity(spark, SF01).toPandas()
    docs = pd.read_parquet(f"{SF01}/documents.parquet")
    assert sorted(rows.doc_id) == sorted(docs.doc_id) and rows.score.between(0, 1).all()
    assert (rows.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in rows.doc_id]).all()
    assert (rows.predicted == (rows.score >= 0.3)).all()
    held = rows[rows.held_out].merge(pd.read_parquet(f"{SF01}/labels.parquet"), on="doc_id")
    assert (held.predicted == held.toxic).mean() > 0.9
    # labels of held-out rows have no say
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    turned = labels.withColumn("toxic", F.when(tx.is_training_row(), F.col("toxic")).otherwise(1 - F.col("toxic")))
    source = spark.read.parquet(f"{SF01}/documents.parquet")
    assert tx.learn(source, labels) == tx.learn(source, turned)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    texts = [(1000 + i, ("you idiot fool " if i % 3 == 0 else "nice kind day ") + f"w{i % 7} x{i % 5}") for i in range(200)]
    train = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(t.startswith("you"))) for i, t in texts] + [(1000, None), (None, 1), (7, 5)], "doc_id long, toxic int")
    all_docs = docs.unionByName(train, allowMissingColumns=True)
    kept = tx.drop_toxic(all_docs, labels)
    assert kept.columns == all_docs.columns
    assert kept.where("text LIKE 'you%'").count() == 0
    assert kept.where("doc_id < 1000 OR doc_id IS NULL").count() == docs.count()
    assert kept.where("text LIKE 'nice%'").count() == 133
    assert tx.drop_toxic(all_docs.limit(0), labels).count() == 0
    assert tx.drop_toxic(docs, labels.limit(0)).count() == docs.count()
