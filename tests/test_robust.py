"""Loading anywhere, rows that break a batch, and writes that may die half-way."""

import os
import subprocess
import sys
import threading

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import Tokenizer
from pyspark.sql import functions as F

from conftest import SF001
from textflow.operators import evaluate as ev
from textflow.operators.prep import cap_rows
from textflow.operators.registry import Registry
from textflow.streaming import sinks
from textflow.streaming.scorers import NearestCentroidModel, PythonModelScorer, TextLengthModel
from textflow.streaming.serving import BatchScorer, ServingConfig, _query_id

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

NO_JARS = """
import builtins, glob, os, sys, zipfile
sys.path.insert(0, %r)
hidden = lambda p: "jars" in str(p)
real_open, real_glob, real_list = builtins.open, glob.glob, os.listdir
def refuse(real):
    def call(p, *a, **k):
        if hidden(p):
            raise FileNotFoundError(p)
        return real(p, *a, **k)
    return call
builtins.open, os.listdir, zipfile.ZipFile = refuse(real_open), refuse(real_list), None
glob.glob = lambda p, *a, **k: [] if hidden(p) else real_glob(p, *a, **k)
import __spark_entry__ as e
print(len(e.queries()), len(e.oracle_sql()))
"""


def test_plans_load_without_jars_or_a_session(tmp_dir):
    out = subprocess.run([sys.executable, "-c", NO_JARS % REPO], cwd=tmp_dir, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    assert int(out.stdout.split()[0]) >= 50


ELSEWHERE = """
import sys
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
sys.path.insert(0, %r)   # after the session: its workers do not get it
import __spark_entry__ as e
for name in ("udf_score", "saved_python_model", "stream_json_readback"):
    rows = e.queries()[name](spark, %r).collect()
    assert len(rows) > 100 and {r["prediction"] for r in rows} <= {0.0, 1.0}, name
print("done")
"""


def test_python_models_run_where_the_package_is_not_importable(tmp_dir):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", ELSEWHERE % (REPO, SF001)], cwd=tmp_dir, env=env,
                         capture_output=True, text=True, timeout=300)
    assert out.stdout.endswith("done\n"), out.stderr[-2000:]


def test_centroid_model_uses_all_columns(spark):
    rows = spark.createDataFrame([(1, "a", 10, 0), (2, "bb", 12, 0), (3, "ccc", 90, 1), (4, None, 95, 1)],
                                 "doc_id long, text string, n int, label int")
    model = NearestCentroidModel.fit(rows, ("n",), "label")
    got = {r["doc_id"]: r["prediction"] for r in PythonModelScorer(model).score(rows).collect()}
    assert got == {1: 0.0, 2: 0.0, 3: 1.0, 4: 1.0}


def test_null_text_is_written_with_a_null_prediction(spark, tmp_dir):
    cfg = ServingConfig(output_path=f"{tmp_dir}/out", checkpoint="unused", query_id="q", passthrough=("id",),
                        metrics_path=f"{tmp_dir}/metrics")
    handler = BatchScorer(cfg)
    handler.holder.set(PythonModelScorer(TextLengthModel(3), ("text",)), "v1", None)
    batch = spark.createDataFrame([(1, "good"), (2, None), (3, "x")], "id int, text string").withColumn(
        "ingest_time", F.current_timestamp())
    handler(batch, 0)
    handler(batch.limit(0), 1)   # an empty batch is skipped
    out = {r["id"]: r["prediction"] for r in spark.read.parquet(cfg.output_path).collect()}
    assert out == {1: 1.0, 2: None, 3: 0.0}
    assert [(m["batch_rows"], m["written_rows"], m["null_text_rows"]) for m in handler.history] == [(3, 3, 1)]


def test_a_query_without_an_id_raises(spark):
    with pytest.raises(ValueError, match="query_id"):
        _query_id(spark, None)
    assert _query_id(spark, "mine") == "mine"


def test_only_a_missing_table_is_empty(spark, tmp_dir):
    registry = Registry(spark, f"{tmp_dir}/r")
    assert registry.table("model_versions").count() == 0
    model = PipelineModel([Tokenizer(inputCol="text", outputCol="t")])
    assert registry.register_model("m", model)[0] == "1"
    real = registry.path
    registry.path = lambda name: f"nosuchscheme://x/{name}"   # the table cannot be read
    with pytest.raises(Exception):
        registry.register_model("m", model)
    registry.path = real
    assert registry.register_model("m", model)[0] == "2"


def test_two_trainings_do_not_share_a_version(spark, tmp_dir):
    registry = Registry(spark, f"{tmp_dir}/r")
    got = []
    threads = [threading.Thread(target=lambda: got.append(registry._claim("m", 1))) for _ in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(set(got)) == 8 and min(got) >= 1


def test_compaction_goes_on_from_a_finished_stage(spark, tmp_dir):
    path = f"{tmp_dir}/p"
    rows = spark.range(20).select(F.col("id"), F.lit(1.0).alias("prediction"), F.lit("2024-01-01").alias("date"),
                                  F.lit("q").alias("query_id"), (F.col("id") % 4).alias("batch_id"))
    sinks.write_predictions(rows, path)
    # died after the stage was written and half of the date was deleted
    rows.drop("date", "query_id", "batch_id").write.parquet(f"{path}/_compacting/date=2024-01-01")
    for k in (0, 1):
        os.rename(f"{path}/date=2024-01-01/query_id=q/batch_id={k}", f"{tmp_dir}/gone{k}")
    assert spark.read.parquet(path).count() == 10
    assert sinks.compact_date(spark, path, "2024-01-01") == 20
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == list(range(20))
    assert not os.path.exists(f"{path}/_compacting/date=2024-01-01")


def test_rows_outside_the_labels_stay_in_the_denominator(spark):
    rows = spark.createDataFrame([(0, 0.0), (1, 1.0), (2, 0.0), (1, 2.0), (None, 1.0)], "label int, prediction double")
    values = ev.metric_values(ev.confusion_row(rows))
    assert (values["accuracy"], values["n_rows"], values["n_other"], values["n_null"]) == (0.5, 4, 2, 1)
    assert ev.weighted_metrics(ev.confusion_row(rows)).first()["accuracy"] == 0.5


def test_cap_keeps_the_first_rows_without_a_sort(spark, capsys):
    df = spark.range(5000).withColumnRenamed("id", "doc_id")
    kept = {n: {r[0] for r in cap_rows(df, n, "doc_id").collect()} for n in (1, 10, 999, 5000, 9000)}
    assert {n: len(k) for n, k in kept.items()} == {1: 1, 10: 10, 999: 999, 5000: 5000, 9000: 5000}
    assert kept[1] < kept[10] < kept[999]
    cap_rows(df, 10, "doc_id").explain()
    assert "TakeOrdered" not in capsys.readouterr().out


def _murmur3(data: bytes, seed: int = 42) -> int:
    """MurmurHash3 (x86, 32 bits), from its published description."""
    m, h = 0xFFFFFFFF, seed
    rot = lambda x, r: ((x << r) | (x >> (32 - r))) & m
    mix = lambda k: rot(k * 0xCC9E2D51 & m, 15) * 0x1B873593 & m
    whole = len(data) // 4 * 4
    for i in range(0, whole, 4):
        h = (rot(h ^ mix(int.from_bytes(data[i:i + 4], "little")), 13) * 5 + 0xE6546B64) & m
    if data[whole:]:
        h ^= mix(int.from_bytes(data[whole:], "little"))
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & m
    h = (h ^ h >> 13) * 0xC2B2AE35 & m
    h ^= h >> 16
    return h - (1 << 32) if h >> 31 else h


def test_hashed_buckets_and_weights(spark):
    import math
    from collections import Counter

    from textflow.functions.text import remove_stop_words, tokenize
    from textflow.operators import features as feat

    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    terms = {r["doc_id"]: r["t"] for r in docs.select("doc_id", remove_stop_words(tokenize("text")).alias("t")).collect()}
    bucket = {t: _murmur3(t.encode()) % 4096 for ts in terms.values() for t in ts}
    wanted = {d: Counter(float(bucket[t]) for t in ts) for d, ts in terms.items()}
    frequency = Counter(b for c in wanted.values() for b in c)
    rows = feat.hashed_features(docs, 4096, 2).select(
        "doc_id", feat.vector_entries("rawFeatures").alias("tf"), feat.vector_entries("features").alias("w")).collect()
    for r in rows:
        assert {e["index"]: e["value"] for e in r["tf"]} == wanted[r["doc_id"]]
        for e in r["w"]:
            n = frequency[e["index"]]
            idf = math.log((len(docs.collect()) + 1) / (n + 1)) if n >= 2 else 0.0
            assert abs(e["value"] - wanted[r["doc_id"]][e["index"]] * idf) < 1e-9
        break
