import os
import time

from pyspark.sql import functions as F

from textflow.operators.layout import persisted, spread
from textflow.schemas import load_schema_file
from textflow.streaming.progress import attach
from textflow.streaming.scorers import PythonModelScorer, TextLengthModel
from textflow.streaming.serving import BatchScorer, ServingConfig, build_stream


def test_schema_file_json_and_ddl(spark, tmp_dir):
    ddl = os.path.join(tmp_dir, "s.ddl")
    with open(ddl, "w") as h:
        h.write("text STRING, label INT")
    schema = load_schema_file(ddl)
    js = os.path.join(tmp_dir, "s.json")
    with open(js, "w") as h:
        h.write(schema.json())
    assert load_schema_file(js) == schema and schema.fieldNames() == ["text", "label"]


def test_persisted_context_unpersists(spark):
    df = spark.range(100)
    with persisted(df, materialise=True) as cached:
        assert cached.is_cached
        assert cached.count() == 100
    assert not df.is_cached


def test_spread_is_off_unless_asked_for(spark):
    df = spark.range(0, 1000, numPartitions=1)
    assert spread(df) is df
    assert spread(df, 4).rdd.getNumPartitions() == 4
    spark.conf.set("spark.textflow.spreadPartitions", "3")
    try:
        assert spread(df).rdd.getNumPartitions() == 3
    finally:
        spark.conf.unset("spark.textflow.spreadPartitions")


def test_progress_log_records_batches(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    with open(f"{tmp_dir}/in/a.csv", "w") as h:
        h.write("text\nhello world\n")
    log = attach(spark, f"{tmp_dir}/progress")
    cfg = ServingConfig(output_path=f"{tmp_dir}/out", checkpoint=f"{tmp_dir}/ckpt", input_path=f"{tmp_dir}/in",
                        header=True, available_now=True)
    handler = BatchScorer(cfg)
    handler.holder.set(PythonModelScorer(TextLengthModel(3)), "v1", None)
    q = (build_stream(spark, cfg).writeStream.foreachBatch(handler)
         .option("checkpointLocation", cfg.checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    assert log.wait_for(q.runId)
    spark.streams.removeListener(log)
    rows = log.frame(spark).where(F.col("batch_id") == 0).collect()
    assert [r["num_input_rows"] for r in rows] == [1] and rows[0]["trigger_ms"] > 0   # the source is read once


def test_python_model_saved_and_loaded_through_spark(spark, tmp_dir):
    from textflow.streaming.scorers import load_scorer, save_python_model

    save_python_model(spark, TextLengthModel(4), f"{tmp_dir}/m")
    scorer = load_scorer(spark, f"{tmp_dir}/m", flavor="python")
    df = spark.createDataFrame([("abc",), ("abcdef",)], "text string")
    assert [r["prediction"] for r in scorer.score(df).orderBy("text").collect()] == [0.0, 1.0]


def test_top_k_matches_full_sort(spark):
    import random

    from textflow.operators.layout import top_k

    rnd = random.Random(5)
    rows = [(i, float(rnd.randint(0, 50))) for i in range(3000)]   # many ties
    for parts, k in ((64, 10), (64, 100), (3, 10), (3, 200), (1, 5)):
        df = spark.createDataFrame(rows, "id long, v double").repartition(parts)
        want = sorted(rows, key=lambda r: (-r[1], r[0]))[:k]
        got = [(r["id"], r["v"]) for r in top_k(df, k, "v", "id").collect()]
        assert got == want, (parts, k)
