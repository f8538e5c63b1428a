import os
import time

import pytest
from pyspark.sql import functions as F

from textflow.functions.payload import decode_payload, flag_column, parse_flag
from textflow.operators.monitor import active_streams, predictions_by_date, recent_files
from textflow.sources.predictions import read_predictions
from textflow.sources.stream import kafka_source_options
from textflow.streaming.scorers import PythonModelScorer, TextLengthModel
from textflow.streaming.serving import ARROW_BYTES, BatchScorer, NoModelError, ServingConfig, build_stream, utc_date
from textflow.streaming.sinks import kafka_sink_options


def _drop(folder, name, texts):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as handle:
        handle.write("text\n")
        for t in texts:
            handle.write('"' + t.replace('"', '""') + '"\n')


def _cfg(root, **kw):
    base = dict(output_path=f"{root}/out", checkpoint=f"{root}/ckpt", input_path=f"{root}/in",
                header=True, max_files_per_trigger=1, available_now=True, reload_interval_seconds=0)
    base.update(kw)
    return ServingConfig(**base).validate()


def _run(spark, cfg, handler):
    q = (build_stream(spark, cfg).writeStream.foreachBatch(handler)
         .option("checkpointLocation", cfg.checkpoint).trigger(availableNow=True).start())
    try:
        q.awaitTermination()
    except Exception:  # noqa: BLE001 - surfaced through q.exception()
        pass
    return q


def _static(version="v1", min_chars=3):
    handler_model = PythonModelScorer(TextLengthModel(min_chars))
    return handler_model, version


class FailAfterWrite:
    """Wraps the batch callback and fails once, after the write of one batch."""

    def __init__(self, inner, fail_batch):
        self.inner, self.fail_batch, self.failed = inner, fail_batch, False

    def __call__(self, df, batch_id):
        self.inner(df, batch_id)
        if batch_id == self.fail_batch and not self.failed:
            self.failed = True
            raise RuntimeError("injected failure after write")


def test_replay_after_failure_keeps_one_copy(spark, tmp_dir):
    for i, t in enumerate(["good movie", "bad", "not bad, could"]):
        _drop(f"{tmp_dir}/in", f"f{i}.csv", [t])
    cfg = _cfg(tmp_dir, write_json="true", json_output_path=f"{tmp_dir}/out_json",
               metrics_path=f"{tmp_dir}/metrics")
    scorer, version = _static()
    first = BatchScorer(cfg)
    first.holder.set(scorer, version, None)
    q1 = _run(spark, cfg, FailAfterWrite(first, 1))
    assert q1.exception() is not None
    before = {r["text"]: r["ingest_time"] for r in read_predictions(spark, cfg.output_path).collect()}
    assert len(before) == 2
    second = BatchScorer(cfg)
    second.holder.set(scorer, version, None)
    q2 = _run(spark, cfg, second)
    assert q2.exception() is None
    out = read_predictions(spark, cfg.output_path).collect()
    assert sorted(r["text"] for r in out) == ["bad", "good movie", "not bad, could"]
    after = {r["text"]: r["ingest_time"] for r in out}
    # the replayed batch keeps the ingest time of its first attempt
    assert after["bad"] == before["bad"]
    # the JSON copy and the batch metrics were replaced too, not appended
    assert spark.read.text(cfg.json_output_path).count() == 3
    from textflow.streaming.serving import read_batch_metrics

    batches = sorted(r["batch_id"] for r in read_batch_metrics(spark, cfg.metrics_path).collect())
    assert batches == [0, 1, 2]
    # a second query (fresh checkpoint) appends its own copy, never erasing the first
    third = BatchScorer(cfg)
    third.holder.set(scorer, version, None)
    cfg2 = ServingConfig(**{**cfg.__dict__, "checkpoint": f"{tmp_dir}/ckpt2"})
    _run(spark, cfg2, third)
    assert read_predictions(spark, cfg.output_path).count() == 6
    by_date = predictions_by_date(spark, cfg.output_path).collect()
    assert sum(r["n_rows"] for r in by_date) == 6
    assert recent_files(spark, cfg.output_path, n=5).count() == 5


def test_hot_swap_between_batches_and_failed_reload(spark, tmp_dir):
    for i in range(4):
        _drop(f"{tmp_dir}/in", f"f{i}.csv", [f"text number {i}"])
    calls = {"n": 0}

    def resolver():
        calls["n"] += 1
        if calls["n"] == 3:
            raise ConnectionError("registry down")
        return ("1", "u1") if calls["n"] == 1 else ("2", "u2")

    loaded = []

    def loader(uri):
        loaded.append(uri)
        return PythonModelScorer(TextLengthModel(3 if uri == "u1" else 1000))

    cfg = _cfg(tmp_dir)
    handler = BatchScorer(cfg, resolver=resolver, loader=loader)
    q = _run(spark, cfg, handler)
    assert q.exception() is None
    versions = [h["model_version"] for h in sorted(handler.history, key=lambda h: h["batch_id"])]
    # batch 0 -> v1, batch 1 -> v2, batch 2: poll fails, keeps v2, batch 3 -> v2
    assert versions == ["1", "2", "2", "2"]
    assert loaded == ["u1", "u2"]
    rows = read_predictions(spark, cfg.output_path).collect()
    assert {r["model_version"] for r in rows} == {"1", "2"}


def test_no_model_means_batch_not_committed(spark, tmp_dir):
    _drop(f"{tmp_dir}/in", "f0.csv", ["hello"])
    cfg = _cfg(tmp_dir)
    handler = BatchScorer(cfg, resolver=lambda: (None, None), loader=lambda uri: None)
    q = _run(spark, cfg, handler)
    assert q.exception() is not None and "no model" in str(q.exception()).lower()
    assert not os.path.exists(f"{tmp_dir}/ckpt/commits/0")
    with pytest.raises(NoModelError):
        handler.current_model()


def test_empty_file_batch_is_skipped(spark, tmp_dir):
    _drop(f"{tmp_dir}/in", "f0.csv", [])
    cfg = _cfg(tmp_dir)
    handler = BatchScorer(cfg, resolver=lambda: (None, None), loader=lambda uri: None)
    q = _run(spark, cfg, handler)
    assert q.exception() is None and handler.history == []


def test_config_validation():
    with pytest.raises(ValueError, match="input_path"):
        ServingConfig(output_path="/o", checkpoint="/c").validate()
    with pytest.raises(ValueError, match="kafka_bootstrap"):
        ServingConfig(output_path="/o", checkpoint="/c", source_type="kafka").validate()
    with pytest.raises(ValueError, match="must not be inside"):
        ServingConfig(output_path="/o", checkpoint="/c", input_path="/i", write_json=True,
                      json_output_path="/o/json").validate()
    with pytest.raises(ValueError, match="kafka_output"):
        ServingConfig(output_path="/o", checkpoint="/c", input_path="/i", write_kafka="yes").validate()
    ServingConfig(output_path="/o", checkpoint="/c", input_path="/i", write_json="true",
                  json_output_path="/o_json").validate()


def test_kafka_options_and_payloads(spark):
    opts = kafka_source_options("b:9092", "in", max_offsets_per_trigger=100)
    assert opts["subscribe"] == "in" and opts["startingOffsets"] == "latest"
    assert opts["maxOffsetsPerTrigger"] == "100"
    assert kafka_sink_options("b:9092", "out") == {"kafka.bootstrap.servers": "b:9092", "topic": "out"}
    cases = [('{"text":"hi","id":"1"}', "hi"), ("plain", "plain"), ('{"id":"2"}', '{"id":"2"}'),
             ('{"text":null}', '{"text":null}'), ("{bad", "{bad"), (None, None)]
    df = spark.createDataFrame([(None if v is None else bytearray(v.encode()),) for v, _ in cases], "value binary")
    got = [r[0] for r in df.select(decode_payload("value")).collect()]
    assert got == [want for _, want in cases]


def test_flags():
    assert all(parse_flag(v) for v in ("true", "1", "yes", "Y", "t", True))
    assert not any(parse_flag(v) for v in ("false", "0", "no", "", False))


def test_flag_column(spark):
    df = spark.createDataFrame([("YES",), ("0",), (None,)], "v string")
    assert [r[0] for r in df.select(flag_column("v")).collect()] == [True, False, None]


def test_utc_date_independent_of_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Pacific/Auckland")
    try:
        df = spark.sql("SELECT TIMESTAMP '2024-01-01 20:30:00 UTC' AS ingest_time")
        assert df.select(utc_date()).first()[0] == "2024-01-01"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_active_streams_lists_running_query(spark, tmp_dir):
    _drop(f"{tmp_dir}/in", "f0.csv", ["hello"])
    cfg = ServingConfig(output_path=f"{tmp_dir}/out", checkpoint=f"{tmp_dir}/ckpt", input_path=f"{tmp_dir}/in",
                        header=True, trigger_seconds=1, query_name="textflow_monitor_test")
    handler = BatchScorer(cfg)
    handler.holder.set(PythonModelScorer(TextLengthModel(3)), "v1", None)
    q = (build_stream(spark, cfg).writeStream.foreachBatch(handler).queryName(cfg.query_name)
         .option("checkpointLocation", cfg.checkpoint).trigger(processingTime="1 second").start())
    try:
        q.processAllAvailable()
        time.sleep(0.5)
        rows = [r for r in active_streams(spark).collect() if r["name"] == "textflow_monitor_test"]
        assert rows and rows[0]["is_active"]
    finally:
        q.stop()


def test_poll_interval_restarts_on_every_successful_poll(tmp_dir):
    calls = {"n": 0}

    def resolver():
        calls["n"] += 1
        return "1", "u1"

    cfg = ServingConfig(output_path=f"{tmp_dir}/o", checkpoint=f"{tmp_dir}/c", input_path=f"{tmp_dir}/i",
                        reload_interval_seconds=1000)
    handler = BatchScorer(cfg, resolver=resolver, loader=lambda uri: "model-" + uri)
    for _ in range(5):
        assert handler.current_model() == ("model-u1", "1")
    assert calls["n"] == 1
    handler.holder.mark_checked(time.time() - 1001)
    handler.current_model()
    assert calls["n"] == 2
    # unchanged version: polled again but not reloaded, and the interval restarts
    assert not handler.holder.due(1000)


def test_recent_files_time_window(spark, tmp_dir):
    spark.range(10).write.parquet(f"{tmp_dir}/t")
    assert recent_files(spark, f"{tmp_dir}/t", n=5, within_hours=1).count() >= 1
    assert recent_files(spark, f"{tmp_dir}/t", n=5, within_hours=-1).count() == 0


def test_recent_files_of_an_older_date_written_last(spark, tmp_dir, monkeypatch):
    import os
    from pathlib import Path

    from textflow.operators import monitor
    from textflow.streaming.sinks import compact_date, write_predictions

    dates = ["2024-01-01", "2024-01-02", "2024-01-03"]
    rows = [(i, float(i), dates[i % 3], "q", i) for i in range(30)]
    path = f"{tmp_dir}/p"
    write_predictions(spark.createDataFrame(rows, "id long, prediction double, date string, query_id string, batch_id long"), path)
    for f in Path(path).rglob("part-*"):
        os.utime(f, (1_700_000_000, 1_700_000_000))
    compact_date(spark, path, dates[0])
    for size in (200, 1):  # in one group, a group for each folder
        monkeypatch.setattr(monitor, "FOLDERS_LISTED", size)
        assert "/date=2024-01-01/query_id=compacted/" in recent_files(spark, path, n=1).first()["path"]
        fresh = recent_files(spark, path, n=5, within_hours=1).collect()
        assert fresh and all("/query_id=compacted/" in r["path"] for r in fresh)
        listed = sorted(((f.stat().st_mtime_ns // 1_000_000, f"file:{f}") for f in Path(path).rglob("part-*")), reverse=True)
        assert [r["path"].replace("file:///", "file:/") for r in recent_files(spark, path, n=5).collect()] == [f for _, f in listed[:5]]
        assert {r["path"].split("/date=")[1][:10] for r in recent_files(spark, path, n=99, since=dates[1]).collect()} == set(dates[1:])
    assert recent_files(spark, path, since="2025-01-01").count() == 0


def test_kafka_shaped_stream_decodes_and_scores(spark, tmp_dir):
    """Kafka rows (binary value + timestamp) through the same decode and
    scoring path, fed from a file stream since no broker runs here."""
    from textflow.functions.payload import decode_kafka_frame
    from textflow.streaming.serving import shape_predictions

    os.makedirs(f"{tmp_dir}/in")
    with open(f"{tmp_dir}/in/m.json", "w") as h:
        h.write('{"v": "{\\"text\\":\\"a long enough text\\",\\"label\\":1}"}\n{"v": "plain"}\n')
    raw = (spark.readStream.schema("v string").json(f"{tmp_dir}/in")
           .select(F.col("v").cast("binary").alias("value"), F.current_timestamp().alias("timestamp")))
    decoded = decode_kafka_frame(raw, keep_label=True).withColumn("ingest_time", F.current_timestamp())
    scorer = PythonModelScorer(TextLengthModel(6))
    seen = []

    def handle(batch, batch_id):
        seen.extend(shape_predictions(scorer.score(batch), ("kafka_ts",), "v1").collect())

    q = (decoded.writeStream.foreachBatch(handle).option("checkpointLocation", f"{tmp_dir}/ckpt")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    rows = {r["text"]: r for r in seen}
    assert rows["a long enough text"]["prediction"] == 1.0 and rows["a long enough text"]["label"] == 1
    assert rows["plain"]["prediction"] == 0.0 and rows["plain"]["label"] is None
    assert "kafka_ts" in seen[0].asDict()


def test_optional_sink_failure_policy(spark, tmp_dir):
    """The Kafka sink fails here (no connector on the classpath): with
    on_error='warn' the batch still commits its Parquet output; with 'raise'
    the batch fails and is not committed."""
    for policy, root in (("warn", f"{tmp_dir}/warn"), ("raise", f"{tmp_dir}/raise")):
        _drop(f"{root}/in", "f0.csv", ["some text"])
        cfg = _cfg(root, write_kafka="true", kafka_output_bootstrap="localhost:1", kafka_output_topic="t",
                   on_error=policy)
        handler = BatchScorer(cfg)
        handler.holder.set(PythonModelScorer(TextLengthModel(3)), "v1", None)
        q = _run(spark, cfg, handler)
        if policy == "warn":
            assert q.exception() is None
            assert os.path.exists(f"{root}/ckpt/commits/0")
            assert read_predictions(spark, cfg.output_path).count() == 1
        else:
            assert q.exception() is not None
            assert not os.path.exists(f"{root}/ckpt/commits/0")


def test_compact_closed_date(spark, tmp_dir):
    from textflow.streaming.sinks import compact_date, write_predictions

    from pyspark.ml.functions import array_to_vector

    rows = spark.range(0, 60).select(
        F.col("id").alias("doc_id"), (F.col("id") % 2).cast("double").alias("prediction"),
        array_to_vector(F.array(-F.col("id").cast("double"), F.col("id").cast("double"))).alias("rawPrediction"),
        F.when(F.col("id") < 40, "2024-01-01").otherwise("2024-01-02").alias("date"),
        F.lit("q1").alias("query_id"), (F.col("id") % 4).cast("bigint").alias("batch_id"))
    path = f"{tmp_dir}/preds"
    write_predictions(rows.repartition(6), path)

    def files(date):
        return sum(len([f for f in fs if f.startswith("part-")]) for _, _, fs in os.walk(f"{path}/date={date}"))

    assert files("2024-01-01") > 4
    before = sorted((r[0], r[1], r[2], tuple(r[3])) for r in read_predictions(spark, path)
                    .select("doc_id", "prediction", "date", "rawPrediction").collect())
    assert compact_date(spark, path, "2024-01-01") == 40
    after = read_predictions(spark, path)
    assert sorted((r[0], r[1], r[2], tuple(r[3])) for r in after
                  .select("doc_id", "prediction", "date", "rawPrediction").collect()) == before
    assert files("2024-01-01") == 1 and files("2024-01-02") > 1
    assert {r["query_id"] for r in after.where("date = '2024-01-01'").select("query_id").distinct().collect()} == {"compacted"}


@pytest.mark.parametrize("fmt", ["parquet", "text"])
def test_parquet_and_text_file_streams(spark, tmp_dir, fmt):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    if fmt == "parquet":
        docs.write.parquet(f"{tmp_dir}/in")
        cfg = _cfg(tmp_dir, file_format="parquet", schema="doc_id BIGINT, text STRING",
                   max_files_per_trigger=10, passthrough=("doc_id",))
        expected = docs.count()
    else:
        one_line = docs.select(F.regexp_replace("text", "\\n", " ").alias("value"))
        one_line.write.text(f"{tmp_dir}/in")
        cfg = _cfg(tmp_dir, file_format="text", max_files_per_trigger=10)
        expected = one_line.count()
    handler = BatchScorer(cfg)
    handler.holder.set(PythonModelScorer(TextLengthModel(2000)), "v1", None)
    q = _run(spark, cfg, handler)
    assert q.exception() is None
    assert read_predictions(spark, cfg.output_path).count() == expected


def test_compact_date_without_rows(spark, tmp_dir):
    from textflow.streaming.sinks import compact_date, write_predictions

    rows = spark.range(0, 5).select(F.col("id").alias("doc_id"), F.lit("2024-01-01").alias("date"),
                                    F.lit("q").alias("query_id"), F.lit(0).cast("bigint").alias("batch_id"))
    write_predictions(rows, f"{tmp_dir}/p")
    assert compact_date(spark, f"{tmp_dir}/p", "2024-02-02") == 0
    assert read_predictions(spark, f"{tmp_dir}/p").count() == 5


def test_rows_sent_to_a_python_worker_are_bounded_by_bytes(spark, tmp_dir):
    """10,000 rows went at once, however long their texts."""
    class BatchLength:
        def predict(self, pdf):
            return [len(pdf)] * len(pdf)

    src = os.path.join(tmp_dir, "in")
    spark.createDataFrame([("x" * 1000,)] * 300, "text string").coalesce(1).write.text(src)
    cfg = _cfg(tmp_dir, input_path=src, file_format="text", schema=None, arrow_batch_bytes=20_000)
    handler = BatchScorer(cfg)
    handler.holder.set(PythonModelScorer(BatchLength()), "v1", None)
    before = spark.conf.get(ARROW_BYTES)
    _run(spark, cfg, handler)
    sizes = [r["prediction"] for r in read_predictions(spark, cfg.output_path).select("prediction").collect()]
    assert len(sizes) == 300 and max(sizes) <= 40
    assert spark.conf.get(ARROW_BYTES) == before
