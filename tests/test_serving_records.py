"""What serving writes down beside its output: the version of each batch, the files
of each batch, and the progress of each query."""

import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from textflow.operators.monitor import predictions_by_date, recent_files, stream_runs
from textflow.sources.predictions import read_predictions
from textflow.streaming import manifest, progress, sinks
from textflow.streaming.pins import BatchVersions
from textflow.streaming.scorers import PythonModelScorer, TextLengthModel
from textflow.streaming.serving import BatchScorer, ServingConfig, build_stream


def _drop(folder, name, texts):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as handle:
        handle.write("text\n" + "".join(f'"{t}"\n' for t in texts))


def _cfg(root, **kw):
    base = dict(output_path=f"{root}/out", checkpoint=f"{root}/ckpt", input_path=f"{root}/in", header=True,
                max_files_per_trigger=1, available_now=True, reload_interval_seconds=0)
    return ServingConfig(**{**base, **kw}).validate()


def _run(spark, cfg, handler):
    q = (build_stream(spark, cfg).writeStream.foreachBatch(handler)
         .option("checkpointLocation", cfg.checkpoint).trigger(availableNow=True).start())
    try:
        q.awaitTermination()
    except Exception:  # noqa: BLE001 - surfaced through q.exception()
        pass
    return q


def _models(versions):
    """A resolver over a list of registered versions, and a loader that counts."""
    loaded = []

    def loader(uri):
        loaded.append(uri)
        return PythonModelScorer(TextLengthModel({"u1": 3, "u2": 1000, "u3": 5}[uri]))

    return (lambda: (versions[-1], "u" + versions[-1])), loader, loaded


def _failing(handler, at):
    """The callback, which fails once after batch ``at`` was written."""
    state = {"failed": False}

    def call(df, batch_id):
        handler(df, batch_id)
        if batch_id == at and not state["failed"]:
            state["failed"] = True
            raise RuntimeError("after the write")

    return call


def test_replay_after_a_swap_keeps_the_batch_s_version(spark, tmp_dir):
    for k in range(3):
        _drop(f"{tmp_dir}/in", f"f{k}.csv", [f"text number {k}", "ab"])
    cfg = _cfg(tmp_dir, write_json="true", json_output_path=f"{tmp_dir}/json", metrics_path=f"{tmp_dir}/metrics")
    versions = ["1"]
    resolver, loader, _ = _models(versions)
    first = BatchScorer(cfg, resolver=resolver, loader=loader)
    assert _run(spark, cfg, _failing(first, 1)).exception() is not None
    versions.append("2")
    resolver, loader, loaded = _models(versions)
    second = BatchScorer(cfg, resolver=resolver, loader=loader)
    assert _run(spark, cfg, second).exception() is None
    assert loaded == ["u1", "u2"]   # the replay's own version, then the newest
    assert {h["batch_id"]: h["model_version"] for h in second.history} == {1: "1", 2: "2"}
    rows = read_predictions(spark, cfg.output_path).collect()
    assert len(rows) == 6
    assert {(r["batch_id"], r["model_version"]) for r in rows} == {(0, "1"), (1, "1"), (2, "2")}
    assert {r["prediction"] for r in rows if r["batch_id"] == 1 and r["text"] != "ab"} == {1.0}   # by version 1
    pins = BatchVersions(spark, f"{cfg.output_path}/_batch_versions").table().collect()
    assert sorted((p["batch_id"], p["model_version"], p["uri"]) for p in pins) == [(0, "1", "u1"), (1, "1", "u1"), (2, "2", "u2")]


def test_without_pins_a_replay_takes_the_newest(spark, tmp_dir):
    _drop(f"{tmp_dir}/in", "f0.csv", ["some text"])
    cfg = _cfg(tmp_dir, pin_versions=False)
    versions = ["1"]
    resolver, loader, _ = _models(versions)
    _run(spark, cfg, _failing(BatchScorer(cfg, resolver=resolver, loader=loader), 0))
    versions.append("2")
    resolver, loader, _ = _models(versions)
    _run(spark, cfg, BatchScorer(cfg, resolver=resolver, loader=loader))
    assert {r["model_version"] for r in read_predictions(spark, cfg.output_path).collect()} == {"2"}
    assert not os.path.exists(f"{cfg.output_path}/_batch_versions")


def test_a_pinned_version_that_is_gone_raises(spark, tmp_dir):
    _drop(f"{tmp_dir}/in", "f0.csv", ["some text"])
    cfg = _cfg(tmp_dir)
    versions = ["1"]
    resolver, loader, _ = _models(versions)
    _run(spark, cfg, _failing(BatchScorer(cfg, resolver=resolver, loader=loader), 0))
    versions.append("2")

    def gone(uri):
        if uri == "u1":
            raise FileNotFoundError(uri)
        return PythonModelScorer(TextLengthModel(3))

    q = _run(spark, cfg, BatchScorer(cfg, resolver=lambda: ("2", "u2"), loader=gone))
    assert "u1" in str(q.exception())
    assert not os.path.exists(f"{cfg.checkpoint}/commits/0")


def test_pins_by_query_and_batch(spark, tmp_dir):
    pins = BatchVersions(spark, f"{tmp_dir}/pins")
    assert pins.pinned("q", 0) is None and pins.table().count() == 0
    pins.pin("q/odd = name%", 0, "1", "u1")
    pins.pin("q", 0, "2", None)
    pins.pin("q", 0, "3", "u3")    # anew
    assert pins.pinned("q/odd = name%", 0) == ("1", "u1")
    assert pins.pinned("q", 0) == ("3", "u3") and pins.pinned("q", 1) is None
    assert pins.table().where("pinned_at IS NOT NULL").count() == 2


def test_merged_pins(spark, tmp_dir):
    pins = BatchVersions(spark, f"{tmp_dir}/pins")
    assert pins.merge("q", 9) == 0
    for k in range(4):
        pins.pin("q", k, str(k), f"u{k}")
    pins.pin("other", 0, "7", None)
    assert pins.merge("q", 3) == 3 and pins.merge("q", 3) == 0
    assert [pins.pinned("q", k) for k in range(5)] == [("0", "u0"), ("1", "u1"), ("2", "u2"), ("3", "u3"), None]
    pins.pin("q", 1, "9", "u9")    # a batch that is done anew after all
    assert pins.pinned("q", 1) == ("9", "u9")
    assert sorted((r["query_id"], r["batch_id"], r["model_version"]) for r in pins.table().collect()) == [
        ("other", 0, "7"), ("q", 0, "0"), ("q", 1, "9"), ("q", 2, "2"), ("q", 3, "3")]


def test_one_pass_counts_rows_without_jobs_of_its_own(spark, tmp_dir):
    """Reading, scoring and counting a batch is one job, writing it another."""
    cfg = _cfg(tmp_dir, pin_versions=False, write_manifest=False, query_id="q")
    handler = BatchScorer(cfg)
    handler.holder.set(PythonModelScorer(TextLengthModel(3), ("text",)), "v1", None)
    spark.createDataFrame([("good",), (None,), ("x",)], "text string").write.parquet(f"{tmp_dir}/batch")
    frame = spark.read.schema("text string").parquet(f"{tmp_dir}/batch").withColumn("ingest_time", F.current_timestamp())
    context, group = spark.sparkContext, f"jobs-{os.path.basename(tmp_dir)}"
    context.setJobGroup(group, "one batch")
    try:
        handler(frame, 0)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    jobs = context.statusTracker().getJobIdsForGroup(group)
    assert len(jobs) == 2, jobs
    assert {k: handler.history[0][k] for k in ("batch_rows", "written_rows", "null_text_rows")} == {
        "batch_rows": 3, "written_rows": 3, "null_text_rows": 1}


def test_manifest_follows_batches_replays_and_compaction(spark, tmp_dir):
    for k in range(3):
        _drop(f"{tmp_dir}/in", f"f{k}.csv", [f"text {k} {j}" for j in range(k + 1)])
    cfg = _cfg(tmp_dir)

    def handler():
        h = BatchScorer(cfg)
        h.holder.set(PythonModelScorer(TextLengthModel(3)), "v1", None)
        return h

    assert _run(spark, cfg, _failing(handler(), 1)).exception() is not None
    assert _run(spark, cfg, handler()).exception() is None   # replays batch 1
    found = manifest.files(spark, cfg.output_path).collect()
    written = read_predictions(spark, cfg.output_path).groupBy("batch_id").count().collect()
    assert sorted((r["batch_id"], r["n_rows"]) for r in found) == sorted(map(tuple, written))
    assert sorted(r["n_rows"] for r in found) == [1, 2, 3]
    local = lambda p: p.replace("file://", "").replace("file:", "")
    assert all(os.path.getsize(local(r["path"])) == r["n_bytes"] for r in found)
    date = found[0]["date"]
    assert [tuple(r) for r in predictions_by_date(spark, cfg.output_path).collect()] == [(date, 6)]
    assert [r["path"] for r in recent_files(spark, cfg.output_path, n=1).collect()] == [
        r["path"] for r in found if r["batch_id"] == 2]
    assert recent_files(spark, cfg.output_path, within_hours=-1).count() == 0
    assert sinks.compact_date(spark, cfg.output_path, date) == 6
    after = manifest.files(spark, cfg.output_path).collect()
    assert [(r["query_id"], r["n_rows"]) for r in after] == [("compacted", 6)]
    assert all(os.path.exists(local(r["path"])) for r in after)
    assert read_predictions(spark, cfg.output_path).count() == 6


def test_records_before_a_compaction_do_not_count(spark, tmp_dir):
    """A call that died before it deleted the older records leaves nothing wrong; a late
    batch does count."""
    rows = spark.range(8).select("id", F.lit("2024-01-01").alias("date"), F.lit("q").alias("query_id"), (F.col("id") % 2).alias("batch_id"))
    path = f"{tmp_dir}/p"
    sinks.write_predictions(rows, path)
    for batch in (0, 1):
        manifest.record(spark, path, ["2024-01-01"], "q", batch)
    kept = manifest.files(spark, path).collect()
    sinks.compact_date(spark, path, "2024-01-01")
    (spark.createDataFrame(kept, manifest.OUTPUT_FILES).write.mode("append").partitionBy("date", "query_id", "batch_id")
     .parquet(manifest.location(path)))   # as if they had not been deleted
    assert [r["query_id"] for r in manifest.files(spark, path).collect()] == ["compacted"]
    late = rows.where("id < 3").withColumn("batch_id", F.lit(7).cast("long"))
    sinks.write_predictions(late, path)
    manifest.record(spark, path, ["2024-01-01"], "q", 7)
    assert predictions_by_date(spark, path).first()["n_rows"] == 11 == read_predictions(spark, path).count()
    manifest.rebuild(spark, path)
    assert predictions_by_date(spark, path).first()["n_rows"] == 11


def test_manifest_of_odd_query_ids_and_none(spark, tmp_dir):
    path = f"{tmp_dir}/p"
    assert manifest.files(spark, path).count() == 0 and not manifest.exists(spark, path)
    rows = spark.range(4).select("id", F.lit("2024-01-01").alias("date"), F.lit("a/b=c %#").alias("query_id"), F.lit(3).cast("long").alias("batch_id"))
    sinks.write_predictions(rows, path)
    manifest.record(spark, path, ["2024-01-01"], "a/b=c %#", 3)
    assert [(r["query_id"], r["batch_id"], r["n_rows"]) for r in manifest.files(spark, path).groupBy("query_id", "batch_id").agg(
        F.sum("n_rows").alias("n_rows")).collect()] == [("a/b=c %#", 3, 4)]
    manifest.record(spark, path, [], "q", 0)   # an empty batch writes nothing


def _event(run, batch, rows=10):
    return SimpleNamespace(progress=SimpleNamespace(
        id="q1", runId=run, name="n", batchId=batch, numInputRows=rows, inputRowsPerSecond=1.0, processedRowsPerSecond=2.0,
        durationMs={"triggerExecution": 7}, timestamp=f"t{batch}"))


def test_no_event_of_1500_batches_is_lost(spark, tmp_dir):
    path = f"{tmp_dir}/log"
    log = progress.ProgressLog(spark, path, flush_events=400, flush_seconds=3600)
    log.onQueryStarted(SimpleNamespace(id="q1", runId="r1", name="n", timestamp="t"))
    for k in range(1500):
        log.onQueryProgress(_event("r1", k))
    assert log.frame().agg(F.countDistinct("batch_id"), F.sum("num_input_rows")).first()[:] == (1500, 15_000)
    assert stream_runs(spark, path).first()["state"] == "running"
    assert stream_runs(spark, path, stale_seconds=-60).first()["state"] == "lost"
    log.onQueryTerminated(SimpleNamespace(id="q1", runId="r1", exception=None))
    # another session's log of the same place sees all, and adds its own
    other = progress.ProgressLog(spark, path)
    other.onQueryProgress(_event("r2", 1500, 3))
    other.onQueryTerminated(SimpleNamespace(id="q1", runId="r2", exception="boom"))
    runs = {r["run_id"]: r for r in stream_runs(spark, path).collect()}
    assert (runs["r1"]["state"], runs["r1"]["n_batches"], runs["r1"]["n_rows"], runs["r1"]["last_batch"]) == ("stopped", 1500, 15_000, 1499)
    assert (runs["r2"]["state"], runs["r2"]["error"], runs["r2"]["n_rows"]) == ("failed", "boom", 3)


def test_events_that_cannot_be_written_wait(spark, tmp_dir):
    log = progress.ProgressLog(spark, "nosuchscheme://x/log", flush_events=2)
    for k in range(5):
        log.onQueryProgress(_event("r1", k))    # the listener goes on
    with pytest.raises(Exception):
        log.flush()
    log.path = f"{tmp_dir}/log"
    assert log.frame().count() == 5


def test_merged_dates_hold_each_event_once(spark, tmp_dir):
    path = f"{tmp_dir}/log"
    log = progress.ProgressLog(spark, path, flush_events=1)
    for k in range(4):
        log.onQueryProgress(_event("r1", k))
    (folder,) = [f for f in os.listdir(path) if f.startswith("date=")]
    date = folder.split("=")[1]
    assert len([f for f in os.listdir(f"{path}/{folder}") if f.startswith("part-")]) == 4
    # as if an earlier merge had died before it deleted the small files
    spark.read.parquet(f"{path}/{folder}").coalesce(1).write.mode("append").parquet(f"{path}/{folder}")
    assert log.frame().count() == 4
    assert progress.merge_date(spark, path, date) == 4
    assert len([f for f in os.listdir(f"{path}/{folder}") if f.startswith("part-")]) == 1
    assert log.frame().count() == 4
    assert progress.progress_table(spark, path, since="2999-01-01").count() == 0
    assert progress.merge_date(spark, path, "1999-01-01") == 0
