"""Generated clips through sources, signals, the batch plan and the streams."""

import io
import json
import math
import struct
import sys
import time
import wave

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from sonorum import config
from sonorum.operators import bundles, outcomes, signal
from sonorum.plans import registry
from sonorum.plans.classify import classify_audio
from sonorum.sources import audio as audio_source
from sonorum.sources.sinks import write_outcomes, write_rejects
from sonorum.streaming import clips, progress
from sonorum.streaming.bundles import STATE_STORE, bundle_stream
from sonorum.streaming.clips import REJECT_COLUMNS, classify_stream

N_CLASSES = 6
cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the executors can't import tests


def wav(seconds: float, hz: float = 440.0, rate: int = 16000, channels: int = 1) -> bytes:
    n = round(seconds * rate)
    tone = [int(12000 * math.sin(2 * math.pi * hz * i / rate)) for i in range(n)]
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(struct.pack(f"<{n * channels}h", *(v for v in tone for _ in range(channels))))
    return out.getvalue()


CLIPS = {
    "sine.wav": (wav(1.0), "ok"),
    "silence.wav": (wav(1.0, hz=0.0), "ok"),
    "stereo.wav": (wav(1.0, rate=44100, channels=2), "ok"),
    "slow.wav": (wav(1.0, rate=8000), "ok"),
    "short.wav": (wav(0.49), "bad_duration"),
    "long.wav": (wav(10.01), "bad_duration"),
    "empty.wav": (b"", "unreadable"),  # Spark lists no empty files
    "cut.wav": (wav(1.0)[:20], "undecodable"),
    "note.wav": (b"this is no sound", "undecodable"),
}


def make_predict():
    def model(mels: np.ndarray) -> np.ndarray:
        rows = mels.reshape(len(mels), 80, -1)
        return np.stack([rows[:, k * 13 : k * 13 + 13].mean(axis=(1, 2)) for k in range(N_CLASSES)], axis=1)

    return model


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("clips")
    for name, (data, _) in CLIPS.items():
        (path / name).write_bytes(data)
    return path


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(f"intent {k}", k) for k in range(N_CLASSES)], "intent string, class_idx int")


def requests(spark, folder):
    names = [*CLIPS, "missing.wav"]
    return spark.createDataFrame([(n, f"file:{folder}/{n}", "text" if n == "slow.wav" else None, None) for n in names], "request_id string, path string, response_format string, top_k string")


def test_scan_pushes_the_size_filter(spark, folder):
    scan = audio_source.scan_audio(spark, str(folder)).filter("length <= 1000").select("path", "length")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(length,1000)" in plan and "content" not in plan.split("ReadSchema")[1]
    assert audio_source.scan_audio(spark, str(folder), "*.wav").count() == len(CLIPS) - 1


def test_decode(spark, folder):
    found = {r["path"].split("/")[-1]: r for r in signal.decode_clips(audio_source.scan_audio(spark, str(folder))).collect()}
    assert found["sine.wav"]["n_samples"] == found["stereo.wav"]["n_samples"] == found["slow.wav"]["n_samples"] == 16000
    assert found["stereo.wav"]["channels"] == 2 and found["stereo.wav"]["rate"] == 44100
    assert all(found[n]["error"] and found[n]["samples"] is None for n in ("cut.wav", "note.wav"))
    sine, again = np.array(found["sine.wav"]["samples"], float), np.array(found["stereo.wav"]["samples"], float)
    assert np.abs(sine - again)[200:-200].max() < 300


def test_log_mel(spark, folder):
    clips = signal.decode_clips(audio_source.scan_audio(spark, str(folder), "s*.wav"))
    mels = {r["path"].split("/")[-1]: np.array(r["mel"]).reshape(80, 3000) for r in signal.log_mel(clips).collect()}
    assert len(mels) == 5
    assert np.ptp(mels["silence.wav"]) == 0
    peak = mels["sine.wav"][:, 50].argmax()
    centre = signal.mel_filters(80, 400)[peak].argmax() * 40
    assert abs(centre - 440) <= 60


def test_classify_audio(spark, folder, labels):
    asked = requests(spark, folder)
    out = classify_audio(asked, audio_source.scan_audio(spark, str(folder)), make_predict, labels)
    rows = {r["request_id"]: r for r in out.collect()}
    assert {n: r["rule"] for n, r in rows.items()} == {n: rule for n, (_, rule) in CLIPS.items()} | {"missing.wav": "unreadable"}
    assert len(rows["sine.wav"]["intents"]) == 5
    assert rows["slow.wav"]["response"] == rows["slow.wav"]["top_intent"]
    assert rows["sine.wav"]["response"].startswith("{")
    confidences = [i["confidence"] for i in rows["sine.wav"]["intents"]]
    assert confidences == sorted(confidences, reverse=True)
    assert outcomes.unanswered(asked, out).isEmpty() and outcomes.answered_twice(out).isEmpty()


def test_failing_model_and_wrong_width(spark, folder, labels):
    files = audio_source.scan_audio(spark, str(folder), "sine.wav")
    asked = requests(spark, folder).filter("request_id = 'sine.wav'")
    wide = classify_audio(asked, files, lambda: lambda x: np.zeros((len(x), N_CLASSES + 1)), labels).first()
    assert (wide["rule"], wide["status"]) == ("inference_failed", 500)

    def broken():
        def model(x):
            raise RuntimeError("no memory")

        return model

    row = classify_audio(asked, files, broken, labels).first()
    assert row["status"] == 500 and "no memory" in row["detail"]


def test_sinks(spark, folder, labels, tmp_path):
    out = classify_audio(requests(spark, folder), audio_source.scan_audio(spark, str(folder)), make_predict, labels)
    write_outcomes(out, str(tmp_path / "all"))
    write_outcomes(out, str(tmp_path / "text"), "text")
    write_rejects(out, str(tmp_path / "bad"), "json")
    assert spark.read.parquet(str(tmp_path / "all")).count() == len(CLIPS) + 1
    assert spark.read.text(str(tmp_path / "text")).count() == 4
    assert spark.read.json(str(tmp_path / "bad")).count() == len(CLIPS) - 3


def test_clips_of_a_batch_are_decoded_as_they_are_given_out():
    calls = []

    def decoder(data):
        calls.append(data)
        return np.full(4 + len(calls) % 3, 7, np.int16), config.SAMPLE_RATE, 1

    batch = pa.RecordBatch.from_arrays([pa.array(range(400)), pa.array([None if k % 10 == 0 else b"x" for k in range(400)], pa.binary())], ["path", "content"])
    seen = []
    for out in signal.decoding(decoder, "path", 32)(iter([batch, batch.slice(0, 0)])):
        seen += out.column(0).to_pylist()
        assert out.num_rows <= 32 and len(calls) <= len(seen)
        assert [s is None for s in out.column(1).to_pylist()] == [k % 10 == 0 for k in out.column(0).to_pylist()]
    assert seen == list(range(400)) and len(calls) == 360


def test_stream_equals_batch(spark, folder, labels, tmp_path):
    asked = requests(spark, folder).filter("request_id not in ('missing.wav', 'empty.wav')")
    batch = {(r["request_id"], r["rule"], r["top_intent"]) for r in classify_audio(asked, audio_source.scan_audio(spark, str(folder)), make_predict, labels).collect()}
    for _ in range(2):  # the second run finds the checkpoint and nothing new
        stream = audio_source.stream_audio(spark, str(folder), max_files=4)
        query = classify_stream(stream, asked, make_predict, labels, str(tmp_path / "out"), str(tmp_path / "state"), availableNow=True)
        query.awaitTermination(120)
    results, rejects = (spark.read.parquet(str(tmp_path / "out" / side)) for side in ("results", "rejects"))
    assert results.unionByName(rejects, allowMissingColumns=True).select("batch_id").distinct().count() >= 2
    assert results.count() + rejects.count() == len(CLIPS) - 1
    assert {(r["request_id"], r["rule"], r["top_intent"]) for r in results.collect()} | {(r["request_id"], r["rule"], None) for r in rejects.collect()} == batch
    assert set(rejects.columns) == {*REJECT_COLUMNS, "batch_id"} and rejects.filter("detail is null or status = 200").isEmpty()


def test_files_are_listed_by_few_tasks(spark):
    key, most = "spark.sql.sources.parallelPartitionDiscovery.parallelism", 4 * spark.sparkContext.defaultParallelism
    before = spark.conf.get(key)
    for own, held in ((before, str(min(int(before), most))), ("2", "2")):
        spark.conf.set(key, own)
        with audio_source.few_listing_tasks(spark):
            assert spark.conf.get(key) == held
        assert spark.conf.get(key) == own
    spark.conf.set(key, before)


def test_streamed_clips_lie_in_one_folder_and_few_tasks_list_them(spark, tmp_path, monkeypatch):
    """Clips of the query: ids below zero, a repeated one and one that is missing stay as they are."""
    key, held, places = "spark.sql.sources.parallelPartitionDiscovery.parallelism", [], []
    write, folder_of, before = clips.write_batch, registry._folder, spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")
    monkeypatch.setattr(clips, "write_batch", lambda files, *a: held.append(int(spark.conf.get(key))) or write(files, *a))
    monkeypatch.setattr(registry, "_folder", lambda *a: places.append(folder_of(*a)) or places[-1])
    ids = (-2, 5, 7, 7, 12, 1234567890123, None, 21, 22, 23)
    rows = [(i, [0.1 * k] * 64, k) for k, i in enumerate(ids)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    found = registry.queries()["h1_classify_stream"](spark, str(tmp_path)).collect()
    assert sorted(str(r["vec_id"]) for r in found) == sorted(str(r[0]) for r in rows)
    assert {r["vec_id"]: r["rule"] for r in found if r["vec_id"] in (5, 7, 1234567890123)} == {5: "undecodable", 7: "ok", 1234567890123: "ok"}
    assert held and max(held) <= spark.sparkContext.defaultParallelism and spark.conf.get(key) == before
    assert spark.read.format("binaryFile").load(f"{places[0]}/in").count() == len(rows)


def test_oversize_content_is_not_read(spark, folder, labels, tmp_path, monkeypatch):
    monkeypatch.setattr(config, "MAX_UPLOAD_BYTES", 20_000)
    query = classify_stream(audio_source.stream_audio(spark, str(folder)), requests(spark, folder), make_predict, labels, str(tmp_path / "out"), str(tmp_path / "state"), availableNow=True)
    query.awaitTermination(120)
    rejects = {r["request_id"]: r["rule"] for r in spark.read.parquet(str(tmp_path / "out" / "rejects")).collect()}
    assert rejects["sine.wav"] == "too_large" and rejects["cut.wav"] == "undecodable"
    assert {r["request_id"] for r in spark.read.parquet(str(tmp_path / "out" / "results")).collect()} == {"slow.wav"}


def test_requests_with_one_id_or_one_file_each_have_their_outcome(spark, folder, labels):
    path = f"file:{folder}/sine.wav"
    asked = spark.createDataFrame([("a", path, "text"), ("a", path, "json"), ("a", f"{path}x", None), ("b", path, "srt")], "request_id string, path string, response_format string")
    rows = classify_audio(asked, audio_source.scan_audio(spark, str(folder)), make_predict, labels).collect()
    assert sorted((r["request_id"], r["rule"]) for r in rows) == [("a", "ok"), ("a", "ok"), ("a", "unreadable"), ("b", "bad_format")]


def test_a_file_is_scored_once_for_all_its_requests(spark, folder, labels, tmp_path):
    path, refused = f"file:{folder}/sine.wav", f"file:{folder}/slow.wav"
    place = str(tmp_path)

    def noting():
        model = make_predict()

        def predict(mels):
            with open(f"{place}/calls", "a") as f:
                f.write(f"{len(mels)}\n")
            return model(mels)

        return predict

    asked = spark.createDataFrame([(f"r{k}", path, "json", str(1 + k % 4)) for k in range(100)] + [(f"x{k}", refused, "srt", None) for k in range(50)] + [("none", None, None, None)], "request_id string, path string, response_format string, top_k string")
    rows = classify_audio(asked, audio_source.scan_audio(spark, str(folder)), noting, labels).collect()
    assert sum(map(int, (tmp_path / "calls").read_text().split())) == 1
    assert len(rows) == 151 and all(len(r["intents"]) == 1 + int(r["request_id"][1:]) % 4 for r in rows if r["path"] == path)
    assert {r["rule"] for r in rows if r["path"] == refused} == {"bad_format"} and {r["rule"] for r in rows if r["path"] is None} == {"unreadable"}


def test_attached_audio_has_a_row_for_each_request_row(spark, folder):
    path = f"file:{folder}/sine.wav"
    asked = spark.createDataFrame([("a", path), ("a", path), ("a", f"file:{folder}/slow.wav"), ("b", path), (None, path), ("c", None)], "request_id string, path string")
    found = audio_source.attach_audio(asked, audio_source.scan_audio(spark, str(folder)), asked.filter("request_id <> 'b'")).collect()
    assert sorted((r["request_id"] or "", (r["path"] or "").split("/")[-1], r["content"] is not None) for r in found) == [
        ("", "sine.wav", False), ("a", "sine.wav", True), ("a", "sine.wav", True), ("a", "slow.wav", True), ("b", "sine.wav", False), ("c", "", False),
    ]


def test_a_failing_spectrogram_is_the_rows_own_error(spark, folder, labels, monkeypatch):
    from sonorum.plans import classify

    real = signal.spectrogram

    def broken(samples, *rest):
        if samples.max() == 0:
            raise ValueError("no sound")
        return real(samples, *rest)

    monkeypatch.setattr(classify, "spectrogram", broken)
    asked = requests(spark, folder).filter("request_id in ('sine.wav', 'silence.wav')")
    rows = {r["request_id"]: r for r in classify_audio(asked, audio_source.scan_audio(spark, str(folder)), make_predict, labels).collect()}
    assert rows["sine.wav"]["status"] == 200
    assert (rows["silence.wav"]["rule"], rows["silence.wav"]["status"]) == ("inference_failed", 500)
    assert json.loads(rows["silence.wav"]["detail"]) == {"error": "Inference failed", "message": "Audio preprocessing failed: ValueError: no sound"}


def test_a_replayed_batch_leaves_what_one_run_leaves(spark, folder, labels, tmp_path):
    files = audio_source.scan_audio(spark, str(folder))
    asked = spark.createDataFrame([("a", f"file:{folder}/sine.wav"), ("b", f"file:{folder}/sine.wav")], "request_id string, path string")
    seen = []
    for _ in range(2):
        for batch, part in enumerate((files.filter("path like '%/s%'"), files.filter("path not like '%/s%'"))):
            clips.write_batch(part, batch, asked, make_predict, labels, str(tmp_path))
        sides = {side: sorted(map(repr, spark.read.parquet(str(tmp_path / side)).collect())) for side in ("results", "rejects")}
        seen.append(sides)
    assert seen[0] == seen[1] and len(seen[0]["results"]) == 5 and len(seen[0]["rejects"]) == len(CLIPS) - 1 - 4
    assert spark.read.parquet(str(tmp_path / "last_batch")).count() < len(CLIPS)


def test_a_batch_that_loses_an_outcome_fails(spark, folder, labels, tmp_path, monkeypatch):
    whole = clips.outcomes_of
    monkeypatch.setattr(clips, "outcomes_of", lambda *a, **b: whole(*a, **b).filter("path not like '%sine.wav'"))
    files = audio_source.scan_audio(spark, str(folder))
    with pytest.raises(RuntimeError, match=f"batch 3 has {len(CLIPS) - 2} outcomes of {len(CLIPS) - 1} requests"):
        clips.write_batch(files, 3, requests(spark, folder), make_predict, labels, str(tmp_path))
    assert not (tmp_path / "results").exists()


def test_a_stream_that_loses_an_outcome_is_flagged(spark, tmp_path):
    for k in range(3):
        spark.range(k * 10, k * 10 + 10).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    for lost in (None, 14):
        listener = progress.Reconciliation()
        spark.streams.addListener(listener)
        try:
            asked = progress.counted(spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), progress.REQUESTS)
            answered = progress.counted(asked.filter(F.col("id") != (-1 if lost is None else lost)), progress.OUTCOMES)
            query = answered.writeStream.format("memory").queryName(f"answers_{lost}").option("checkpointLocation", str(tmp_path / f"state_{lost}")).trigger(availableNow=True).start()
            query.awaitTermination(120)
            deadline = time.time() + 20
            while lost and not listener.differing and time.time() < deadline:
                time.sleep(0.1)
        finally:
            spark.streams.removeListener(listener)
        if lost is None:
            listener.check()
        else:
            assert [d[1:] for d in listener.differing] == [(1, 10, 9)]
            with pytest.raises(RuntimeError, match="batch 1 has 9 outcomes of 10 requests"):
                listener.check()


def test_bundles_of_a_shuffled_stream_equal_those_in_order_and_late_rows_are_counted(spark, tmp_path):
    spark.conf.set(*STATE_STORE)
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"))
    wait = 3_600_000_000
    batch = bundles.bundle_events(events.withColumn("t", F.unix_micros("ts")), "user_id", "t", "event_id", 4, wait)
    want = {(r["user_id"], r["bundle"]): (r["n"], r["first"]) for r in batch.groupBy("user_id", "bundle").agg(F.count("t").alias("n"), F.min("t").alias("first")).collect()}
    arrival = F.expr("ts + make_interval(0, 0, 0, 0, 0, 0, pmod(xxhash64(event_id), 86400))").cast("timestamp")  # up to a day after
    moved = events.withColumn("arrival", arrival).cache()
    bounds = [r[0] for r in moved.select(F.percentile_approx("arrival", [0.25, 0.5, 0.75]).alias("q")).select(F.explode("q")).collect()]
    edges = [None, *bounds, None]
    for k in range(4):
        part = moved.filter(F.lit(True) if edges[k] is None else F.col("arrival") > edges[k]).filter(F.lit(True) if edges[k + 1] is None else F.col("arrival") <= edges[k + 1])
        part.orderBy(F.xxhash64("event_id", F.lit(1))).coalesce(1).drop("arrival").write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(0.05)
    late, first = 7, moved.agg(F.min("ts")).first()[0]
    moved.unpersist()
    spark.range(late).select(F.lit(1).cast("bigint").alias("user_id"), F.col("id").alias("event_id"), F.lit(first).alias("ts")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    listener = progress.LateRows()
    spark.streams.addListener(listener)
    try:
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        query = bundle_stream(stream, "user_id", "ts", 4, wait, "1 day").writeStream.outputMode("append").format("memory").queryName("shuffled").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        query.awaitTermination(180)
        deadline = time.time() + 20
        while not listener.dropped[str(query.id)] and time.time() < deadline:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert listener.dropped[str(query.id)] == late
    got = {(r["user_id"], r["bundle"]): (r["n_items"], r["first_us"]) for r in spark.sql("select * from shuffled").collect()}
    assert got and got.items() <= want.items()
    settled = events.agg(F.max(F.unix_micros("ts"))).first()[0] - 86_400_000_000 - wait - 2000
    assert {k for k, (_, opened) in want.items() if opened < settled} <= got.keys()


def test_bundle_stream_equals_batch(spark, tmp_path):
    spark.conf.set(*STATE_STORE)
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"))
    wait = 3_600_000_000
    batch = bundles.bundle_events(events.withColumn("t", F.unix_micros("ts")), "user_id", "t", "event_id", 4, wait)
    want = {(r["user_id"], r["bundle"]): (r["n"], r["first"]) for r in batch.groupBy("user_id", "bundle").agg(F.count("t").alias("n"), F.min("t").alias("first")).collect()}
    bounds = [r[0] for r in events.select(F.percentile_approx("ts", [0.25, 0.5, 0.75]).alias("q")).select(F.explode("q")).collect()]
    edges = [None, *bounds, None]
    for k in range(4):
        part = events
        part = part.filter(F.col("ts") > edges[k]) if edges[k] else part
        part = part.filter(F.col("ts") <= edges[k + 1]) if edges[k + 1] else part
        part.orderBy("ts").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = bundle_stream(stream, "user_id", "ts", 4, wait).writeStream.outputMode("append").format("memory").queryName("bundles").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination(180)
    got = {(r["user_id"], r["bundle"]): (r["n_items"], r["first_us"]) for r in spark.sql("select * from bundles").collect()}
    last = {}
    for user, bundle in want:
        last[user] = max(last.get(user, -1), bundle)
    assert {k: v for k, v in got.items()}.items() <= want.items()
    assert all(k in got for k in want if k[1] != last[k[0]])
