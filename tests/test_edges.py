import json
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sonorum.functions import scalars
from sonorum.operators import admission, bundles, joins, labels, predict, scoring, signal
from sonorum.session import shared_dir
from sonorum.sources.labels import read_labels


def one(spark, column, **values):
    fields = ", ".join(f"{k} {t}" for k, (t, _) in values.items())
    return spark.createDataFrame([tuple(v for _, v in values.values())], fields).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("name", "want"), [
    ("a.wav", ".wav"), ("a.tar.gz", ".gz"), ("x.mp3/", ".mp3"), ("..a", ".a"), (".bashrc", ".wav"),
    ("a.", ".wav"), ("...", ".wav"), ("a/b.c/d", ".wav"), ("", ".wav"), (None, ".wav"),
])
def test_suffix(spark, name, want):
    assert one(spark, scalars.file_suffix(F.col("n")), n=("string", name)) == want


def test_duration_ties_go_up(spark):
    rows = spark.createDataFrame([(8000,), (8001,), (8008,)], "n long").select(scalars.duration_ms3(F.col("n")).alias("d")).collect()
    assert [r["d"] for r in rows] == [0.5, 0.5, 0.501]


@pytest.mark.parametrize(("row", "rule", "status"), [
    ((0, 16000, None, None), "empty", 422),
    ((1, 16000, None, None), "ok", 200),
    ((26214400, 16000, None, None), "ok", 200),
    ((26214401, 16000, None, None), "too_large", 413),
    ((None, 16000, None, None), "unreadable", 400),
    ((1, 7999, None, None), "bad_duration", 422),
    ((1, 8000, None, None), "ok", 200),
    ((1, 160000, None, None), "ok", 200),
    ((1, 160001, None, None), "bad_duration", 422),
    ((1, None, None, None), "undecodable", 422),
    ((1, 16000, "0", None), "bad_top_k", 422),
    ((1, 16000, "-1", None), "bad_top_k", 422),
    ((1, 16000, "x", None), "bad_top_k", 422),
    ((1, 16000, " 3 ", None), "ok", 200),
    ((0, 16000, "0", "srt"), "bad_format", 422),
    ((1, 16000, None, "text"), "ok", 200),
])
def test_first_failure_wins(spark, row, rule, status):
    df = spark.createDataFrame([row], "payload_bytes long, n_samples long, top_k string, response_format string")
    got = admission.admit(df).first()
    assert (got["rule"], got["status"]) == (rule, status)


def test_model_rules(spark):
    df = spark.createDataFrame([(1, 16000, None, None, "boom", 3), (1, 16000, None, None, None, 0)], "payload_bytes long, n_samples long, top_k string, response_format string, model_error string, n_intents int")
    assert [(r["rule"], r["status"]) for r in admission.admit(df).collect()] == [("inference_failed", 500), ("no_predictions", 500)]


def test_requests_get_defaults(spark):
    row = admission.read_requests(spark.createDataFrame([(1,)], "request_id long")).first()
    assert (row["response_format"], row["temperature"], row["top_k"], row["language"]) == ("json", 0.0, None, None)


def test_softmax_and_top_k(spark):
    logits = [[1000.0, 990.0, 995.0], [2.0, 2.0, 2.0], [5.0]]
    df = spark.createDataFrame([(i, z) for i, z in enumerate(logits)], "id int, z array<double>")
    df = df.withColumn("logits", F.transform("z", lambda v, i: F.struct(i.alias("class_idx"), v.alias("z"))))
    p = df.select("id", scoring.softmax(F.col("logits")).alias("p"))
    for row in p.collect():
        assert math.isclose(sum(c["p"] for c in row["p"]), 1.0)
    best = p.select("id", scoring.top_k(F.col("p"), F.lit(9)).alias("t"), scoring.top_k(F.col("p"), F.lit(1)).alias("o")).orderBy("id").collect()
    assert [c["class_idx"] for c in best[0]["t"]] == [0, 2, 1]
    assert [c["class_idx"] for c in best[1]["t"]] == [0, 1, 2]
    assert [len(r["o"]) for r in best] == [1, 1, 1]
    assert len(best[2]["t"]) == 1


def test_confidence_bounds(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (1.1,), (-0.1,), (float("nan"),), (None,)], "p double")
    assert [r["ok"] for r in df.select(scoring.check_confidence(F.col("p")).alias("ok")).collect()] == [True, True, False, False, False, False]


def test_label_without_a_class_gives_null(spark):
    features = spark.createDataFrame([(1, [1.0, 0.0])], "clip_id int, features array<double>")
    head = spark.createDataFrame([(0, [1.0, 0.0], 0.0), (1, [0.0, 1.0], 0.0)], "class_idx int, weight array<double>, bias double")
    good = spark.createDataFrame([("a", 0), ("b", 1)], "intent string, class_idx int")
    bad = spark.createDataFrame([("a", 0), ("b", 2)], "intent string, class_idx int")
    assert scoring.classify_features(features, head, good).first()["top_intent"] == "a"
    assert scoring.classify_features(features, head, bad).first()["intents"] is None


def test_dense_codes(spark):
    for codes, dense in (([0, 1, 2], True), ([0, 2], False), ([0, 0, 1], False), ([1, 2], False), ([], False), ([0, 1, None], False)):
        df = spark.createDataFrame([(c,) for c in codes], "c int")
        assert labels.check_dense(df, "c").first()["dense"] is dense
    assert [r["code"] for r in labels.missing_codes(spark.createDataFrame([(0,), (3,)], "c int"), "c").orderBy("code").collect()] == [1, 2]


def test_label_file(spark, tmp_path):
    path = tmp_path / "labels.json"
    path.write_text(json.dumps({"intent_to_idx": {"a": 0, "b": " 1 "}, "idx_to_intent": {"0": "a", "1": "b"}}))
    forward, reverse = read_labels(spark, str(path))
    assert labels.validate_labels(forward, reverse).first()["valid"]
    for broken in ({"intent_to_idx": {"a": 0}}, {"intent_to_idx": {"a": "3.7"}, "idx_to_intent": {"0": "a"}}, {"intent_to_idx": {"a": 0}, "idx_to_intent": {"x": "a"}}, [1]):
        path.write_text(json.dumps(broken))
        with pytest.raises(ValueError):
            read_labels(spark, str(path))


def test_bundle_edges(spark):
    rows = [("a", 1, 0), ("a", 2, 5), ("a", 3, 10), ("a", 4, 10), (None, 5, 0), (None, 6, 1), ("b", 7, None), ("b", 8, 3)]
    df = spark.createDataFrame(rows, "k string, o int, t long")

    def run(n, wait):
        return {r["o"]: r["bundle"] for r in bundles.bundle_events(df, "k", "t", "o", n, wait).collect()}

    assert run(9, 10) == {1: 0, 2: 0, 3: 1, 4: 1, 5: 0, 6: 0, 7: 0, 8: 1}
    assert run(9, 0) == {1: 0, 2: 1, 3: 2, 4: 3, 5: 0, 6: 1, 7: 0, 8: 1}
    assert run(1, 100)[4] == 3
    with pytest.raises(ValueError):
        bundles.bundle_events(df, "k", "t", "o", 0, 1)


def test_scores_do_not_depend_on_batches(spark):
    def make():
        def model(x: np.ndarray) -> np.ndarray:
            if (x[:, 0] > 0.9).any():
                raise RuntimeError("no")
            return x * 2

        return model

    rng = np.random.default_rng(1)
    rows = [(i, rng.random(3).tolist()) for i in range(60)] + [(60, None)]
    df = spark.createDataFrame(rows, "id int, mel array<float>")
    seen = []
    for parts, size in ((1, 32), (3, 7), (5, 1)):
        out = predict.score_batches(df.repartition(parts), make, "id", batch_size=size)
        seen.append({r["id"]: (r["logits"] and [round(v, 5) for v in r["logits"]], r["error"]) for r in out.collect()})
    assert seen[0] == seen[1] == seen[2]
    assert seen[0][60] == (None, None)
    assert {i for i, (_, e) in seen[0].items() if e} == {i for i, v in rows if v and np.float32(v[0]) > 0.9}


def test_wrong_number_of_results_is_an_error(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, [2.0])], "id int, mel array<float>")
    out = predict.score_batches(df, lambda: lambda x: np.zeros((len(x) + 1, 2)), "id").collect()
    assert all(r["error"] and r["logits"] is None for r in out)


def test_head_in_blocks_gives_the_same_logits(spark):
    rng = np.random.default_rng(2)
    features = spark.createDataFrame([(i, rng.random(4).tolist()) for i in range(20)], "clip_id int, features array<double>")
    head = spark.createDataFrame([(c, rng.random(4).tolist(), float(c)) for c in range(11)], "class_idx int, weight array<double>, bias double")
    one = {r["clip_id"]: r["logits"] for r in scoring.linear_head(features, head).collect()}
    assert one == {r["clip_id"]: r["logits"] for r in scoring.linear_head_in_blocks(features, head, "clip_id", block_classes=3).collect()}


def test_blocks_keep_repeated_keys_apart(spark):
    features = spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [0.0, 1.0]), (None, [1.0, 1.0])], "clip_id int, features array<double>")
    head = spark.createDataFrame([(0, [1.0, 2.0], 0.0), (1, [3.0, 4.0], 0.0)], "class_idx int, weight array<double>, bias double")
    rows = [(r["clip_id"], [z["z"] for z in r["logits"]]) for r in scoring.linear_head_in_blocks(features, head, "clip_id", block_classes=1).collect()]
    assert sorted(rows, key=repr) == [(1, [1.0, 3.0]), (1, [2.0, 4.0]), (1, [2.0, 4.0]), (None, [3.0, 7.0])]


@pytest.mark.parametrize("names", ["all", "one lacks", "too few"])
def test_classes_in_blocks_equal_one_head(spark, names):
    rng = np.random.default_rng(6)
    rows = [(i % 7, rng.normal(0, 300 if i % 5 == 0 else 1, 4).tolist(), i % 13) for i in range(40)]
    features = spark.createDataFrame([*rows, *rows[:5]], "clip_id int, features array<double>, k int")
    head = spark.createDataFrame([(c, rng.random(4).tolist() if c % 3 else [0.5] * 4, 0.0) for c in range(11)], "class_idx int, weight array<double>, bias double")
    labels = spark.createDataFrame([(f"i{c}", c if names != "one lacks" or c != 4 else 40) for c in range(11 if names != "too few" else 9)], "intent string, class_idx int")
    found = []
    for classify in (scoring.classify_features, lambda *x, **o: scoring.classify_in_blocks(*x, **o, block_classes=3, salts=3)):
        out = classify(features, head, labels, k=F.col("k"), keep=("clip_id", "k")).collect()
        found.append(sorted(((r["clip_id"], r["k"], None if r["intents"] is None else [(i["intent"] if i["confidence"] > 0 else "", round(i["confidence"], 12)) for i in r["intents"]]) for r in out), key=repr))
    assert len(found[0]) == 45 and found[0] == found[1]


def test_only_candidates_are_shuffled_between_blocks(spark):
    features = spark.createDataFrame([(1, [1.0] * 4)], "clip_id int, features array<double>")
    head = spark.createDataFrame([(c, [1.0] * 4, 0.0) for c in range(9)], "class_idx int, weight array<double>, bias double")
    labels = spark.createDataFrame([(f"i{c}", c) for c in range(9)], "intent string, class_idx int")
    plan = scoring.classify_in_blocks(features, head, labels, k=2, block_classes=3)._jdf.queryExecution().executedPlan().toString()
    merged = plan[: plan.index("SortMergeJoin")] if "SortMergeJoin" in plan else plan
    exchange = next(line for line in merged.splitlines() if "Exchange hashpartitioning(row" in line)
    below = merged[merged.index(exchange) :].splitlines()[1]
    assert "collect_list(struct(top" in below and "head" not in below and "weight" not in below


def test_an_empty_head_gives_rows_without_intents(spark):
    features = spark.createDataFrame([(1, [1.0] * 4), (1, [1.0] * 4)], "clip_id int, features array<double>")
    head = spark.createDataFrame([], "class_idx int, weight array<double>, bias double")
    labels = spark.createDataFrame([("a", 0)], "intent string, class_idx int")
    assert [tuple(r) for r in scoring.classify_in_blocks(features, head, labels).collect()] == [(1, None, None, None)] * 2


def test_labels_are_broadcast_by_their_bytes(spark):
    ranked = spark.range(1000).select((F.col("id") % 50).cast("int").alias("class_idx"), "id")
    names = spark.range(20_000).select(F.col("id").cast("int").alias("class_idx"), F.repeat(F.lit("x"), 20).alias("intent"))
    before, kinds = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), []
    try:
        for limit in ("100m", "1k"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            found = labels.attach_labels(ranked, names)
            assert found.count() == 1000 and found.filter("intent is null").isEmpty()
            plan = found._jdf.queryExecution().executedPlan().toString()
            kinds.append("SortMergeJoin" in plan)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert kinds == [False, True]


def test_hot_and_missing_keys_are_dealt_over_tasks(spark):
    """With adaptive execution off: 20,000 rows, a third of one key, a third without, in 16 partitions."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for k, v in zip(before, ("false", "16", "-1"), strict=True):
            spark.conf.set(k, v)
        key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id").cast("string")))
        rows = spark.range(21_000).select("id", key.alias("path"))
        sizes = rows.filter("path is not null").select("path").distinct().withColumn("n", F.length("path"))
        out = joins.join_one_per_key(rows, sizes, "path", least=100).withColumn("part", F.spark_partition_id())
        facts = out.agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"), F.count("n").alias("found")).first()
        assert tuple(facts) == (21_000, 21_000, 14_000)
        assert out.groupBy("part").count().agg(F.max("count")).first()[0] < 3 * 21_000 / 16
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_head_too_large_to_broadcast_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(scoring, "MAX_PACKED_BYTES", 50)
    features = spark.createDataFrame([(1, [1.0] * 4)], "clip_id int, features array<double>")
    head = spark.createDataFrame([(c, [1.0] * 4, 0.0) for c in range(3)], "class_idx int, weight array<double>, bias double")
    with pytest.raises(Exception, match="linear_head_in_blocks"):
        scoring.linear_head(features, head).collect()


def test_sparse_codes(spark):
    codes = spark.createDataFrame([(3_000_000,), (0,)], "c bigint")
    assert labels.missing_codes(codes, "c").count() == 2_999_999
    assert labels.missing_codes(codes.limit(0), "c").count() == 0


def test_list_rows_and_columns():
    rows = [np.array([1, 2], np.int16), None, np.zeros(0, np.int16), np.array([3], np.int16)]
    column = signal.list_column(rows, pa.int16())
    assert column.to_pylist() == [[1, 2], None, [], [3]]
    assert [None if r is None else r.tolist() for r in signal.list_rows(column.slice(1))] == [None, [], [3]]
    assert signal.list_column([None], pa.float32()).to_pylist() == [None]


def test_shared_folder_must_be_named_on_a_cluster():
    class Conf:
        def get(self, name, default):
            return default

    class Session:
        conf, sparkContext = Conf(), type("Context", (), {"master": "spark://host:7077"})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())
