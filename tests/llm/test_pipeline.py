import random
import threading

import duckdb
import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from llm.test_operators import by_union, similar_pairs
from sonorum.llm import common, mixing, simhash
from sonorum.llm.common import drop_tables, materialize, only_the_last_stays

SF, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_stages_keep_the_columns_and_what_is_clean(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs.count()
    for name, stage in pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, SF), name)
        assert docs.columns == list(pipeline.COLUMNS)
        assert 0.8 * before <= docs.count() <= before
        before = docs.count()
    mixed = pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert all(r["copies"] in (1, 2) and r["taken"] == r["copies"] * r["size"] for r in mixed)
    items = {t for (t,) in duckdb.sql(f"select text from '{SF}/benchmark.parquet'").fetchall()}
    assert not any(item in r["text"] for item in items for r in mixed)
    texts = [r["text"] for r in mixed]
    assert len(set(texts)) == len(texts)


def test_stages_on_awkward_rows(spark):
    words = random.Random(1).choices([f"w{k}" for k in range(900)], k=300)
    rows = [
        (1, " ".join(words), "en", "a", 1), (2, " ".join(words), "en", None, 1), (2, " ".join(words), "en", None, 1), (3, None, None, None, None),
        (4, "", "en", "", 0), (None, "some words without a number", "en", "b", 1), (None, None, None, None, None), (5, "12 34 !!", None, "b", 1),
    ]
    for start in (rows, []):
        for name, stage in pipeline.STAGES:
            df = spark.createDataFrame(start, DOCS).withColumn("fp", F.lit(1))
            assert stage(spark, df, SF).count() <= len(start)
    kept = {r["doc_id"] for r in pipeline.near_dedup(spark, spark.createDataFrame(rows, DOCS), SF).collect()}
    assert kept == {1, 3, 5, None}


def test_texts_with_one_doc_id_all_stay_unless_copied(spark):
    rng = random.Random(4)
    one, two, three = (" ".join(rng.choices([f"w{k}" for k in range(900)], k=100)) for _ in range(3))
    rows = [(1, one, "en", "b", 1), (1, two, "en", "a", 1), (2, three, "en", "a", 1), (3, one, "en", "a", 1), (3, three + " more", "en", "a", 1), (1, one.upper(), "en", "c", 1), (1, one, "en", "a", 1)]
    for order in (rows, rows[::-1]):
        kept = [tuple(r) for r in pipeline.near_dedup(spark, spark.createDataFrame(order, DOCS), SF).collect()]
        assert sorted(kept) == sorted([(1, one.upper(), "en", "c", 1), (1, two, "en", "a", 1), (2, three, "en", "a", 1)])


def test_near_dedup_makes_each_digest_once(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b c", "en", "a", 5)], DOCS)
    found = spark.createDataFrame([(1, 1, b"x", True)], "doc_id bigint, component_id bigint, digest binary, least boolean")
    monkeypatch.setattr(simhash, "similar_documents", lambda *a, **b: found)
    plan = pipeline.near_dedup(spark, docs, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_near_copies_of_the_table_are_one_group(spark):
    """Every pair of different texts with a similarity of 0.8 or more, and no other, by all texts that share a shingle."""
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    rows = [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]
    pairs = similar_pairs(rows)
    texts = {i: t.encode().lower().split() for i, t in rows}
    assert sum(texts[a] != texts[b] for a, b in pairs) >= 5
    want = by_union({i for i, _ in rows}, [*pairs, *((min(i for i, u in texts.items() if u == t), k) for k, t in texts.items())])
    got = {r["doc_id"]: r["component_id"] for r in simhash.similar_documents(docs, pipeline.NEAR_BITS, whole=2, min_shingles=pipeline.LEAST_SHINGLES, max_group=1024).collect()}
    assert got == want
    kept = {r["doc_id"] for r in pipeline.near_dedup(spark, docs, MIDDLE).collect()}
    assert kept == set(want.values())


def test_the_mix_takes_rows_one_by_one(spark):
    """Rows without id, and with one id: the words taken stay near the targets."""
    rng = random.Random(2)
    rows = [(None if k % 3 else k % 5, " ".join(rng.choices("abcdefgh", k=rng.randrange(5, 60))), "en", "abc"[k % 3], 1) for k in range(300)]
    rows += rows[:50]
    docs = spark.createDataFrame(rows, DOCS)
    mixed = pipeline.source_mixing(spark, docs, SF).collect()
    targets = {r["source"]: r["target"] for r in mixing.mix_sources(docs).select("source", "target").distinct().collect()}
    for source, target in targets.items():
        assert abs(sum(r["taken"] for r in mixed if r["source"] == source) - target) <= 60
    assert len(mixed) <= len(rows)


def test_tables_of_two_threads_do_not_meet(spark):
    both, left = threading.Barrier(2), {}

    def work(name):
        with only_the_last_stays(spark):
            first = materialize(spark.range(3), name)
            both.wait()
            last = materialize(first.union(spark.range(4)), name)
            both.wait()
        both.wait()
        left[name] = last.count()

    threads = [threading.Thread(target=work, args=(n,)) for n in ("one", "two")]
    for t in threads:
        t.start()
    for t in threads:
        t.join(120)
    assert left == {"one": 7, "two": 7}
    drop_tables(spark)


def test_run(spark):
    drop_tables(spark)
    assert pipeline.run(spark, SF).count() > 100
    drop_tables(spark)


def test_writes_send_small_batches_and_leave_the_setting_alone(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    with common.small_batches(spark), common.small_batches(spark):
        assert spark.conf.get(key) == str(common.BATCH_ROWS)
    assert spark.conf.get(key) == before
    written = common.materialize(spark.range(0, 5000, 1, 1).mapInArrow(sizes, "n bigint"), "sizes")
    assert written.agg(F.max("n"), F.sum("n")).first() == (common.BATCH_ROWS, 5000)
    assert spark.conf.get(key) == before
    spark.conf.set(key, "200")  # smaller ones stay
    try:
        assert common.materialize(spark.range(0, 5000, 1, 1).mapInArrow(sizes, "n bigint"), "sizes").agg(F.max("n")).first()[0] == 200
        assert spark.conf.get(key) == "200"
    finally:
        spark.conf.set(key, before)
