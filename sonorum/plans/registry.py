"""Registered queries of the clip-scoring library and their DuckDB counterparts."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sonorum.functions import envelopes, scalars
from sonorum.operators import admission, bundles, labels, outcomes, predict, scoring, signal
from sonorum.plans import fixtures
from sonorum.plans.classify import classify_audio
from sonorum.plans.fixtures import REQUESTS_SQL, SCORES_SQL, table
from sonorum.session import shared_dir, stored
from sonorum.sources.audio import attach_audio, few_listing_tasks, scan_audio, stream_audio
from sonorum.sources.labels import read_labels
from sonorum.sources.sinks import write_outcomes, write_rejects
from sonorum.streaming.bundles import STATE_STORE, bundle_stream
from sonorum.streaming.clips import classify_stream

Query = Callable[[SparkSession, str], DataFrame]
_FOUND: dict[str, tuple[Query, str | None]] = {}


def _query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        _FOUND[name] = (f, sql)
        return f

    return keep


def _r(column: Column | str, places: int = 6) -> Column:
    return F.round(column, places)


def _folder(spark: SparkSession, what: str) -> str:
    """A new folder among the shared ones."""
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


# ---- sources and sinks ------------------------------------------------------------------------

_FILES_SQL = "SELECT label, sum(length(CAST(vec_id AS VARCHAR)) + 1) AS length, count(*) AS n_lines FROM embeddings GROUP BY label"


def _label_files(spark: SparkSession, sf_dir: str) -> str:
    """A folder with a text file for each label, a line for each of its embeddings."""
    path = _folder(spark, "files")
    lines = table(spark, sf_dir, "embeddings").select("label", F.col("vec_id").cast("string").alias("value"))
    lines.repartition("label").write.partitionBy("label").text(path)
    return path


def _file_facts(files: DataFrame) -> DataFrame:
    lines = F.size(F.split(F.col("content").cast("string"), "\n")) - 1
    return files.select(F.regexp_extract("path", "label=([0-9]+)/", 1).cast("int").alias("label"), "length", lines.cast("bigint").alias("n_lines"))


@_query("a1_scan_audio", _FILES_SQL)
def _scan(spark, sf_dir):
    return _file_facts(scan_audio(spark, _label_files(spark, sf_dir), "*.txt"))


@_query("a2_stream_audio", _FILES_SQL)
def _stream(spark, sf_dir):
    place = _folder(spark, "stream")
    arriving = _file_facts(stream_audio(spark, f"{_label_files(spark, sf_dir)}/*", max_files=3))
    writer = arriving.writeStream.format("parquet").option("checkpointLocation", f"{place}/state")
    writer.trigger(availableNow=True).start(f"{place}/out").awaitTermination()
    return spark.read.schema("label int, length bigint, n_lines bigint").parquet(f"{place}/out")


@_query("a4_read_labels", """SELECT 'forward' AS side, n_name AS intent, CAST(n_nationkey AS INT) AS class_idx FROM nation
UNION ALL SELECT 'reverse', CASE WHEN n_nationkey % 7 = 3 THEN 'X' ELSE n_name END, CAST(n_nationkey AS INT) FROM nation""")
def _read_labels(spark, sf_dir):
    path = _folder(spark, "labels")
    forward, reverse = (f(spark, sf_dir) for f in _NATION_MAPS)
    names = forward.agg(F.map_from_entries(F.collect_list(F.struct("intent", "class_idx"))).alias("intent_to_idx"))
    codes = reverse.agg(F.map_from_entries(F.collect_list(F.struct(F.col("class_idx").cast("string"), "intent"))).alias("idx_to_intent"))
    names.crossJoin(codes).select(F.to_json(F.struct("intent_to_idx", "idx_to_intent")).alias("value")).write.text(path)
    sides = read_labels(spark, path)
    return sides[0].select(F.lit("forward").alias("side"), "intent", "class_idx").unionByName(sides[1].select(F.lit("reverse").alias("side"), "intent", "class_idx"))


# ---- requests ---------------------------------------------------------------------------------


@_query("a3_read_requests", f"WITH {REQUESTS_SQL} SELECT request_id, coalesce(response_format, 'json') AS response_format, CAST(0.0 AS DOUBLE) AS temperature, language, CAST(top_k AS VARCHAR) AS top_k, CAST(NULL AS VARCHAR) AS model FROM req")
def _read_requests(spark, sf_dir):
    return admission.read_requests(fixtures.requests(spark, sf_dir)).select("request_id", "response_format", "temperature", "language", "top_k", "model")


_RULES_SQL = """CASE WHEN response_format IS NOT NULL AND response_format NOT IN ('json', 'verbose_json', 'text') THEN 'bad_format'
  WHEN payload_bytes IS NULL THEN 'unreadable' WHEN payload_bytes = 0 THEN 'empty' WHEN payload_bytes > 26214400 THEN 'too_large'
  WHEN top_k < 1 THEN 'bad_top_k' WHEN n_samples IS NULL THEN 'undecodable' WHEN n_samples NOT BETWEEN 8000 AND 160000 THEN 'bad_duration' ELSE 'ok' END"""
_STATUS_SQL = "CASE rule WHEN 'ok' THEN 200 WHEN 'unreadable' THEN 400 WHEN 'too_large' THEN 413 ELSE 422 END"
_ADMITTED_SQL = f"adm AS (SELECT *, {_STATUS_SQL} AS status FROM (SELECT *, {_RULES_SQL} AS rule FROM req))"


@_query("b_rule_flags", f"""WITH {REQUESTS_SQL} SELECT request_id, coalesce(response_format NOT IN ('json', 'verbose_json', 'text'), false) AS bad_format,
  payload_bytes = 0 AS empty_file, payload_bytes > 26214400 AS too_large, coalesce(top_k < 1, false) AS bad_top_k, n_samples NOT BETWEEN 8000 AND 160000 AS bad_duration FROM req""")
def _rule_flags(spark, sf_dir):
    r = fixtures.requests(spark, sf_dir)
    early = {name: fails for fails, name, _, _ in admission.early_rules(F.lit(True), F.col("payload_bytes"), F.col("response_format"), F.col("top_k"))}
    return r.select("request_id", early["bad_format"].alias("bad_format"), early["empty"].alias("empty_file"), early["too_large"].alias("too_large"), early["bad_top_k"].alias("bad_top_k"), admission.bad_duration(F.col("n_samples")).alias("bad_duration"))


_DETAIL_SQL = """CASE rule WHEN 'bad_format' THEN 'response_format must be one of json, verbose_json, text'
  WHEN 'empty' THEN 'Audio upload is empty' WHEN 'too_large' THEN 'Audio upload exceeds the 25 MB limit' WHEN 'bad_top_k' THEN 'top_k must be >= 1'
  WHEN 'bad_duration' THEN printf('Audio duration must be between 0.5 and 10 seconds (received %.3f seconds).', floor((n_samples * 1000 + 8000) / 16000) / 1000.0::DOUBLE) END"""


@_query("b10_admit", f"WITH {REQUESTS_SQL}, {_ADMITTED_SQL} SELECT request_id, rule, status, {_DETAIL_SQL} AS detail FROM adm")
def _admit(spark, sf_dir):
    return admission.admit(fixtures.requests(spark, sf_dir)).select("request_id", "rule", "status", "detail")


_MODEL_RULES_SQL = """CASE WHEN rule <> 'ok' THEN rule WHEN request_id % 5 = 0 THEN 'undecodable' WHEN request_id % 7 = 1 OR request_id % 11 = 4 THEN 'inference_failed' WHEN request_id % 3 = 0 THEN 'no_predictions' ELSE 'ok' END"""


@_query("b6_b8_b9_model_rules", f"""WITH {REQUESTS_SQL}, {_ADMITTED_SQL}, late AS (SELECT request_id, n_samples, {_MODEL_RULES_SQL} AS rule FROM adm)
SELECT request_id, rule, CASE rule WHEN 'inference_failed' THEN 500 WHEN 'no_predictions' THEN 500 WHEN 'ok' THEN 200 WHEN 'unreadable' THEN 400 WHEN 'too_large' THEN 413 ELSE 422 END AS status,
  CASE rule WHEN 'undecodable' THEN 'Unable to decode the uploaded audio.' WHEN 'inference_failed' THEN CASE WHEN request_id % 11 = 4 THEN '{{"error":"Inference failed","message":"Audio preprocessing failed: no sound at ' || request_id || '"}}' ELSE '{{"error":"Inference failed","message":"Model inference failed: out of memory at ' || request_id || '"}}' END
    WHEN 'no_predictions' THEN 'Model returned no intent predictions' ELSE {_DETAIL_SQL} END AS detail FROM late""")
def _model_rules(spark, sf_dir):
    r, i = fixtures.requests(spark, sf_dir), F.col("request_id")
    told = r.withColumns({
        "decode_error": F.when((i % 5 == 0) & F.col("n_samples").between(8000, 160000), "no frames"),
        "signal_error": F.when(i % 11 == 4, F.concat(F.lit("no sound at "), i.cast("string"))), "model_error": F.when(i % 7 == 1, F.concat(F.lit("out of memory at "), i.cast("string"))), "n_intents": F.when(i % 3 == 0, 0).otherwise(5),
    })
    return admission.admit(told).select("request_id", "rule", "status", "detail")


@_query("b11_check_confidence", "SELECT event_id, coalesce(value / 100 BETWEEN 0 AND 1, false) AS in_range FROM events")
def _check_confidence(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", scoring.check_confidence(F.col("value") / 100).alias("in_range"))


@_query("c1_c2_top_k", f"WITH {REQUESTS_SQL} SELECT request_id, coalesce(top_k, 5) AS k, least(coalesce(top_k, 5), 10) AS clamped FROM req")
def _top_k_number(spark, sf_dir):
    k = scalars.resolve_top_k(F.col("top_k"))
    return fixtures.requests(spark, sf_dir).select("request_id", k.alias("k"), scalars.clamp_top_k(k, 10).alias("clamped"))


@_query("c3_c4_duration", f"WITH {REQUESTS_SQL} SELECT request_id, n_samples / 16000.0::DOUBLE AS duration_s, floor((n_samples * 1000 + 8000) / 16000) / 1000.0::DOUBLE AS duration_ms3 FROM req")
def _duration(spark, sf_dir):
    n = F.col("n_samples")
    return fixtures.requests(spark, sf_dir).select("request_id", scalars.duration_s(n).alias("duration_s"), scalars.duration_ms3(n).alias("duration_ms3"))


@_query("c5_file_suffix", r"SELECT page_id, coalesce(nullif(regexp_extract(regexp_extract(url, '([^/]*)/*$', 1), '(?s)^.+(\.[^.]+)$', 1), ''), '.wav') AS suffix FROM pages")
def _suffix(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", scalars.file_suffix(F.col("url")).alias("suffix"))


@_query("c6_default_language", f"WITH {REQUESTS_SQL} SELECT request_id, coalesce(nullif(language, ''), 'en') AS language FROM req")
def _language(spark, sf_dir):
    return fixtures.requests(spark, sf_dir).select("request_id", scalars.default_language(F.col("language")).alias("language"))


@_query("c7_scale_pcm", "SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: floor(x * 1000) / 32768.0::DOUBLE)), 6) AS total, round(floor(embedding[1] * 1000) / 32768.0::DOUBLE, 6) AS first FROM embeddings")
def _scale(spark, sf_dir):
    pcm = F.transform("embedding", lambda x: F.floor(x * 1000))
    scaled = table(spark, sf_dir, "embeddings").select("vec_id", scalars.scale_pcm(pcm).alias("s"))
    return scaled.select("vec_id", _r(F.aggregate("s", F.lit(0.0), lambda a, x: a + x)).alias("total"), _r(F.get("s", F.lit(0))).alias("first"))


@_query("c8_pad_or_trim", "SELECT vec_id, len(list_resize(embedding, 100, 0.0)) AS n_long, len(embedding[1:10]) AS n_short, round(list_sum(list_transform((list_resize(embedding, 100, 0.0))[65:100], lambda x: abs(x)))::DOUBLE, 6) AS padding, round(embedding[10]::DOUBLE, 6) AS last FROM embeddings")
def _pad(spark, sf_dir):
    vec = F.col("embedding").cast("array<double>")
    e = table(spark, sf_dir, "embeddings").select("vec_id", scalars.pad_or_trim(vec, 100).alias("long"), scalars.pad_or_trim(vec, 10).alias("short"))
    return e.select("vec_id", F.size("long").alias("n_long"), F.size("short").alias("n_short"), F.abs(F.aggregate(F.slice("long", 65, 36), F.lit(0.0), lambda a, x: a + x)).alias("padding"), _r(F.element_at("short", -1)).alias("last"))


# ---- scoring ----------------------------------------------------------------------------------


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.linear_head(fixtures.clips(spark, sf_dir), fixtures.head(spark, sf_dir))


def _long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select("clip_id", F.explode("logits").alias("c")).select("clip_id", "c.class_idx", "c.z")


@_query("e4_linear_head", f"WITH {SCORES_SQL} SELECT clip_id, class_idx, round(z, 6) AS z FROM z")
def _linear_head(spark, sf_dir):
    return _long(spark, sf_dir).select("clip_id", "class_idx", _r("z").alias("z"))


@_query("f1_mean_pool", "SELECT label, d AS dim, round(avg(v), 6) AS value FROM (SELECT label, unnest(embedding)::DOUBLE AS v, unnest(range(len(embedding))) AS d FROM embeddings) GROUP BY ALL")
def _mean_pool(spark, sf_dir):
    pooled = scoring.mean_pool(fixtures.clips(spark, sf_dir), "label", "features")
    return pooled.select("label", F.posexplode("features").alias("dim", "value")).select("label", F.col("dim").cast("bigint").alias("dim"), _r("value").alias("value"))


@_query("f1_mean_pool_long", "SELECT label, d AS dim, round(avg(v), 6) AS value FROM (SELECT label, unnest(embedding)::DOUBLE AS v, unnest(range(len(embedding))) AS d FROM embeddings) GROUP BY ALL")
def _mean_pool_long(spark, sf_dir):
    return scoring.mean_pool_long(fixtures.clips(spark, sf_dir), "label", "features").select("label", F.col("dim").cast("bigint").alias("dim"), _r("value").alias("value"))


@_query("f2_softmax", f"WITH {SCORES_SQL} SELECT clip_id, class_idx, round(p, 6) AS p FROM p")
def _softmax(spark, sf_dir):
    rows = _scored(spark, sf_dir).select("clip_id", F.explode(scoring.softmax(F.col("logits"))).alias("c"))
    return rows.select("clip_id", "c.class_idx", _r("c.p").alias("p"))


@_query("f2_softmax_long", f"WITH {SCORES_SQL} SELECT clip_id, class_idx, round(p, 6) AS p FROM p")
def _softmax_long(spark, sf_dir):
    return scoring.softmax_long(_long(spark, sf_dir), "clip_id").select("clip_id", "class_idx", _r("p").alias("p"))


def _dense_sql(table: str, column: str) -> str:
    dense = f"coalesce(count(*) > 0 AND count(*) = count(DISTINCT {column}) AND min({column}) = 0 AND max({column}) = count(*) - 1, false)"
    return f"SELECT '{column}' AS code, count(*) AS n, count(DISTINCT {column}) AS n_distinct, {dense} AS dense FROM {table}"


@_query("f3_check_dense", " UNION ALL ".join(_dense_sql(*x) for x in (("nation", "n_nationkey"), ("part", "p_size"), ("region", "r_regionkey"))))
def _check_dense(spark, sf_dir):
    found = [labels.check_dense(table(spark, sf_dir, t), c).select(F.lit(c).alias("code"), "n", "n_distinct", "dense") for t, c in (("nation", "n_nationkey"), ("part", "p_size"), ("region", "r_regionkey"))]
    return found[0].unionByName(found[1]).unionByName(found[2])


@_query("f3_missing_codes", "SELECT c AS code FROM (SELECT unnest(range(0, (SELECT max(p_size) FROM part) + 1)) AS c) WHERE c NOT IN (SELECT p_size FROM part)")
def _missing(spark, sf_dir):
    return labels.missing_codes(table(spark, sf_dir, "part"), "p_size")


@_query("f4_check_width", "SELECT vec_id AS clip_id, len(embedding) = 64 AS width_ok, len(embedding) = 10 AS narrow_ok FROM embeddings")
def _check_width(spark, sf_dir):
    c = scoring.check_width(fixtures.clips(spark, sf_dir), 64, "features").select("clip_id", "features", "width_ok")
    return scoring.check_width(c.withColumnRenamed("width_ok", "wide"), 10, "features").select("clip_id", F.col("wide").alias("width_ok"), F.col("width_ok").alias("narrow_ok"))


@_query("g1_top_k", f"WITH {SCORES_SQL} SELECT clip_id, rank, class_idx, round(p, 6) AS p FROM r WHERE rank <= clip_id % 12 + 1")
def _top_k(spark, sf_dir):
    ranked = _scored(spark, sf_dir).select("clip_id", F.posexplode(scoring.top_k(scoring.softmax(F.col("logits")), (F.col("clip_id") % 12 + 1).cast("int"))).alias("at", "c"))
    return ranked.select("clip_id", (F.col("at") + 1).cast("bigint").alias("rank"), "c.class_idx", _r("c.p").alias("p"))


@_query("g2_top_k_rows", f"WITH {SCORES_SQL} SELECT clip_id, rank, class_idx, round(p, 6) AS p FROM r WHERE rank <= clip_id % 12 + 1")
def _top_k_rows(spark, sf_dir):
    long = scoring.softmax_long(_long(spark, sf_dir), "clip_id").withColumn("k", F.col("clip_id") % 12 + 1)
    return scoring.top_k_rows(long, "clip_id", "k").select("clip_id", F.col("rank").cast("bigint").alias("rank"), "class_idx", _r("p").alias("p"))


@_query("g3_top_1", f"WITH {SCORES_SQL} SELECT clip_id, class_idx, round(p, 6) AS p FROM r WHERE rank = 1")
def _top_1(spark, sf_dir):
    best = _scored(spark, sf_dir).select("clip_id", scoring.top_1(scoring.softmax(F.col("logits"))).alias("c"))
    return best.select("clip_id", "c.class_idx", _r("c.p").alias("p"))


@_query("g3_top_1_rows", f"WITH {SCORES_SQL} SELECT clip_id, class_idx, round(p, 6) AS p FROM r WHERE rank = 1")
def _top_1_rows(spark, sf_dir):
    return scoring.top_1_rows(scoring.softmax_long(_long(spark, sf_dir), "clip_id"), "clip_id").select("clip_id", "class_idx", _r("p").alias("p"))


@_query("g4_list_labels", "SELECT DISTINCT label AS class_idx, 'INTENT_' || label AS intent FROM embeddings")
def _list_labels(spark, sf_dir):
    return labels.list_labels(fixtures.labels(spark, sf_dir))


@_query("e1_attach_labels", f"WITH {SCORES_SQL} SELECT clip_id, class_idx, CASE WHEN class_idx = 7 THEN NULL ELSE 'INTENT_' || class_idx END AS intent FROM r WHERE rank <= 3")
def _attach_labels(spark, sf_dir):
    ranked = scoring.top_k_rows(scoring.softmax_long(_long(spark, sf_dir), "clip_id"), "clip_id", 3)
    return labels.attach_labels(ranked, fixtures.labels(spark, sf_dir).filter("class_idx <> 7")).select("clip_id", "class_idx", "intent")


_NATION_MAPS = (
    lambda spark, sf_dir: table(spark, sf_dir, "nation").select(F.col("n_name").alias("intent"), F.col("n_nationkey").cast("int").alias("class_idx")),
    lambda spark, sf_dir: table(spark, sf_dir, "nation").select(F.when(F.col("n_nationkey") % 7 == 3, "X").otherwise(F.col("n_name")).alias("intent"), F.col("n_nationkey").cast("int").alias("class_idx")),
)


@_query("e2_label_mismatches", "SELECT CAST(n_nationkey AS INT) AS class_idx, n_name AS forward_intent, 'X' AS reverse_intent FROM nation WHERE n_nationkey % 7 = 3")
def _mismatches(spark, sf_dir):
    return labels.label_mismatches(*(f(spark, sf_dir) for f in _NATION_MAPS))


@_query("q4_validate_labels", f"""WITH f AS ({_dense_sql("nation", "n_nationkey")}),
n AS (SELECT n_nationkey AS k, n_name AS a, CASE WHEN n_nationkey % 7 = 3 THEN 'X' ELSE n_name END AS b FROM nation),
m AS (SELECT count(*) AS n_mismatches FROM n AS x FULL JOIN n AS y ON x.k = y.k WHERE x.a IS DISTINCT FROM y.b)
SELECT f.n AS n_classes, f.dense AS forward_dense, f.dense AS reverse_dense, n_mismatches, f.dense AND n_mismatches = 0 AS valid FROM f, m""")
def _validate(spark, sf_dir):
    return labels.validate_labels(*(f(spark, sf_dir) for f in _NATION_MAPS))


@_query("q1_classify_features", f"""WITH {SCORES_SQL}
SELECT clip_id, string_agg('INTENT_' || class_idx, ',' ORDER BY rank) AS intents, round(sum(p), 6) AS mass,
  first('INTENT_' || class_idx ORDER BY rank) AS top_intent, round(max(p), 6) AS confidence FROM r WHERE rank <= 5 GROUP BY clip_id""")
def _classify_features(spark, sf_dir):
    found = scoring.classify_features(fixtures.clips(spark, sf_dir), fixtures.head(spark, sf_dir), fixtures.labels(spark, sf_dir))
    names = F.array_join(F.transform("intents", lambda i: i["intent"]), ",")
    return found.select("clip_id", names.alias("intents"), _r(F.aggregate("intents", F.lit(0.0), lambda s, i: s + i["confidence"])).alias("mass"), "top_intent", _r("confidence").alias("confidence"))


@_query("q1_classify_in_blocks", f"""WITH {SCORES_SQL}
SELECT clip_id, string_agg('INTENT_' || class_idx, ',' ORDER BY rank) AS intents, round(sum(p), 6) AS mass,
  first('INTENT_' || class_idx ORDER BY rank) AS top_intent, round(max(p), 6) AS confidence FROM r, (SELECT unnest([1, 2]) AS again) WHERE rank <= 5 GROUP BY clip_id, again""")
def _classify_in_blocks(spark, sf_dir):
    """Every clip twice, by a head that is read three classes at a time."""
    twice = fixtures.clips(spark, sf_dir).withColumn("again", F.explode(F.array(F.lit(1), F.lit(2))))
    found = scoring.classify_in_blocks(twice, fixtures.head(spark, sf_dir), fixtures.labels(spark, sf_dir), block_classes=3)
    names = F.array_join(F.transform("intents", lambda i: i["intent"]), ",")
    return found.select("clip_id", names.alias("intents"), _r(F.aggregate("intents", F.lit(0.0), lambda s, i: s + i["confidence"])).alias("mass"), "top_intent", _r("confidence").alias("confidence"))


@_query("e4_linear_head_in_blocks", f"WITH {SCORES_SQL} SELECT clip_id, class_idx, round(z, 6) AS z FROM z")
def _linear_head_in_blocks(spark, sf_dir):
    found = scoring.linear_head_in_blocks(fixtures.clips(spark, sf_dir), fixtures.head(spark, sf_dir), "clip_id", block_classes=3)
    return found.select("clip_id", F.explode("logits").alias("l")).select("clip_id", "l.class_idx", _r("l.z").alias("z"))


# ---- outcomes ---------------------------------------------------------------------------------

_OUTCOMES_SQL = f"{REQUESTS_SQL}, {_ADMITTED_SQL}, o AS (SELECT *, CASE WHEN status = 200 THEN event_type END AS top_intent, CASE WHEN status = 200 THEN value / 600 END AS confidence, n_samples / 16000.0::DOUBLE AS duration_s FROM adm)"


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok = F.col("status") == 200
    return admission.admit(fixtures.requests(spark, sf_dir)).select("*", F.when(ok, F.col("event_type")).alias("top_intent"), F.when(ok, F.col("value") / 600).alias("confidence"), scalars.duration_s(F.col("n_samples")).alias("duration_s"))


@_query("q3_admission_report", f"WITH {REQUESTS_SQL}, {_ADMITTED_SQL} SELECT rule, status, count(*) AS n, round(avg(n_samples / 16000.0::DOUBLE), 6) AS mean_seconds, max(coalesce(top_k, 5)) AS max_top_k FROM adm GROUP BY ALL")
def _report(spark, sf_dir):
    return admission.admission_report(fixtures.requests(spark, sf_dir)).withColumn("mean_seconds", _r("mean_seconds"))


@_query("f6_run_summary", f"WITH {_OUTCOMES_SQL} SELECT status, top_intent, count(*) AS n, round(avg(confidence), 6) AS mean_confidence, round(sum(duration_s), 4) AS seconds FROM o GROUP BY ALL")
def _summary(spark, sf_dir):
    return outcomes.run_summary(_outcomes(spark, sf_dir)).withColumns({"mean_confidence": _r("mean_confidence"), "seconds": _r("seconds", 4)})


@_query("s1_all_outcomes", f"WITH {_OUTCOMES_SQL} SELECT request_id, status, top_intent, CASE WHEN status <> 200 THEN rule END AS rule FROM o")
def _all(spark, sf_dir):
    o = _outcomes(spark, sf_dir)
    return outcomes.all_outcomes(o.filter("status = 200").select("request_id", "status", "top_intent"), o.filter("status <> 200").select("request_id", "status", "rule"))


@_query("e5_unanswered", f"WITH {REQUESTS_SQL}, {_ADMITTED_SQL} SELECT request_id FROM adm WHERE rule IN ('empty', 'too_large')")
def _unanswered(spark, sf_dir):
    return outcomes.unanswered(fixtures.requests(spark, sf_dir), _outcomes(spark, sf_dir).filter("rule not in ('empty', 'too_large')")).select("request_id")


@_query("e5_answered_twice", f"WITH {REQUESTS_SQL}, {_ADMITTED_SQL} SELECT request_id, 2 AS n FROM adm WHERE rule = 'ok'")
def _twice(spark, sf_dir):
    o = _outcomes(spark, sf_dir)
    return outcomes.answered_twice(o.unionByName(o.filter("rule = 'ok'")))


@_query("f5_reconcile", f"WITH {REQUESTS_SQL}, {_ADMITTED_SQL} SELECT user_id, n_requests, n_outcomes FROM (SELECT user_id, count(*) AS n_requests, count(*) FILTER (WHERE rule <> 'too_large') AS n_outcomes FROM adm GROUP BY ALL) WHERE n_requests <> n_outcomes")
def _reconcile(spark, sf_dir):
    return outcomes.reconcile(fixtures.requests(spark, sf_dir), _outcomes(spark, sf_dir).filter("rule <> 'too_large'"), "user_id")


@_query("e3_attach_audio", "SELECT event_id AS request_id, CASE WHEN page_id IS NOT NULL THEN strlen(html) END AS payload_bytes, CASE WHEN event_type <> 'error' THEN md5(html) END AS body FROM events LEFT JOIN pages ON page_id = event_id")
def _attach_audio(spark, sf_dir):
    files = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("path"), F.octet_length("html").cast("bigint").alias("length"), F.encode("html", "UTF-8").alias("content"))
    asked = table(spark, sf_dir, "events").select(F.col("event_id").alias("request_id"), F.col("event_id").cast("string").alias("path"), "event_type")
    found = attach_audio(asked, files, asked.filter("event_type <> 'error'"))
    return found.select("request_id", "payload_bytes", F.md5("content").alias("body"))


_FIELDS_SQL = "floor((n_samples * 1000 + 8000) / 16000) / 1000.0::DOUBLE"


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _outcomes(spark, sf_dir).filter("status = 200")
    return o.withColumn("intents", F.array(F.struct(F.col("top_intent").alias("intent"), F.col("confidence").alias("confidence"))))


@_query("a5_write_outcomes", f"""WITH {_OUTCOMES_SQL}
SELECT 'json' AS fmt, status, count(*) AS n, count(DISTINCT top_intent) AS n_intents, CAST(sum(request_id) AS BIGINT) AS ids FROM o GROUP BY status
UNION ALL SELECT 'parquet', status, count(*), count(DISTINCT top_intent), CAST(sum(request_id) AS BIGINT) FROM o GROUP BY status
UNION ALL SELECT 'text', 200, count(*), count(DISTINCT top_intent), NULL FROM o WHERE status = 200""")
def _write_outcomes(spark, sf_dir):
    place, o = _folder(spark, "outcomes"), _outcomes(spark, sf_dir).withColumn("response", F.col("top_intent"))
    found = None
    for fmt in ("json", "parquet", "text"):
        write_outcomes(o, f"{place}/{fmt}", fmt)
        read = spark.read.text(f"{place}/{fmt}").withColumnRenamed("value", "top_intent").withColumn("request_id", F.lit(None).cast("bigint")) if fmt == "text" else spark.read.schema(o.schema).format(fmt).load(f"{place}/{fmt}")
        facts = read.groupBy(F.lit(fmt).alias("fmt"), F.col("status").cast("int").alias("status")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("top_intent").alias("n_intents"), F.sum("request_id").alias("ids"))
        found = facts if found is None else found.unionByName(facts)
    return found


@_query("a6_write_rejects", f"WITH {_OUTCOMES_SQL} SELECT request_id, 'file-' || request_id AS path, status, rule, {_DETAIL_SQL} AS detail FROM o WHERE status <> 200")
def _write_rejects(spark, sf_dir):
    place = _folder(spark, "rejects")
    write_rejects(_outcomes(spark, sf_dir).withColumn("path", F.concat(F.lit("file-"), F.col("request_id").cast("string"))), place, "json")
    return spark.read.schema("request_id bigint, path string, rule string, detail string, status int").json(place).select("request_id", "path", "status", "rule", "detail")


@_query("c9_json_envelope", f"WITH {_OUTCOMES_SQL} SELECT request_id, top_intent AS text, top_intent, round(confidence, 6) AS confidence, 'duration' AS kind, {_FIELDS_SQL} AS seconds FROM o WHERE status = 200")
def _json(spark, sf_dir):
    made = _answers(spark, sf_dir).select("request_id", envelopes.json_envelope(F.col("top_intent"), F.col("confidence"), F.col("n_samples")).alias("j"))
    read = made.select("request_id", F.from_json("j", "text string, top_intent string, confidence double, usage struct<type:string,seconds:double>").alias("j"))
    return read.select("request_id", "j.text", "j.top_intent", _r("j.confidence").alias("confidence"), F.col("j.usage.type").alias("kind"), F.col("j.usage.seconds").alias("seconds"))


@_query("c10_verbose_envelope", f"""WITH {_OUTCOMES_SQL} SELECT request_id, 'transcribe' AS task, coalesce(nullif(language, ''), 'en') AS language, {_FIELDS_SQL} AS duration, top_intent AS text,
  1 AS n_segments, {_FIELDS_SQL} AS segment_end, 1.0::DOUBLE AS compression_ratio, 0 AS n_tokens, round(confidence, 6) AS confidence, 1 AS n_intents, 'spark' AS device FROM o WHERE status = 200""")
def _verbose(spark, sf_dir):
    made = _answers(spark, sf_dir).select("request_id", envelopes.verbose_envelope(F.col("top_intent"), F.col("confidence"), F.col("n_samples"), F.col("language"), F.col("intents")).alias("j"))
    kind = "task string, language string, duration double, text string, segments array<struct<id:int,start:double,end:double,text:string,avg_logprob:double,compression_ratio:double,no_speech_prob:double,temperature:double,tokens:array<int>,seek:int>>, top_intent string, confidence double, intents array<struct<intent:string,confidence:double>>, device string"
    j = made.select("request_id", F.from_json("j", kind).alias("j"))
    s = F.get("j.segments", F.lit(0))
    return j.select("request_id", "j.task", "j.language", "j.duration", "j.text", F.size("j.segments").alias("n_segments"), s["end"].alias("segment_end"), s["compression_ratio"].alias("compression_ratio"), F.size(s["tokens"]).alias("n_tokens"), _r("j.confidence").alias("confidence"), F.size("j.intents").alias("n_intents"), "j.device")


@_query("c11_c12_render", f"""WITH {_OUTCOMES_SQL} SELECT request_id, CASE WHEN response_format = 'text' THEN top_intent END AS text,
  CASE response_format WHEN 'text' THEN 'text' WHEN 'verbose_json' THEN 'verbose' ELSE 'json' END AS kind FROM o WHERE status = 200""")
def _render(spark, sf_dir):
    made = _answers(spark, sf_dir).select("request_id", envelopes.render(F.col("response_format"), F.col("top_intent"), F.col("confidence"), F.col("n_samples"), F.col("language"), F.col("intents")).alias("r"))
    kind = F.when(~F.col("r").startswith("{"), "text").when(F.get_json_object("r", "$.task").isNotNull(), "verbose").otherwise("json")
    return made.select("request_id", F.when(kind == "text", F.col("r")).alias("text"), kind.alias("kind"))


# ---- signals and models -----------------------------------------------------------------------


@_query("d3_frame_signal", """SELECT vec_id, CAST(i AS INT) AS frame_idx, round(list_sum(list_transform(embedding[i * 8 + 1 : i * 8 + 16], lambda x: x::DOUBLE * x::DOUBLE)), 6) AS energy
FROM (SELECT vec_id, embedding, unnest(range(0, 7)) AS i FROM embeddings)""")
def _frames(spark, sf_dir):
    vec = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    framed = signal.frame_signal(vec, "vec_id", "v", 16, 8)
    return framed.select("vec_id", "frame_idx", _r(F.aggregate("frame", F.lit(0.0), lambda s, x: s + x * x)).alias("energy"))


def _dealt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The embeddings, a small file of much work, dealt over all cores."""
    return table(spark, sf_dir, "embeddings").repartition(spark.sparkContext.defaultParallelism)


def _signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second of sound for each embedding: its values as samples, over and over."""
    once = F.transform("embedding", lambda x: F.greatest(F.least(F.floor(x.cast("double") * 8000), F.lit(32767)), F.lit(-32768)).cast("smallint"))
    return _dealt(spark, sf_dir).select("vec_id", F.flatten(F.array_repeat(once, 250)).alias("samples"))


#: Spectra of a clip in SQL: 400 samples from frame f of the sound that _signals() makes (silence before and after), a periodic Hann window, 201 bins, 80 triangles
#: on the mel scale. Frames 2 to 98 lie in the sound, where the even ones are alike and the odd ones too (160 mod 64 is 32); those of 102 and later are silence alone.
_MEL_SQL = """
once AS (SELECT vec_id, list_transform(embedding, lambda x: greatest(least(floor(x::DOUBLE * 8000), 32767), -32768) / 32768.0::DOUBLE) AS s FROM embeddings),
basis AS (SELECT k, i, (0.5 - 0.5 * cos(2 * pi() * i / 400)) * cos(2 * pi() * k * i / 400) AS re, (0.5 - 0.5 * cos(2 * pi() * i / 400)) * sin(2 * pi() * k * i / 400) AS im
  FROM (SELECT unnest(range(201)) AS k), (SELECT unnest(range(400)) AS i)),
folded AS (SELECT f, k, (f * 160 - 200 + i) % 64 AS j, sum(re) AS re, sum(im) AS im
  FROM basis, (SELECT unnest([0, 1, 50, 51, 99, 100, 101]) AS f) WHERE f * 160 - 200 + i BETWEEN 0 AND 250 * 64 - 1 GROUP BY ALL),
flat AS (SELECT vec_id, unnest(s) AS v, unnest(range(64)) AS j FROM once),
power AS (SELECT vec_id, f, k, sum(v * re) ** 2 + sum(v * im) ** 2 AS p FROM flat JOIN folded USING (j) GROUP BY ALL),
edge AS (SELECT m, 700 * (10 ** (m * 2595 * log10(1 + 8000 / 700.0::DOUBLE) / 81 / 2595) - 1) AS hz FROM (SELECT unnest(range(82)) AS m)),
filter AS (SELECT b.m, k, greatest(least((k * 40 - a.hz) / (b.hz - a.hz), (c.hz - k * 40) / (c.hz - b.hz)), 0) * 2 / (c.hz - a.hz) AS w
  FROM edge AS a JOIN edge AS b ON b.m = a.m + 1 JOIN edge AS c ON c.m = a.m + 2, (SELECT unnest(range(201)) AS k)),
mel AS (SELECT vec_id, f, m, log10(greatest(sum(p * w), 1e-10)) AS e FROM power JOIN filter USING (k) WHERE w > 0 GROUP BY ALL),
low AS (SELECT vec_id, greatest(max(e) - 8, -10) AS low FROM mel GROUP BY vec_id)"""


@_query("d4_log_mel", f"""WITH {_MEL_SQL}
SELECT vec_id, 80 * 3000 AS n, count(*) FILTER (WHERE f = 50) AS n_bands, round((greatest(max(e) FILTER (WHERE f = 50), low) + 4) / 4, 2) AS heard,
  CAST(coalesce(sum(CASE f WHEN 50 THEN 49 WHEN 51 THEN 48 ELSE 1 END) FILTER (WHERE m = 11 AND (e + 4) / 4 > (low + 4) / 4 + 1e-4), 0) AS INT) AS n_frames
FROM mel JOIN low USING (vec_id) GROUP BY vec_id, low""")
def _log_mel(spark, sf_dir):
    """n_frames counts the frames whose eleventh band is heard above the silence that pads the clip."""
    mel = signal.log_mel(_signals(spark, sf_dir), "vec_id").select("vec_id", F.size("mel").alias("n"), F.transform(F.sequence(F.lit(0), F.lit(79)), lambda m: F.get("mel", m * 3000 + 50)).alias("heard"), F.slice("mel", 10 * 3000 + 1, 3000).alias("band"))
    sounding = F.filter("band", lambda x: x > F.element_at("band", -1) + 1e-4)
    return mel.select("vec_id", "n", F.size("heard").alias("n_bands"), _r(F.array_max("heard").cast("double"), 2).alias("heard"), F.size(sounding).alias("n_frames"))


def _wav_bytes(samples: Column, times: Column, rate: Column | None = None, channels: Column | None = None) -> Column:
    """16-bit WAV files, mono at 16 kHz or as told, made by Spark: a RIFF header before the little-endian samples, so many times over."""
    rate, channels = F.lit(16000) if rate is None else rate, F.lit(1) if channels is None else channels

    def little(n: Column, size: int) -> Column:
        text = F.lpad(F.hex(n), 2 * size, "0")
        return F.concat(*[F.substring(text, 2 * (size - k) - 1, 2) for k in range(size)])

    once = F.array_join(F.transform(samples, lambda x: little(F.pmod(x.cast("int"), F.lit(65536)), 2)), "")
    body = F.repeat(once, times)
    n = F.size(samples) * times * 2
    kind = F.concat(little(channels, 2), little(rate, 4), little(rate * channels * 2, 4), little(channels * 2, 2))
    head = F.concat(F.lit("52494646"), little(n + 36, 4), F.lit("57415645666d7420100000000100"), kind, F.lit("100064617461"), little(n, 4))
    return F.unhex(F.concat(head, body))


@_query("d1_d2_decode_clips", "SELECT vec_id, CASE WHEN vec_id % 5 = 0 THEN NULL ELSE 6400 END AS n_samples, CASE WHEN vec_id % 5 = 0 THEN NULL ELSE CAST(100 * list_sum(list_transform(embedding, lambda x: CAST(greatest(least(floor(x::DOUBLE * 8000), 32767), -32768) AS BIGINT))) AS BIGINT) END AS total, vec_id % 5 = 0 AS failed FROM embeddings")
def _decode(spark, sf_dir):
    once = F.transform("embedding", lambda x: F.greatest(F.least(F.floor(x.cast("double") * 8000), F.lit(32767)), F.lit(-32768)).cast("smallint"))
    clips = _dealt(spark, sf_dir).select("vec_id", once.alias("s"))
    content = F.when(F.col("vec_id") % 5 == 0, F.encode(F.lit("RIFF and no more"), "UTF-8")).otherwise(_wav_bytes(F.col("s"), F.lit(100)))
    found = signal.decode_clips(clips.select("vec_id", content.alias("content")), key="vec_id")
    total = F.aggregate("samples", F.lit(0).cast("bigint"), lambda a, x: a + x)
    return found.select("vec_id", "n_samples", total.alias("total"), F.col("error").isNotNull().alias("failed"))


@_query("d2_mono_16k", """WITH c AS (SELECT vec_id, CASE vec_id % 4 WHEN 0 THEN 8000 WHEN 1 THEN 22050 WHEN 2 THEN 44100 ELSE 16000 END AS rate, 1 + vec_id % 2 AS channels,
  2 * CAST(floor(embedding[1]::DOUBLE * 1000) AS BIGINT) AS a, 2 * CAST(floor(embedding[2]::DOUBLE * 1000) AS BIGINT) AS b FROM embeddings)
SELECT vec_id, CAST(rate AS INT) AS rate, CAST(channels AS INT) AS channels, CAST(floor(4000 * 16000 / rate) AS INT) AS n_samples, CAST(CASE WHEN channels = 1 THEN a ELSE (a + b) / 2 END AS INT) AS middle FROM c""")
def _mono(spark, sf_dir):
    """Steady sounds of 4,000 frames in several rates, one or two channels: what comes out is the mean of the channels."""
    rate = F.element_at(F.array(F.lit(8000), F.lit(22050), F.lit(44100), F.lit(16000)), (F.col("vec_id") % 4 + 1).cast("int"))
    channels = (1 + F.col("vec_id") % 2).cast("int")
    levels = [(F.floor(F.get("embedding", F.lit(k)).cast("double") * 1000) * 2).cast("smallint") for k in range(2)]
    frame = F.when(channels == 1, F.array(levels[0])).otherwise(F.array(*levels))
    clips = _dealt(spark, sf_dir).select("vec_id", _wav_bytes(frame, F.lit(4000), rate, channels).alias("content"))
    found = signal.decode_clips(clips, key="vec_id")
    return found.select("vec_id", "rate", "channels", "n_samples", F.get("samples", F.floor(F.col("n_samples") / 2).cast("int")).cast("int").alias("middle"))


def _make_predict():
    """Logits are the first ten values; an input whose first value is below -1.5 breaks the call it is in."""

    def predict(inputs: np.ndarray) -> np.ndarray:
        if (inputs[:, 0] < -1.5).any():
            raise ValueError("first value too low")
        return inputs[:, :10]

    return predict


@_query("h3_score_batches", "SELECT vec_id, CASE WHEN embedding[1] < -1.5 THEN NULL ELSE round(list_sum(list_transform(embedding[1:10], lambda x: x::DOUBLE)), 5) END AS total, embedding[1] < -1.5 AS failed FROM embeddings")
def _score(spark, sf_dir):
    found = predict.score_batches(table(spark, sf_dir, "embeddings"), _make_predict, "vec_id", "embedding")
    return found.select("vec_id", _r(F.aggregate("logits", F.lit(0.0), lambda a, x: a + x), 5).alias("total"), F.col("error").isNotNull().alias("failed"))


@_query("g5_bundle_events", """WITH RECURSIVE n AS (SELECT user_id, event_id, epoch_us(ts) AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
b AS (SELECT user_id, event_id, t, i, 0::BIGINT AS bundle, 1 AS size, t AS opened FROM n WHERE i = 1
  UNION ALL SELECT n.user_id, n.event_id, n.t, n.i,
    CASE WHEN b.size >= 8 OR n.t - b.opened >= 3600000000 THEN b.bundle + 1 ELSE b.bundle END,
    CASE WHEN b.size >= 8 OR n.t - b.opened >= 3600000000 THEN 1 ELSE b.size + 1 END,
    CASE WHEN b.size >= 8 OR n.t - b.opened >= 3600000000 THEN n.t ELSE b.opened END
  FROM b JOIN n ON n.user_id = b.user_id AND n.i = b.i + 1)
SELECT user_id, event_id, t AS ts_us, bundle FROM b""")
def _bundles(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"))
    return bundles.bundle_events(events, "user_id", "ts_us", "event_id", 8, 3_600_000_000)


@_query("h2_bundle_stream", """WITH RECURSIVE n AS (SELECT user_id, epoch_us(ts) AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
b AS (SELECT user_id, t, i, 0::BIGINT AS bundle, 1 AS size, t AS opened FROM n WHERE i = 1
  UNION ALL SELECT n.user_id, n.t, n.i,
    CASE WHEN b.size >= 8 OR n.t - b.opened >= 3600000000 THEN b.bundle + 1 ELSE b.bundle END,
    CASE WHEN b.size >= 8 OR n.t - b.opened >= 3600000000 THEN 1 ELSE b.size + 1 END,
    CASE WHEN b.size >= 8 OR n.t - b.opened >= 3600000000 THEN n.t ELSE b.opened END
  FROM b JOIN n ON n.user_id = b.user_id AND n.i = b.i + 1),
g AS (SELECT user_id, bundle, count(*) AS n_items, min(t) AS first_us FROM b GROUP BY ALL),
l AS (SELECT *, max(bundle) OVER (PARTITION BY user_id) AS latest FROM g)
SELECT user_id, bundle, n_items, first_us FROM l
WHERE bundle < latest OR n_items = 8 OR ceil((first_us + 3600000000) / 1000.0) < (SELECT max(epoch_us(ts)) // 1000 FROM events)""")
def _bundle_stream(spark, sf_dir):
    """The closed bundles; a bundle still open at the end stays in the stream's state."""
    events = table(spark, sf_dir, "events")
    place, before = _folder(spark, "bundles"), spark.conf.get(STATE_STORE[0], None)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 8).parquet(f"{sf_dir}/events*.parquet").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    writer = bundle_stream(stream, "user_id", "ts", 8, 3_600_000_000).writeStream.format("parquet").option("checkpointLocation", f"{place}/state")
    spark.conf.set(*STATE_STORE)
    try:
        writer.trigger(availableNow=True).start(f"{place}/out").awaitTermination()
    finally:
        spark.conf.set(STATE_STORE[0], before) if before else spark.conf.unset(STATE_STORE[0])
    return spark.read.schema(f"user_id {events.schema['user_id'].dataType.simpleString()}, bundle bigint, n_items bigint, first_us bigint").parquet(f"{place}/out")


def _make_mel_predict():
    def predict(mels: np.ndarray) -> np.ndarray:
        return np.stack([mels[:, k * 8 : k * 8 + 8].mean(axis=(1, 2)) for k in range(10)], axis=1)

    return predict


@_query("q2_classify_audio", """SELECT vec_id AS request_id, CASE WHEN vec_id % 7 = 2 THEN 'bad_format' WHEN vec_id % 7 = 6 THEN 'unreadable' WHEN vec_id % 7 = 3 THEN 'bad_top_k'
  WHEN vec_id % 7 = 0 THEN 'undecodable' WHEN vec_id % 7 = 1 THEN 'bad_duration' ELSE 'ok' END AS rule,
  CASE vec_id % 7 WHEN 6 THEN 400 WHEN 4 THEN 200 WHEN 5 THEN 200 ELSE 422 END AS status,
  CASE vec_id % 7 WHEN 1 THEN 6400 WHEN 4 THEN 16000 WHEN 5 THEN 16000 END AS n_samples,
  CASE vec_id % 7 WHEN 4 THEN 5 WHEN 5 THEN 2 END AS n_intents, vec_id % 7 IN (4, 5) AS answered FROM embeddings""")
def _classify_audio(spark, sf_dir):
    once = F.transform("embedding", lambda x: F.greatest(F.least(F.floor(x.cast("double") * 8000), F.lit(32767)), F.lit(-32768)).cast("smallint"))
    part = F.col("vec_id") % 7
    clips = table(spark, sf_dir, "embeddings").select("vec_id", once.alias("s"))
    content = F.when(part == 0, F.encode(F.lit("RIFF and no more"), "UTF-8")).otherwise(_wav_bytes(F.col("s"), F.when(part == 1, 100).otherwise(250)))
    audio = clips.filter(part != 6).select(F.col("vec_id").cast("string").alias("path"), content.alias("content")).withColumn("length", F.octet_length("content").cast("bigint"))
    asked = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("request_id"), F.col("vec_id").cast("string").alias("path"),
        F.when(part == 2, "srt").when(part == 5, "verbose_json").alias("response_format"), F.when(part == 3, "0").when(part == 5, "2").alias("top_k"),
    )
    found = classify_audio(asked, audio, _make_mel_predict, fixtures.labels(spark, sf_dir))
    answered = F.col("response").isNotNull() & (F.get_json_object("response", "$.top_intent") == F.col("top_intent"))
    return found.select("request_id", "rule", "status", "n_samples", F.when(F.col("intents").isNotNull(), F.size("intents")).alias("n_intents"), F.coalesce(answered, F.lit(False)).alias("answered"))


@_query("h1_classify_stream", """SELECT vec_id, CASE WHEN vec_id % 5 < 2 THEN 'rejects' ELSE 'results' END AS side, CASE WHEN vec_id % 5 = 0 THEN 'undecodable' WHEN vec_id % 5 = 1 THEN 'bad_duration' ELSE 'ok' END AS rule,
  CASE WHEN vec_id % 5 < 2 THEN 422 ELSE 200 END AS status, CASE WHEN vec_id % 5 < 2 THEN NULL ELSE 5 END AS n_intents FROM embeddings""")
def _classify_stream(spark, sf_dir):
    """Every embedding as a WAV file (a file of text, whose last lines, behind the samples, no decoder reads; they hold vec_id), classified as it arrives.

    All files are in one folder, which is listed at once; a folder for each takes longer to make and to list than a clip.
    """
    place, part = _folder(spark, "clips"), F.col("vec_id") % 5
    once = F.transform("embedding", lambda x: F.greatest(F.least(F.floor(x.cast("double") * 8000), F.lit(32767)), F.lit(-32768)).cast("smallint"))
    content = F.when(part == 0, F.encode(F.lit("RIFF and no more"), "UTF-8")).otherwise(_wav_bytes(once, F.when(part == 1, 100).otherwise(250)))
    last = F.concat(F.lit("\n"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    lines = F.concat(F.coalesce(content, F.encode(F.lit(""), "UTF-8")), F.encode(last, "UTF-8")).cast("string")
    _dealt(spark, sf_dir).select(lines.alias("value")).write.option("maxRecordsPerFile", 1).text(f"{place}/in")
    asked = spark.createDataFrame([], "path string, request_id string, response_format string, top_k string, language string")
    stream = stream_audio(spark, f"{place}/in", max_files=1000)
    names = stored(fixtures.labels(spark, sf_dir), "labels")  # else every batch would find them in all embeddings anew
    with few_listing_tasks(spark, a_core=1):
        classify_stream(stream, asked, _make_mel_predict, names, f"{place}/out", f"{place}/state", availableNow=True).awaitTermination()
    number = F.regexp_extract(F.substring("content", -24, 24).cast("string"), "\\n(-?[0-9]*)\\n$", 1).try_cast("bigint").alias("vec_id")
    numbers = scan_audio(spark, f"{place}/in").select("path", number)
    results = spark.read.parquet(f"{place}/out/results").join(numbers, "path", "left").select("vec_id", F.lit("results").alias("side"), "rule", "status", F.size("intents").alias("n_intents"))
    rejects = spark.read.parquet(f"{place}/out/rejects").join(numbers, "path", "left").select("vec_id", F.lit("rejects").alias("side"), "rule", "status", F.lit(None).cast("int").alias("n_intents"))
    return results.unionByName(rejects)


def queries() -> dict[str, Query]:
    return {name: f for name, (f, _) in _FOUND.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _FOUND.items() if sql}
