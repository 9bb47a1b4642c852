"""Inputs that Spark derives from the given tables: requests, a label map, a head, signals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


REQUEST_COLUMNS = """
  event_id AS request_id, user_id, ts,
  CAST(floor(value) AS BIGINT) * 100000 AS payload_bytes,
  CAST(floor(value * 16000) AS BIGINT) AS n_samples,
  CASE WHEN event_type = 'view' THEN NULL ELSE CAST({k} AS INT) END AS top_k,
  CASE event_type WHEN 'click' THEN 'json' WHEN 'purchase' THEN 'verbose_json' WHEN 'signup' THEN 'text' WHEN 'error' THEN 'srt' END AS response_format,
  CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 3 = 1 THEN '' ELSE 'de' END AS language,
  event_type, value
"""
#: The same rows for DuckDB.
REQUESTS_SQL = f"req AS (SELECT {REQUEST_COLUMNS.format(k="json_extract_string(props, '$.k')")} FROM events)"


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [c.strip() for c in _split(REQUEST_COLUMNS.format(k="get_json_object(props, '$.k')"))]
    return table(spark, sf_dir, "events").selectExpr(*columns)


def _split(text: str) -> list[str]:
    """At commas outside parentheses."""
    parts, depth, now = [], 0, ""
    for char in text:
        depth += (char == "(") - (char == ")")
        if char == "," and not depth:
            parts.append(now)
            now = ""
        else:
            now += char
    return [*parts, now]


def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """clip_id, features, label: one clip for each embedding."""
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("clip_id"), F.col("embedding").cast("array<double>").alias("features"), "label")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """intent, class_idx."""
    found = table(spark, sf_dir, "embeddings").select("label").distinct()
    return found.select(F.concat(F.lit("INTENT_"), F.col("label").cast("string")).alias("intent"), F.col("label").alias("class_idx"))


def head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """class_idx, weight, bias: the mean embedding of each label, and 0.01 times its index."""
    from sonorum.operators.scoring import mean_pool

    pooled = mean_pool(clips(spark, sf_dir), "label", "features")
    return pooled.select(F.col("label").alias("class_idx"), F.col("features").alias("weight"), (F.col("label") * F.lit(0.01)).alias("bias"))


#: Heads, logits and probabilities for DuckDB, in long form.
SCORES_SQL = """
x AS (SELECT vec_id AS clip_id, label, unnest(embedding)::DOUBLE AS v, unnest(range(len(embedding))) AS d FROM embeddings),
w AS (SELECT label AS class_idx, d, avg(v) AS w FROM x GROUP BY ALL),
z AS (SELECT clip_id, class_idx, sum(v * w) + 0.01 * class_idx AS z FROM x JOIN w USING (d) GROUP BY clip_id, class_idx),
e AS (SELECT *, exp(z - max(z) OVER (PARTITION BY clip_id)) AS e FROM z),
p AS (SELECT clip_id, class_idx, z, e / sum(e) OVER (PARTITION BY clip_id) AS p FROM e),
r AS (SELECT *, row_number() OVER (PARTITION BY clip_id ORDER BY p DESC, class_idx) AS rank FROM p)
"""
