"""Admission rules: the first that fails decides the outcome of a request."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonorum import config
from sonorum.functions.scalars import duration_ms3, duration_s, resolve_top_k


def read_requests(df: DataFrame) -> DataFrame:
    """Request rows with every optional form field: missing columns are null, then the defaults apply."""
    fields = {"model": "string", "language": "string", "prompt": "string", "response_format": "string", "temperature": "double", "top_k": "string"}
    for name, kind in fields.items():
        column = F.col(name) if name in df.columns else F.lit(None)
        df = df.withColumn(name, column.cast(kind))
    return df.withColumn("response_format", F.coalesce("response_format", F.lit(config.DEFAULT_FORMAT))).withColumn("temperature", F.coalesce("temperature", F.lit(0.0)))


def bad_format(response_format: Column) -> Column:
    return response_format.isNotNull() & ~response_format.isin(*config.RESPONSE_FORMATS)


def bad_top_k(top_k: Column) -> Column:
    """Below 1, or text that is no integer."""
    number = top_k.cast("string").try_cast("int")
    return top_k.isNotNull() & (number.isNull() | (number < 1))


def bad_duration(n_samples: Column) -> Column:
    return ~n_samples.between(config.MIN_SAMPLES, config.MAX_SAMPLES)


def early_rules(readable: Column, payload_bytes: Column, response_format: Column, top_k: Column) -> list[tuple[Column, str, int, Column]]:
    """Rules that need no decoding: (fails, name, status, detail)."""
    no_number = top_k.cast("string").try_cast("int").isNull()
    return [
        (bad_format(response_format), "bad_format", 422, F.lit(f"response_format must be one of {', '.join(config.RESPONSE_FORMATS)}")),
        (~readable, "unreadable", 400, F.lit(config.DETAIL_UNREADABLE % "no such file")),
        (payload_bytes == 0, "empty", 422, F.lit(config.DETAIL_EMPTY)),
        (payload_bytes > config.MAX_UPLOAD_BYTES, "too_large", 413, F.lit(config.DETAIL_TOO_LARGE % (config.MAX_UPLOAD_BYTES // (1024 * 1024)))),
        (bad_top_k(top_k), "bad_top_k", 422, F.when(no_number, F.format_string(config.DETAIL_TOP_K_TEXT, top_k.cast("string"))).otherwise(config.DETAIL_TOP_K)),
    ]


def late_rules(n_samples: Column, decode_error: Column, signal_error: Column, model_error: Column, n_intents: Column) -> list[tuple[Column, str, int, Column]]:
    """Rules over what decoding, the spectrogram and the model gave. The detail of a failure within is an object with error and message."""

    def failed(words: str, error: Column) -> Column:
        return F.to_json(F.struct(F.lit(config.DETAIL_ERROR).alias("error"), F.format_string(words, error).alias("message")))

    bounds = [F.lit(f"{seconds:g}") for seconds in (config.MIN_SECONDS, config.MAX_SECONDS)]
    return [
        (decode_error.isNotNull() | n_samples.isNull(), "undecodable", 422, F.lit(config.DETAIL_UNDECODABLE)),
        (bad_duration(n_samples), "bad_duration", 422, F.format_string(config.DETAIL_DURATION, *bounds, duration_ms3(n_samples))),
        (signal_error.isNotNull(), "inference_failed", 500, failed(config.DETAIL_PREPROCESSING, signal_error)),
        (model_error.isNotNull(), "inference_failed", 500, failed(config.DETAIL_INFERENCE, model_error)),
        (n_intents == 0, "no_predictions", 500, F.lit(config.DETAIL_NO_PREDICTIONS)),
    ]


def first_failure(rules: list[tuple[Column, str, int, Column]]) -> Column:
    """struct<rule, status, detail> of the first rule that fails, else ok and 200. A null test does not fail."""
    chain = None
    for fails, name, status, detail in rules:
        found = F.struct(F.lit(name).alias("rule"), F.lit(status).alias("status"), detail.alias("detail"))
        chain = F.when(fails, found) if chain is None else chain.when(fails, found)
    passed = F.struct(F.lit("ok").alias("rule"), F.lit(200).alias("status"), F.lit(None).cast("string").alias("detail"))
    return passed if chain is None else chain.otherwise(passed)


def admit(requests: DataFrame) -> DataFrame:
    """Adds rule, status and detail to requests that already know payload_bytes and n_samples.

    A null payload_bytes is an unreadable file. decode_error, signal_error, model_error and n_intents are used
    where the columns exist. One expression, so it runs inside the scan's stage.
    """
    have = set(requests.columns)
    text = lambda name: F.col(name) if name in have else F.lit(None).cast("string")
    n_intents = F.col("n_intents") if "n_intents" in have else F.lit(None).cast("int")
    rules = early_rules(F.col("payload_bytes").isNotNull(), F.col("payload_bytes"), F.col("response_format"), F.col("top_k"))
    rules += late_rules(F.col("n_samples"), text("decode_error"), text("signal_error"), text("model_error"), n_intents)
    return requests.withColumn("__first", first_failure(rules)).select(*requests.columns, "__first.rule", "__first.status", "__first.detail")


def admission_report(requests: DataFrame) -> DataFrame:
    """rule, status, n, mean_seconds over admitted and refused requests."""
    return admit(requests).groupBy("rule", "status").agg(F.count(F.lit(1)).alias("n"), F.avg(duration_s(F.col("n_samples"))).alias("mean_seconds"), F.max(resolve_top_k(F.col("top_k"))).alias("max_top_k"))
