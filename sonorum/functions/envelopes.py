"""Response envelopes as JSON columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sonorum.functions.scalars import default_language, duration_ms3

_JSON = {"ignoreNullFields": "false"}


def json_envelope(top_intent: Column, confidence: Column, n_samples: Column) -> Column:
    usage = F.struct(F.lit("duration").alias("type"), duration_ms3(n_samples).alias("seconds"))
    return F.to_json(F.struct(top_intent.alias("text"), top_intent.alias("top_intent"), confidence.alias("confidence"), usage.alias("usage")), _JSON)


def verbose_envelope(top_intent: Column, confidence: Column, n_samples: Column, language: Column, intents: Column, device: str = "spark") -> Column:
    """The whole clip is one segment; decoding statistics that a classifier has none of are fixed."""
    seconds = duration_ms3(n_samples)
    segment = F.struct(
        F.lit(0).alias("id"), F.lit(0.0).alias("start"), seconds.alias("end"), top_intent.alias("text"),
        F.lit(0.0).alias("avg_logprob"), F.lit(1.0).alias("compression_ratio"), F.lit(0.0).alias("no_speech_prob"),
        F.lit(0.0).alias("temperature"), F.array().cast("array<int>").alias("tokens"), F.lit(0).alias("seek"),
    )
    whole = F.struct(
        F.lit("transcribe").alias("task"), default_language(language).alias("language"), seconds.alias("duration"),
        top_intent.alias("text"), F.array(segment).alias("segments"), top_intent.alias("top_intent"),
        confidence.alias("confidence"), intents.alias("intents"), F.lit(device).alias("device"),
    )
    return F.to_json(whole, _JSON)


def text_envelope(top_intent: Column) -> Column:
    return top_intent


def render(response_format: Column, top_intent: Column, confidence: Column, n_samples: Column, language: Column, intents: Column, device: str = "spark") -> Column:
    """The envelope of the wanted format; anything but text and verbose_json, and null, is json."""
    return (
        F.when(response_format == "text", text_envelope(top_intent))
        .when(response_format == "verbose_json", verbose_envelope(top_intent, confidence, n_samples, language, intents, device))
        .otherwise(json_envelope(top_intent, confidence, n_samples))
    )
