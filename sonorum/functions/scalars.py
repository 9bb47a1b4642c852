"""Column functions of requests and signals: built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sonorum import config


def resolve_top_k(top_k: Column) -> Column:
    """The requested number of labels; null asks for the default."""
    return F.coalesce(top_k, F.lit(config.DEFAULT_TOP_K))


def clamp_top_k(k: Column, n_classes: Column | int) -> Column:
    return F.least(k, F.lit(n_classes) if isinstance(n_classes, int) else n_classes)


def duration_s(n_samples: Column) -> Column:
    return n_samples / F.lit(float(config.SAMPLE_RATE))


def duration_ms3(n_samples: Column) -> Column:
    """Seconds to three places, halves up, from integers so that no binary rounding shows."""
    half = config.SAMPLE_RATE // 2
    return F.floor((n_samples * 1000 + half) / config.SAMPLE_RATE) / F.lit(1000.0)


def file_suffix(name: Column) -> Column:
    """Last suffix of the last path part; a leading dot or a trailing one makes none; none means .wav."""
    last = F.regexp_extract(name, r"([^/]*)/*$", 1)
    suffix = F.regexp_extract(last, r"(?s)^.+(\.[^.]+)$", 1)
    return F.when(F.coalesce(suffix, F.lit("")) == "", F.lit(config.DEFAULT_SUFFIX)).otherwise(suffix)


def default_language(language: Column) -> Column:
    return F.coalesce(F.nullif(language, F.lit("")), F.lit(config.DEFAULT_LANGUAGE))


def scale_pcm(samples: Column) -> Column:
    """int16 samples to -1..1."""
    return F.transform(samples, lambda x: (x / F.lit(32768.0)).cast("double"))


def pad_or_trim(samples: Column, n: int = config.PADDED_SAMPLES) -> Column:
    """Exactly n values: zeros after short ones, long ones cut."""
    element = F.get(samples, F.lit(0)) * 0
    zero = F.coalesce(element, F.lit(0))
    padded = F.concat(samples, F.array_repeat(zero, F.greatest(F.lit(n) - F.size(samples), F.lit(0))))
    return F.slice(padded, 1, n)
