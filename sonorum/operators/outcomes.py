"""One outcome for each request: union, reconciliation, summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def all_outcomes(results: DataFrame, rejects: DataFrame) -> DataFrame:
    return results.unionByName(rejects, allowMissingColumns=True)


def unanswered(requests: DataFrame, outcomes: DataFrame, key: str = "request_id") -> DataFrame:
    """Requests without an outcome."""
    return requests.join(outcomes.select(key), key, "left_anti")


def answered_twice(outcomes: DataFrame, key: str = "request_id") -> DataFrame:
    return outcomes.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def reconcile(requests: DataFrame, outcomes: DataFrame, by: str) -> DataFrame:
    """by, n_requests, n_outcomes where the two counts differ."""
    a = requests.groupBy(by).agg(F.count(F.lit(1)).alias("n_requests"))
    b = outcomes.groupBy(by).agg(F.count(F.lit(1)).alias("n_outcomes"))
    zero = {"n_requests": 0, "n_outcomes": 0}
    return a.join(b, by, "full_outer").fillna(zero, list(zero)).filter("n_requests <> n_outcomes")


def run_summary(outcomes: DataFrame) -> DataFrame:
    """status, top_intent, n, mean_confidence, seconds."""
    return outcomes.groupBy("status", "top_intent").agg(F.count(F.lit(1)).alias("n"), F.avg("confidence").alias("mean_confidence"), F.sum("duration_s").alias("seconds"))


def check_counts(batch: int | str, n_requests: int, n_outcomes: int) -> None:
    if n_requests != n_outcomes:
        raise RuntimeError(f"batch {batch} has {n_outcomes} outcomes of {n_requests} requests")
