"""Label maps: checks and lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_dense(df: DataFrame, column: str) -> DataFrame:
    """One row: n, n_distinct, lowest, highest, dense. dense: the codes are exactly 0..n-1 and n > 0; a null is no code."""
    stats = df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(column).alias("n_distinct"), F.min(column).alias("lowest"), F.max(column).alias("highest"))
    dense = (F.col("n") > 0) & (F.col("n") == F.col("n_distinct")) & (F.col("lowest") == 0) & (F.col("highest") == F.col("n") - 1)
    return stats.withColumn("dense", F.coalesce(dense, F.lit(False)))


def missing_codes(df: DataFrame, column: str) -> DataFrame:
    """Codes between 0 and the greatest that no row has, as rows of a range, so that a sparse code needs no array."""
    codes = df.select(F.col(column).cast("bigint").alias("code"))
    top = codes.agg(F.max("code")).first()[0]
    return df.sparkSession.range(0 if top is None else top + 1).withColumnRenamed("id", "code").join(codes, "code", "left_anti")


def label_mismatches(forward: DataFrame, reverse: DataFrame) -> DataFrame:
    """class_idx, forward_intent, reverse_intent where the two maps (intent, class_idx) are not each other's inverse."""
    a = forward.select("class_idx", F.col("intent").alias("forward_intent"))
    b = reverse.select("class_idx", F.col("intent").alias("reverse_intent"))
    return a.join(b, "class_idx", "full_outer").filter(~F.col("forward_intent").eqNullSafe(F.col("reverse_intent")))


def list_labels(labels: DataFrame) -> DataFrame:
    return labels.select("class_idx", "intent").orderBy("class_idx")


def validate_labels(forward: DataFrame, reverse: DataFrame) -> DataFrame:
    """One row: both maps dense, the number of mismatches, and whether the maps are valid."""
    f = check_dense(forward, "class_idx").select(F.col("n").alias("n_classes"), F.col("dense").alias("forward_dense"))
    r = check_dense(reverse, "class_idx").select(F.col("dense").alias("reverse_dense"))
    m = label_mismatches(forward, reverse).agg(F.count(F.lit(1)).alias("n_mismatches"))
    valid = F.col("forward_dense") & F.col("reverse_dense") & (F.col("n_mismatches") == 0)
    return f.crossJoin(r).crossJoin(m).withColumn("valid", valid)  # three rows of one


def attach_labels(ranked: DataFrame, labels: DataFrame) -> DataFrame:
    """ranked (class_idx, ...) with intent; null where the index is in no label. labels has each index once.

    The label map is broadcast where its bytes, as Spark knows them from the plan or from what it shuffled, are within the session's
    spark.sql.autoBroadcastJoinThreshold. Larger maps are joined by index, and adaptive execution splits the rows of very frequent indices.
    """
    return ranked.join(labels.select("class_idx", "intent"), "class_idx", "left")
