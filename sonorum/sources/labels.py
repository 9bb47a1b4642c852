"""Label maps from JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_labels(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(forward, reverse), each (intent, class_idx), of a JSON object with intent_to_idx and idx_to_intent.

    A missing map, a value that is no object, and an index that is no integer (3.7, true, "x") are
    errors; so is a file that is no JSON object.
    """
    schema = "intent_to_idx map<string,string>, idx_to_intent map<string,string>, _corrupt_record string"
    raw = spark.read.option("multiLine", True).option("mode", "PERMISSIVE").schema(schema).json(path)
    first = raw.select(F.col("intent_to_idx").isNull().alias("no_forward"), F.col("idx_to_intent").isNull().alias("no_reverse")).first()
    if first is None or first["no_forward"] or first["no_reverse"]:
        raise ValueError("the label file must be a JSON object with the objects intent_to_idx and idx_to_intent")
    forward = raw.select(F.explode("intent_to_idx").alias("intent", "code"))
    reverse = raw.select(F.explode("idx_to_intent").alias("code", "intent"))
    checked = []
    for side, name in ((forward, "intent_to_idx"), (reverse, "idx_to_intent")):
        side = side.select("intent", F.col("code").try_cast("int").alias("class_idx"))
        if not side.filter("class_idx is null or intent is null").isEmpty():
            raise ValueError(f"{name} has an index that is no integer")
        checked.append(side)
    return checked[0], checked[1]
