"""Joins of many rows with a table that has one row for each key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_one_per_key(rows: DataFrame, table: DataFrame, key: str, share: int = 1000, least: int = 100_000, copies: int = 64) -> DataFrame:
    """rows LEFT JOIN table on key, where table has each key once: one row for each row of rows.

    Keys that hold at least one in `share` of the rows, and `least` rows, are hot; there are `share` of them at most. Their row of
    table stands `copies` times, and rows of a hot key are dealt over the copies by all their columns, as rows without a key are,
    which match nothing. So no key's rows meet in one task, with adaptive execution or without.
    """
    counts = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    total = rows.agg(F.count(F.lit(1)).alias("__all"))
    hot = F.broadcast(counts.crossJoin(F.broadcast(total)).filter((F.col("__n") * share >= F.col("__all")) & (F.col("__n") >= least)).select(key, F.lit(True).alias("__hot")))
    spread = F.pmod(F.xxhash64(*(c for c, kind in rows.dtypes if "map<" not in kind)), F.lit(copies)).cast("int")
    dealt = rows.join(hot, key, "left").withColumn("__salt", F.when(F.col("__hot") | F.col(key).isNull(), spread).otherwise(0)).drop("__hot")
    places = F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(copies - 1))).otherwise(F.array(F.lit(0)))
    many = table.filter(F.col(key).isNotNull()).join(hot, key, "left").withColumn("__salt", F.explode(places)).drop("__hot")
    return dealt.join(many, [key, "__salt"], "left").drop("__salt")
