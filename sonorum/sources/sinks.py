"""Results and rejects as files, partitioned by status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_outcomes(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """parquet and json keep all columns; text has the rendered response alone, a line each."""
    if fmt == "text":
        df.filter(F.col("status") == 200).select("status", F.col("response").alias("value")).write.mode(mode).partitionBy("status").text(path)
    else:
        df.write.mode(mode).partitionBy("status").format(fmt).save(path)


def write_rejects(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    write_outcomes(df.filter(F.col("status") != 200).select("request_id", "path", "status", "rule", "detail"), path, fmt, mode)
