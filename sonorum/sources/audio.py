"""Audio files as rows, in batch and as a stream."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonorum import config
from sonorum.operators.joins import join_one_per_key

SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def scan_audio(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """path, modificationTime, length, content. A filter on length is pushed into the scan, and content is read only where used.

    Spark's file sources do not list files of zero bytes, so a request for one finds no file; the
    rule for empty uploads holds where the request table has the size itself.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return (reader.option("pathGlobFilter", glob) if glob else reader).load(path)


_LISTING_KEY = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def few_listing_tasks(spark: SparkSession, a_core: int = 4) -> Iterator[None]:
    """Inside, files are listed by four tasks a core at most, or as told; Spark's own setting is a task for each path, up to 10,000, which takes longer than the listing.

    A stream lists the files of each batch by what holds in its source's session then, so it must run inside. A session with a lower setting keeps it.
    """
    before, most = spark.conf.get(_LISTING_KEY), a_core * spark.sparkContext.defaultParallelism
    if int(before) > most:
        spark.conf.set(_LISTING_KEY, str(most))
    try:
        yield
    finally:
        spark.conf.set(_LISTING_KEY, before)


def stream_audio(spark: SparkSession, path: str, max_files: int = 1000, glob: str | None = None) -> DataFrame:
    """The same rows as files arrive, at most max_files in a batch."""
    reader = spark.readStream.format("binaryFile").schema(SCHEMA).option("maxFilesPerTrigger", max_files)
    with few_listing_tasks(spark):
        return (reader.option("pathGlobFilter", glob) if glob else reader).load(path)


def attach_audio(requests: DataFrame, audio: DataFrame, decodable: DataFrame | None = None) -> DataFrame:
    """requests with payload_bytes (null: no such file) and, of files that can be decoded, content.

    The sizes come from a scan without content. The scan with content only opens files within the
    size limit, and only rows that `decodable` (request_id) names are joined to it. One row for each row of
    requests, whatever their ids and paths; audio has each path once, decodable an id any number of times.
    """
    sizes = audio.select("path", F.col("length").alias("payload_bytes"))
    sized = join_one_per_key(requests, sizes, "path")
    if decodable is None:
        return sized
    named = decodable.filter(F.col("request_id").isNotNull()).select("request_id").distinct().withColumn("__wanted", F.lit(True))
    asked = join_one_per_key(sized, named, "request_id").withColumn("__body", F.when(F.col("__wanted"), F.col("path"))).drop("__wanted")
    bodies = audio.filter(F.col("length").between(1, config.MAX_UPLOAD_BYTES)).select(F.col("path").alias("__body"), "content")
    return join_one_per_key(asked, bodies, "__body").drop("__body")
