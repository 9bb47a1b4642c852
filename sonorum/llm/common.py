"""Helpers shared by the corpus operators."""

from __future__ import annotations

import atexit
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sonorum.session import shared_dir

#: White space of the word rule ``[^\x20\x09-\x0D]+``.
SPACE_CHARS = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Folders that materialize() wrote outside of any scope and that were not dropped since.
_WRITTEN: list[str] = []
#: Those of the innermost scope of this thread of control.
_SCOPE: ContextVar[list[str] | None] = ContextVar("scope", default=None)


#: Rows that go to a Python worker at once while a table is written, so that texts and sets stay small there and in what Spark sends.
BATCH_ROWS = 1000
_BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"
_BATCH_LOCK = threading.Lock()
#: By session: how many writes are under way, and the setting that held before the first.
_WRITING: dict[str, tuple[int, str]] = {}


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What is planned inside sends Arrow batches of BATCH_ROWS rows at most; the session's own setting holds again when the last such write has ended."""
    session = spark._jsparkSession.sessionUUID()
    with _BATCH_LOCK:
        writes, before = _WRITING.get(session, (0, spark.conf.get(_BATCH_KEY)))
        _WRITING[session] = (writes + 1, before)
        if not writes and not 0 < int(before) <= BATCH_ROWS:
            spark.conf.set(_BATCH_KEY, str(BATCH_ROWS))
    try:
        yield
    finally:
        with _BATCH_LOCK:
            writes, before = _WRITING.pop(session)
            if writes > 1:
                _WRITING[session] = (writes - 1, before)
            else:
                spark.conf.set(_BATCH_KEY, before)


def materialize(df: DataFrame, what: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage and survives lost executors.

    The table stays until the end of `only_the_last_stays`, until drop_tables() is called, or until the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    with small_batches(spark):
        df.write.option("compression", "zstd").parquet(path)
    scope = _SCOPE.get()
    (_WRITTEN if scope is None else scope).append(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, paths: list[str]) -> None:
    sc = spark.sparkContext
    for path in paths:
        where = sc._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)


def drop_tables(spark: SparkSession) -> None:
    """Deletes what materialize() wrote outside of any scope. Only for tables that no DataFrame still in use reads."""
    gone = _WRITTEN[:]
    del _WRITTEN[: len(gone)]
    _delete(spark, gone)


@atexit.register
def _drop_at_the_end() -> None:
    if _WRITTEN and (spark := SparkSession.getActiveSession()):
        drop_tables(spark)


@contextmanager
def only_the_last_stays(spark: SparkSession) -> Iterator[None]:
    """Of the tables written inside, by this thread, all but the last one are deleted at the end, and after an error all."""
    outer, own = _SCOPE.get(), []
    token, last = _SCOPE.set(own), 0
    try:
        yield
        last = 1
    finally:
        _SCOPE.reset(token)
        kept = own[len(own) - last :]
        (_WRITTEN if outer is None else outer).extend(kept)
        _delete(spark, own[: len(own) - len(kept)])


def in_parts(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Arrow batches in slices of so many rows, so that what is made of a batch's texts is not held for all of them at once."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def trimmed(text: Column) -> Column:
    return F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))


def split_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` in order; null and blank texts have none."""
    t = trimmed(text)
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE_CLASS))


def let(value: Column, body) -> Column:
    """Bind value to a name inside one row's expression, so that it is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def is_held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 3, is 1; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def count_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
