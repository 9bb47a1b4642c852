"""Quality classifier: naive Bayes support vectors.

Features are indicators of byte trigrams and of runs of equal words. An indicator is scaled by its
log-count ratio between the classes, rows have unit length, and a linear hinge-loss model is fitted
by dual coordinate descent on a bounded sample of labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sonorum.llm.common import is_held_out, read_table
from sonorum.llm.linear import dual_coordinate_descent, log_count_ratios, sigmoid

#: Hashed trigrams, then runs of two, three, ... equal words.
TRIGRAMS, RUNS = 1 << 18, 6
SIZE = TRIGRAMS + RUNS
#: Slope that turns a margin into a score.
SLOPE = 3.0


def ngram_ids(text: str | bytes | None) -> np.ndarray:
    """Distinct feature numbers of the text, ascending."""
    data = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text or b""
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    grams = ((b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2654435761) >> np.uint32(14)).astype(np.int32) if len(b) > 2 else np.zeros(0, np.int32)
    grams.sort()
    grams = grams[np.r_[True, grams[1:] != grams[:-1]]] if len(grams) else grams
    words = data.split()
    longest = run = 1
    for same in map(bytes.__eq__, words, words[1:]):
        run = run + 1 if same else 1
        if run > longest:
            longest = run
    return np.r_[grams, np.arange(TRIGRAMS, TRIGRAMS + min(longest - 1, RUNS), dtype=np.int32)]


def train_quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality", max_docs: int = 10_000, seed: int = 5) -> tuple[np.ndarray, np.ndarray, float]:
    """(log-count ratios, weights, bias) from doc_id, text and doc_id, label.

    About `max_docs` labelled documents, chosen by a hash of doc_id, go to the one task that fits
    the model, and their ids and labels to every executor; null labels and ids do not count. Without both classes the model is all zeros.
    """
    known = labels.select("doc_id", F.col(label_col).cast("int").alias("label")).dropna().distinct()
    n = known.count()
    chosen = known.filter(F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 20)) < min(1.0, max_docs / max(n, 1)) * (1 << 20))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [ngram_ids(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in ids], pa.binary()), batch.column(2)], ["doc_id", "ids", "label"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = sorted((d, y, x) for b in batches for d, x, y in zip(*(c.to_pylist() for c in b.columns), strict=True))
        rows = [np.frombuffer(x, np.int32) for _, _, x in got]
        positive = np.array([y > 0 for _, y, _ in got], bool)
        if positive.all() or not positive.any():
            return
        ratios = log_count_ratios(rows, positive, SIZE)
        values = [ratios[x] / max(np.linalg.norm(ratios[x]), 1e-9) for x in rows]
        weights = dual_coordinate_descent(rows, values, positive, SIZE)
        used = np.flatnonzero(weights[:SIZE])
        idx = np.r_[used, SIZE].astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(idx), pa.array(np.r_[ratios[used], 0.0]), pa.array(weights[idx])], ["idx", "ratio", "weight"])

    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")
    ids = docs.schema["doc_id"].dataType.simpleString()
    model = texts.mapInArrow(extract, f"doc_id {ids}, ids binary, label int").repartition(1).mapInArrow(fit, "idx int, ratio double, weight double").toArrow()
    idx = model.column("idx").to_numpy()
    ratios, weights = np.zeros(SIZE, np.float32), np.zeros(SIZE + 1, np.float32)
    if len(idx):
        ratios[idx[:-1]] = model.column("ratio").to_numpy()[:-1]
        weights[idx] = model.column("weight").to_numpy()
    return ratios, weights[:SIZE], float(weights[SIZE])


def quality_score(text: Column, model: tuple[np.ndarray, np.ndarray, float], spark: SparkSession) -> Column:
    """Score from 0 to 1 of a text column; null and empty texts get the score of the bias alone. The model has a fixed size."""
    ratios, weights, bias = model
    shared = spark.sparkContext.broadcast((ratios * ratios, ratios * weights, bias))

    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        square, product, shift = shared.value
        for texts in batches:
            scores = []
            for text in texts:
                x = ngram_ids(text.as_py())
                norm = float(np.sqrt(square[x].sum()))
                scores.append(float(sigmoid(SLOPE * ((float(product[x].sum()) / norm if norm else 0.0) + shift))))
            yield pa.array(scores, pa.float64())

    return run(text.cast("binary"))


def classify_quality(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep`, held_out, score, predicted for each row of docs (doc_id, text).

    Only labels of rows that are not held out are learned from. Whole texts are scored, however long,
    as bytes, whether they are UTF-8 or not. Null and empty texts get the score of the bias; equal
    texts have equal scores, and a score of 0.5 is predicted 1. Repeated rows stay repeated, and a doc_id with
    two labels is learned with both; of other columns none is read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    model = train_quality(docs, labels.filter(~is_held_out(F.col("doc_id"))))
    scored = docs.select(*keep, is_held_out(F.col("doc_id")).alias("held_out"), quality_score(F.col("text"), model, spark).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
