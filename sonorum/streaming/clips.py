"""Continuous scoring of arriving clips."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sonorum import config
from sonorum.operators.admission import read_requests
from sonorum.operators.outcomes import check_counts
from sonorum.operators.predict import MakePredict
from sonorum.operators.signal import Decoder, pcm_wav
from sonorum.plans.classify import outcomes_of, score_clips, with_early

REJECT_COLUMNS = ("request_id", "path", "status", "rule", "detail")


def classify_stream(
    audio_stream: DataFrame,
    requests: DataFrame,
    make_predict: MakePredict,
    labels: DataFrame,
    out_path: str,
    checkpoint: str,
    decoder: Decoder = pcm_wav,
    **trigger,
) -> StreamingQuery:
    """Outcomes of every arriving file as Parquet: <out_path>/results and <out_path>/rejects, each by batch_id.

    A file without a request row gets the form defaults and its path as request_id; with several
    request rows it is decoded and scored once and has an outcome for each. A file that is too large, or of which no request
    passes the rules of the form, is not decoded; the size rule is part of the streaming plan. A batch whose outcomes are not as many as its
    requests fails before anything is kept of it. A replayed batch overwrites its own partitions. `few_listing_tasks` speeds
    it up if it holds in the session while the stream runs.
    """
    cores = audio_stream.sparkSession.sparkContext.defaultParallelism
    within = F.col("length").between(1, config.MAX_UPLOAD_BYTES)
    fitting = audio_stream.filter(within).select("path", "length", "content")
    other = audio_stream.filter(~within).select("path", "length", F.lit(None).cast("binary").alias("content"))

    def write(files: DataFrame, batch_id: int) -> None:
        write_batch(files, batch_id, requests, make_predict, labels, out_path, decoder)

    writer = fitting.coalesce(2 * cores).unionByName(other.coalesce(cores)).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def write_batch(files: DataFrame, batch_id: int, requests: DataFrame, make_predict: MakePredict, labels: DataFrame, out_path: str, decoder: Decoder = pcm_wav) -> None:
    """The outcomes of files (path, length, content) into the partitions batch_id of <out_path>/results and <out_path>/rejects.

    The batch is scored once, into <out_path>/last_batch, from which both are written and which the next batch overwrites.
    Running a batch a second time, whole or after it broke off anywhere, leaves what one run leaves.
    """
    spark = files.sparkSession
    form = with_early(read_requests(requests).withColumn("payload_bytes", F.lit(1)))
    refused = form.groupBy("path").agg(F.max(F.col("early.status") == 200).alias("some")).filter("not some").select("path", F.lit(True).alias("refused"))
    wanted = files.join(refused, "path", "left").withColumn("content", F.when(F.col("refused").isNull(), F.col("content")))
    scored = score_clips(wanted, make_predict, decoder, ("path", "length")).withColumnRenamed("length", "payload_bytes")
    asked = scored.join(requests, "path", "left")
    asked = asked.withColumn("request_id", F.coalesce(F.col("request_id").cast("string"), F.col("path")))
    n_asked, n_answered = Observation("asked"), Observation("answered")
    sized = with_early(read_requests(asked)).observe(n_asked, F.count(F.lit(1)).alias("n"))
    outcomes = outcomes_of(sized, labels).observe(n_answered, F.count(F.lit(1)).alias("n"))
    place = f"{out_path}/last_batch"
    outcomes.write.mode("overwrite").parquet(place)
    check_counts(batch_id, n_asked.get["n"], n_answered.get["n"])
    kept = spark.read.schema(outcomes.schema).parquet(place).withColumn("batch_id", F.lit(batch_id))

    def put(df: DataFrame, name: str) -> None:
        df.drop("batch_id").write.mode("overwrite").parquet(f"{out_path}/{name}/batch_id={batch_id}")

    put(kept.filter("status = 200"), "results")
    put(kept.filter("status <> 200").select(*REJECT_COLUMNS, "batch_id"), "rejects")
