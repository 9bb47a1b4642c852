"""Clips with their requests to one outcome each."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonorum import config
from sonorum.functions.envelopes import render
from sonorum.functions.scalars import clamp_top_k, duration_s, resolve_top_k
from sonorum.operators.admission import early_rules, first_failure, late_rules, read_requests
from sonorum.operators.joins import join_one_per_key
from sonorum.operators.predict import MakePredict, isolated
from sonorum.operators.scoring import named_intents, pack_labels, softmax, top_k
from sonorum.operators.signal import Decoder, list_column, mel_filters, mono_16k, pcm_wav, spectrogram

#: Fields of a request that its outcome needs.
FIELDS = ("request_id", "path", "payload_bytes", "response_format", "top_k", "language", "early")


def score_clips(
    clips: DataFrame, make_predict: MakePredict, decoder: Decoder = pcm_wav, keep: tuple[str, ...] = ("request_id",), n_mels: int = config.N_MELS, frames: int = config.N_FRAMES, batch_size: int = config.BATCH_SIZE
) -> DataFrame:
    """`keep`, n_samples, decode_error, signal_error, logits, model_error: decoding, spectrogram and model in one pass, one row for each row of clips.

    Samples and spectrograms stay in the Python worker. A null content gives nulls; a clip out of
    the duration bounds is not scored; a clip that fails has its error and no logits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict, filters = make_predict(), mel_filters(n_mels, 400).astype(np.float32)
        for batch in batches:
            n, problems, failures, mels = [None] * batch.num_rows, [None] * batch.num_rows, [None] * batch.num_rows, {}
            logits, errors = [None] * batch.num_rows, [None] * batch.num_rows

            def score(mels=mels, logits=logits, errors=errors):
                for k, (row, error) in zip(mels, isolated(predict, np.stack(list(mels.values()))), strict=True):
                    logits[k], errors[k] = row, error
                mels.clear()

            for k, content in enumerate(batch.column(len(keep))):
                if not content.is_valid:
                    continue
                try:
                    clip = mono_16k(*decoder(content.as_py()))
                    if not len(clip):
                        raise ValueError("no samples")
                except Exception as problem:
                    problems[k] = f"{type(problem).__name__}: {problem}"
                    continue
                n[k] = len(clip)
                if config.MIN_SAMPLES <= len(clip) <= config.MAX_SAMPLES:
                    try:
                        mels[k] = spectrogram(clip, filters, frames, 400, 160, 1e-10, 8.0)
                    except Exception as problem:
                        failures[k] = f"{type(problem).__name__}: {problem}"
                        continue
                    if len(mels) == batch_size:
                        score()
            if mels:
                score()
            columns = [pa.array(n, pa.int64()), pa.array(problems, pa.string()), pa.array(failures, pa.string()), list_column(logits, pa.float64()), pa.array(errors, pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *columns], [*keep, *SCORES])

    kinds = "".join(f"`{c}` {clips.schema[c].dataType.simpleString()}, " for c in keep)
    return clips.select(*keep, "content").mapInArrow(run, f"{kinds}n_samples bigint, decode_error string, signal_error string, logits array<double>, model_error string")


#: What scoring finds out about a file.
SCORES = ("n_samples", "decode_error", "signal_error", "logits", "model_error")


def with_early(requests: DataFrame) -> DataFrame:
    """requests, with payload_bytes (null: no such file), and early struct<rule, status, detail> of the rules that need no decoding."""
    early = early_rules(F.col("payload_bytes").isNotNull(), F.col("payload_bytes"), F.col("response_format"), F.col("top_k"))
    return requests.withColumn("early", first_failure(early))


def outcomes_of(scored: DataFrame, labels: DataFrame, device: str = "spark", keep: tuple[str, ...] = ()) -> DataFrame:
    """classify_audio's columns and `keep`, one row for each row of scored: FIELDS and the SCORES of the request's file, nulls where it has none."""
    scored = scored.crossJoin(F.broadcast(pack_labels(labels)))
    wide = F.size("logits") == F.col("n_labels")
    indexed = F.transform("logits", lambda z, i: F.struct(i.alias("class_idx"), z.alias("z")))

    def lacking(fails: Column, words: str) -> Column:
        return F.coalesce("model_error", F.when(fails, F.lit(words)))

    out = (
        scored.withColumn("k", clamp_top_k(resolve_top_k(F.col("top_k").try_cast("int")), F.col("n_labels")))
        .withColumn("model_error", lacking(~wide, "as many logits as labels are needed"))
        .withColumn("ranked", F.when(wide & F.col("model_error").isNull(), top_k(softmax(indexed), F.col("k"))))
        .withColumn("intents", named_intents(F.col("ranked"), F.col("names")))
        .withColumn("model_error", lacking(F.col("ranked").isNotNull() & F.col("intents").isNull(), "a class has no label"))
    )
    late = first_failure(late_rules(F.col("n_samples"), F.col("decode_error"), F.col("signal_error"), F.col("model_error"), F.size("intents")))
    out = out.withColumn("final", F.when(F.col("early.status") != 200, F.col("early")).otherwise(late))
    best = F.get("intents", F.lit(0))
    ok = F.col("final.status") == 200
    n_samples = F.when(F.col("early.status") == 200, F.col("n_samples"))
    return out.select(
        "request_id", "path", "final.status", "final.rule", "final.detail", n_samples.alias("n_samples"), duration_s(n_samples).alias("duration_s"), "k",
        F.when(ok, F.col("intents")).alias("intents"), F.when(ok, best["intent"]).alias("top_intent"), F.when(ok, best["confidence"]).alias("confidence"),
        F.when(ok, render(F.col("response_format"), best["intent"], best["confidence"], F.col("n_samples"), F.col("language"), F.col("intents"), device)).alias("response"), *keep,
    )


def classify_audio(requests: DataFrame, audio: DataFrame, make_predict: MakePredict, labels: DataFrame, decoder: Decoder = pcm_wav, device: str = "spark") -> DataFrame:
    """request_id, path, status, rule, detail, n_samples, duration_s, k, intents, top_intent, confidence, response.

    One row for each row of requests, whatever their ids: nothing is joined by request_id. audio has each path once. Sizes come from a
    scan without content. Of the files that requests past the cheap rules name, each is decoded and scored once; its
    logits, not its content, go to its requests, each with its own k and format. Refused requests and those without a path meet no file.
    """
    sizes = audio.select("path", F.col("length").alias("payload_bytes"))
    sized = with_early(join_one_per_key(read_requests(requests).select("request_id", "path", "response_format", "top_k", "language"), sizes, "path"))
    sized = sized.withColumn("__file", F.when(F.col("early.status") == 200, F.col("path")))
    # clips are heavy for their bytes: a fixed number of partitions, which adaptive execution leaves alone; each path is there once
    parts = int(audio.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bodies = audio.filter(F.col("length").between(1, config.MAX_UPLOAD_BYTES)).select(F.col("path").alias("__file"), "content").repartition(parts, "__file")
    wanted = bodies.join(sized.select("__file").distinct(), "__file", "left_semi")
    scores = score_clips(wanted, make_predict, decoder, ("__file",))
    return outcomes_of(join_one_per_key(sized, scores, "__file").select(*FIELDS, *SCORES), labels, device)
