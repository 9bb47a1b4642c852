"""Decoding, resampling, framing and spectrograms of clips inside Spark tasks."""

from __future__ import annotations

import io
import wave
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonorum import config

#: bytes -> (int16 samples of all channels interleaved, rate, channels)
Decoder = Callable[[bytes], tuple[np.ndarray, int, int]]


def pcm_wav(content: bytes) -> tuple[np.ndarray, int, int]:
    """PCM WAV of 8, 16, 24 or 32 bits."""
    with wave.open(io.BytesIO(content)) as w:
        rate, channels, width, frames = w.getframerate(), w.getnchannels(), w.getsampwidth(), w.readframes(w.getnframes())
    if not frames:
        raise ValueError("no frames")
    if width == 1:
        samples = (np.frombuffer(frames, np.uint8).astype(np.int16) - 128) << 8
    elif width == 2:
        samples = np.frombuffer(frames, "<i2")
    else:
        whole = np.frombuffer(frames[: len(frames) // width * width], np.uint8).reshape(-1, width)
        samples = np.ascontiguousarray(whole[:, -2:]).view("<i2").ravel()
    return samples[: len(samples) // channels * channels].astype(np.int16), rate, channels


def mono_16k(samples: np.ndarray, rate: int, channels: int, taps: int = 16) -> np.ndarray:
    """Mean of the channels, then a windowed-sinc resampling to 16 kHz; int16."""
    mono = samples.reshape(-1, channels).astype(np.float64).mean(axis=1)
    if rate != config.SAMPLE_RATE:
        ratio = config.SAMPLE_RATE / rate
        n = int(len(mono) * config.SAMPLE_RATE // rate)
        cut = min(1.0, ratio)
        reach = int(np.ceil(taps / cut))
        at = np.arange(n) / ratio
        left = np.floor(at).astype(np.int64)
        padded = np.pad(mono, reach + 1)
        total, weight = np.zeros(n), np.zeros(n)
        for k in range(-reach + 1, reach + 1):
            d = at - (left + k)
            w = cut * np.sinc(cut * d) * np.where(np.abs(d) < reach, 0.5 + 0.5 * np.cos(np.pi * d / reach), 0.0)
            total += w * padded[left + k + reach + 1]
            weight += w
        mono = total / np.where(np.abs(weight) > 1e-9, weight, 1.0)
    return np.clip(np.round(mono), -32768, 32767).astype(np.int16)


def list_rows(column: pa.Array) -> list[np.ndarray | None]:
    """The rows of an Arrow list column as views of its values, null rows as None."""
    offsets, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    there = column.is_valid().to_numpy(zero_copy_only=False)
    return [values[a:b] if ok else None for a, b, ok in zip(offsets[:-1].tolist(), offsets[1:].tolist(), there.tolist(), strict=True)]


def list_column(rows: list[np.ndarray | None], kind: pa.DataType) -> pa.Array:
    """The reverse, with one copy of the values."""
    there = [r for r in rows if r is not None]
    values = pa.array(np.concatenate(there) if there else np.zeros(0), kind)
    ends = np.cumsum([0, *(0 if r is None else len(r) for r in rows)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values, mask=pa.array([r is None for r in rows], pa.bool_()))


def decode_clips(audio: DataFrame, decoder: Decoder = pcm_wav, key: str = "path", at_once: int = 32) -> DataFrame:
    """key, samples array<smallint> at 16 kHz mono, rate and channels of the file, n_samples, error.

    audio: key and content. A null content gives a row of nulls; any error of the decoder gives the
    row's error and no samples, never a failed task. A batch of rows is bounded in bytes by
    spark.sql.execution.arrow.maxBytesPerBatch, and the samples of `at_once` clips are held at a time.
    """
    schema = f"`{key}` {audio.schema[key].dataType.simpleString()}, samples array<smallint>, rate int, channels int, n_samples int, error string"
    return audio.select(key, "content").mapInArrow(decoding(decoder, key, at_once), schema)


def decoding(decoder: Decoder, key: str, at_once: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What decode_clips does with the batches of a task: each is given out in parts of `at_once` clips, the next part is not begun before."""

    def decoded(contents: pa.Array) -> list[pa.Array]:
        rows: list[tuple] = []
        for content in contents:
            data = content.as_py()
            try:
                if data is None:
                    rows.append((None, None, None, None, None))
                    continue
                samples, rate, channels = decoder(data)
                clip = mono_16k(samples, rate, channels)
                if not len(clip):
                    raise ValueError("no samples")
                rows.append((clip, rate, channels, len(clip), None))
            except Exception as problem:
                rows.append((None, None, None, None, f"{type(problem).__name__}: {problem}"))
        clips, *rest = zip(*rows, strict=True) if rows else [[]] * 5
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.string())
        return [list_column(list(clips), pa.int16()), *(pa.array(c, k) for c, k in zip(rest, kinds, strict=True))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, at_once):
                part = batch.slice(k, at_once)
                yield pa.RecordBatch.from_arrays([part.column(0), *decoded(part.column(1))], [key, "samples", "rate", "channels", "n_samples", "error"])

    return run


def frame_signal(df: DataFrame, key: str, column: str, win: int, hop: int) -> DataFrame:
    """key, frame_idx, frame: whole windows of an array column, `hop` apart; shorter arrays have none."""
    n = F.floor((F.size(column) - win) / hop).cast("int")
    starts: Column = F.when(F.size(column) >= win, F.sequence(F.lit(0), n)).otherwise(F.array().cast("array<int>"))
    return df.select(key, column, F.explode(starts).alias("frame_idx")).select(key, "frame_idx", F.slice(column, F.col("frame_idx") * hop + 1, F.lit(win)).alias("frame"))


def mel_filters(n_mels: int, n_fft: int, rate: int = config.SAMPLE_RATE) -> np.ndarray:
    """n_mels x (n_fft / 2 + 1) triangles, evenly spaced on the mel scale, each of unit area in Hz."""

    def mel(hz):
        return 2595.0 * np.log10(1.0 + np.asarray(hz) / 700.0)

    edges = 700.0 * (10.0 ** (np.linspace(mel(0.0), mel(rate / 2), n_mels + 2) / 2595.0) - 1.0)
    bins = np.linspace(0.0, rate / 2, n_fft // 2 + 1)
    low, mid, high = edges[:-2, None], edges[1:-1, None], edges[2:, None]
    return np.clip(np.minimum((bins - low) / (mid - low), (high - bins) / (high - mid)), 0.0, None) * (2.0 / (high - low))


def spectrogram(samples: np.ndarray, filters: np.ndarray, frames: int, win: int, hop: int, floor: float, span: float) -> np.ndarray:
    """log10 mel energies n_mels x frames of a clip padded with silence; values below the peak less `span` are lifted to it."""
    heard = min(len(samples), frames * hop)
    sounding = min(frames, (win // 2 + heard + hop - 1) // hop)  # later frames are silence alone
    signal = np.zeros(sounding * hop + win, np.float32)
    signal[win // 2 : win // 2 + heard] = samples[:heard].astype(np.float32) / 32768.0
    windows = np.lib.stride_tricks.sliding_window_view(signal, win)[::hop][:sounding]
    bins = np.fft.rfft(windows * np.hanning(win + 1)[:-1].astype(np.float32), axis=1)
    logs = np.log10(np.maximum(filters @ (bins.real**2 + bins.imag**2).T, floor))
    low = max(np.log10(floor), logs.max(initial=np.log10(floor)) - span)
    out = np.full((len(filters), frames), (low + 4.0) / 4.0, np.float32)
    out[:, :sounding] = (np.maximum(logs, low) + 4.0) / 4.0
    return out


def log_mel(clips: DataFrame, key: str = "path", n_mels: int = config.N_MELS, frames: int = config.N_FRAMES, win: int = 400, hop: int = 160, floor: float = 1e-10, span: float = 8.0, at_once: int = 32) -> DataFrame:
    """key, mel array<float> of n_mels * frames values; null samples give a null. The filter bank is a constant of each task, and `at_once` spectrograms are held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = mel_filters(n_mels, win).astype(np.float32)
        for batch in batches:
            rows = list_rows(batch.column(1))
            for k in range(0, len(rows), at_once):
                mels = [None if s is None else spectrogram(s, filters, frames, win, hop, floor, span).ravel() for s in rows[k : k + at_once]]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(k, at_once), list_column(mels, pa.float32())], [key, "mel"])

    kind = clips.schema[key].dataType.simpleString()
    return clips.select(key, "samples").mapInArrow(run, f"`{key}` {kind}, mel array<float>")
