"""Batched model calls with isolated failures."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sonorum import config
from sonorum.operators.signal import list_column, list_rows

#: Called once for each task; returns a function from a batch of inputs to as many rows of logits.
MakePredict = Callable[[], Callable[[np.ndarray], np.ndarray]]


def isolated(predict: Callable[[np.ndarray], np.ndarray], inputs: np.ndarray) -> list[tuple[np.ndarray | None, str | None]]:
    """(logits, error) for each input: one call, and after a failure one for each half, down to single inputs."""
    try:
        out = np.asarray(predict(inputs), np.float64)
        if out.ndim != 2 or len(out) != len(inputs):
            raise ValueError(f"{out.shape} logits for {len(inputs)} inputs")
        return [(row, None) for row in out]
    except Exception as problem:
        if len(inputs) == 1:
            return [(None, f"{type(problem).__name__}: {problem}")]
        half = len(inputs) // 2
        return [*isolated(predict, inputs[:half]), *isolated(predict, inputs[half:])]


def score_batches(df: DataFrame, make_predict: MakePredict, key: str = "path", column: str = "mel", shape: tuple[int, ...] | None = None, batch_size: int = config.BATCH_SIZE) -> DataFrame:
    """key, logits array<double>, error.

    Inputs go to the model `batch_size` at a time. Where a call fails or returns a wrong number of
    rows, its halves are tried in turn, down to single inputs, and only those that fail get an error. A
    null input gives nulls.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = make_predict()
        for batch in batches:
            logits, errors = [None] * batch.num_rows, [None] * batch.num_rows
            values = list_rows(batch.column(1))
            there = [i for i, v in enumerate(values) if v is not None]
            for begin in range(0, len(there), batch_size):
                own = there[begin : begin + batch_size]
                rows = [values[i].astype(np.float32) for i in own]
                groups = [range(len(rows))] if len({len(r) for r in rows}) == 1 else [[k] for k in range(len(rows))]
                for group in groups:
                    stacked = np.stack([rows[k] for k in group])
                    try:
                        stacked = stacked.reshape(len(stacked), *shape) if shape else stacked
                    except ValueError as problem:
                        found = [(None, f"ValueError: {problem}")] * len(stacked)
                    else:
                        found = isolated(predict, stacked)
                    for k, (row, error) in zip(group, found, strict=True):
                        logits[own[k]], errors[own[k]] = row, error
            yield pa.RecordBatch.from_arrays([batch.column(0), list_column(logits, pa.float64()), pa.array(errors, pa.string())], [key, "logits", "error"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, column).mapInArrow(run, f"`{key}` {kind}, logits array<double>, error string")
