"""Count-or-timeout bundles of events."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_limits(max_n: int, max_wait_us: int) -> None:
    if max_n < 1:
        raise ValueError(f"a bundle holds at least one item, not {max_n}")
    if max_wait_us < 0:
        raise ValueError(f"the wait can't be negative: {max_wait_us}")


def assign_bundles(times: np.ndarray, max_n: int, max_wait_us: int, state: tuple[int, int, int] = (-1, 0, 0)) -> tuple[np.ndarray, tuple[int, int, int]]:
    """Bundle numbers of ascending times, and the state (bundle, items, first time) after them.

    An item joins the open bundle while that has fewer than max_n items and opened less than
    max_wait_us before; an item at the deadline opens the next.
    """
    bundle, n, first = state
    out = np.empty(len(times), np.int64)
    for i, t in enumerate(times.tolist()):
        if bundle < 0 or n >= max_n or t - first >= max_wait_us:
            bundle, n, first = bundle + 1, 0, t
        n += 1
        out[i] = bundle
    return out, (bundle, n, first)


def bundle_events(df: DataFrame, key: str, ts_us: str, order: str, max_n: int, max_wait_us: int) -> DataFrame:
    """df's key, order and ts_us with bundle, numbered from 0 for each key in order of (ts_us, order).

    Keys are dealt to partitions and each partition is sorted by Spark; a key's rows stream through
    with three numbers of state, so a key of any length needs no memory. Null times come first.
    """
    check_limits(max_n, max_wait_us)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, (-1, 0, 0)
        for batch in batches:
            names = batch.column(0).to_numpy(zero_copy_only=False)
            times = batch.column(3).to_numpy()
            cuts = np.flatnonzero(np.r_[True, names[1:] != names[:-1]]).tolist() if len(names) else []
            parts = [np.zeros(0, np.int64)]
            for begin, end in zip(cuts, [*cuts[1:], len(names)], strict=True):
                if names[begin] != last:
                    last, state = names[begin], (-1, 0, 0)
                numbers, state = assign_bundles(times[begin:end], max_n, max_wait_us, state)
                parts.append(numbers)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(np.concatenate(parts))], ["k", "o", "t", "bundle"])

    first = -(1 << 62)
    name = F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit(""))
    keyed = df.select(name.alias("name"), F.col(key).alias("k"), F.col(order).alias("o"), F.coalesce(F.col(ts_us), F.lit(first)).alias("t"))
    dealt = keyed.repartition("name").sortWithinPartitions("name", "t", "o")
    types = {f.name: f.dataType.simpleString() for f in dealt.schema}
    out = dealt.mapInArrow(run, f"k {types['k']}, o {types['o']}, t bigint, bundle bigint")
    return out.select(F.col("k").alias(key), F.col("o").alias(order), F.when(F.col("t") != first, F.col("t")).alias(ts_us), "bundle")
