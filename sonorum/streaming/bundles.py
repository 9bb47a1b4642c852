"""Count-or-timeout bundles over a stream."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from sonorum.operators.bundles import assign_bundles, check_limits

COLUMNS = ["bundle", "n_items", "first_us"]


class _Bundler(StatefulProcessor):
    """A key's state: the open bundle, its items and first time (no items: it is closed), the times that wait for the watermark, and when its timer is set.

    A time is assigned once the watermark has passed it, for then no earlier one can come any more. So times are
    assigned in order, in whatever order they arrive within the delay, and no more wait than came within it.
    """

    def __init__(self, key: str, max_n: int, max_wait_us: int):
        self.key, self.max_n, self.max_wait_us = key, max_n, max_wait_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "bundle bigint, n bigint, first bigint, timer bigint")
        self.waiting = handle.getListState("waiting", "t bigint")

    def _state(self) -> tuple[int, int, int, int | None]:
        return self.open.get() if self.open.exists() else (-1, 0, 0, None)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        """Times only wait here; the timer, which runs when the batch has been read, assigns those that are due."""
        least = None
        for frame in rows:
            times = frame["t"].tolist()
            self.waiting.appendList([(t,) for t in times])
            least = min([*times, *([] if least is None else [least])])
        bundle, n, first, timer = self._state()
        if least is not None and (timer is None or _ms(least) < timer):
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(_ms(least))
            self.open.update((bundle, n, first, _ms(least)))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = np.sort(np.fromiter((t for (t,) in self.waiting.get()), np.int64)) if self.waiting.exists() else np.zeros(0, np.int64)
        bundle, n, first, timer = self._state()
        due, later = np.split(waiting, [np.searchsorted(waiting, now, "right")])
        numbers, (last, count, start) = assign_bundles(due, self.max_n, self.max_wait_us, (bundle, n or self.max_n, first))
        sizes = {bundle: (n, first)} if n else {}
        for number, at, size in zip(*np.unique(numbers, return_index=True, return_counts=True), strict=True):
            had, opened = sizes.get(int(number), (0, int(due[at])))
            sizes[int(number)] = (had + int(size), opened)
        if len(due):
            bundle, n, first = last, count, start
        done = n >= self.max_n or n > 0 and first + self.max_wait_us <= now
        closed = [(b, size, opened) for b, (size, opened) in sorted(sizes.items()) if b != bundle or done]
        n = 0 if done else n
        if len(due):
            self.waiting.put([(t,) for t in later.tolist()]) if len(later) else self.waiting.clear()
        following = [*later[:1].tolist(), *([first + self.max_wait_us] if n else [])]
        if timer is not None:
            self.handle.deleteTimer(timer)
        timer = _ms(min(following)) if following else None
        if timer is not None:
            self.handle.registerTimer(timer)
        self.open.update((bundle, n, first, timer))
        if closed:
            frame = pd.DataFrame(closed, columns=COLUMNS)
            frame.insert(0, self.key, key[0])
            yield frame

    def close(self) -> None:
        pass


def _ms(us: int) -> int:
    """The first millisecond that is not before."""
    return -(-us // 1000)


#: transformWithState keeps maps and timers in this state store; the session that runs a bundle stream is set to it by its owner.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def bundle_stream(df: DataFrame, key: str, ts: str, max_n: int, max_wait_us: int, delay: str = "0 seconds") -> DataFrame:
    """key, bundle, n_items, first_us of each bundle as it closes, by count or as the watermark passes its deadline.

    The numbers are those of bundle_events for events in any order, as long as none comes more than `delay` after the latest time of the
    batches before. Later ones are dropped, and counted by streaming.progress.LateRows. Bundles come out as the watermark passes
    them, so what came within the last `delay` waits in the state. How much a batch holds is for the source to bound
    (maxFilesPerTrigger, maxBytesPerTrigger). Needs the state store STATE_STORE.
    """
    check_limits(max_n, max_wait_us)
    keyed = df.withWatermark(ts, delay).select(key, ts, F.unix_micros(ts).alias("t"))
    kind = df.schema[key].dataType.simpleString()
    return keyed.groupBy(key).transformWithStateInPandas(_Bundler(key, max_n, max_wait_us), f"`{key}` {kind}, bundle bigint, n_items bigint, first_us bigint", "Append", "EventTime")
