"""What a running stream says about itself: reconciliation of requests and outcomes, and late rows."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

REQUESTS, OUTCOMES = "requests", "outcomes"


def counted(stream: DataFrame, name: str) -> DataFrame:
    """stream, whose rows are counted under a name in the progress of each batch."""
    return stream.observe(name, F.count(F.lit(1)).alias("n"))


class Reconciliation(StreamingQueryListener):
    """Compares the rows counted as requests with those counted as outcomes, batch by batch, without a join or another pass.

    differing lists (query, batch, n_requests, n_outcomes) of the batches in which they are not as many; check() is
    an error if there is one, and with stop=True such a query is stopped as soon as it is noticed. A batch that lacks either count is not compared.
    """

    def __init__(self, stop: bool = False):
        self.stop, self.differing = stop, []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        found = event.progress.observedMetrics
        if REQUESTS in found and OUTCOMES in found and found[REQUESTS]["n"] != found[OUTCOMES]["n"]:
            self.differing.append((str(event.progress.id), event.progress.batchId, found[REQUESTS]["n"], found[OUTCOMES]["n"]))
            if self.stop:
                self.halt(str(event.progress.id))

    def halt(self, query: str) -> None:
        from pyspark.sql import SparkSession

        if (running := SparkSession.getActiveSession()) and (own := running.streams.get(query)):
            own.stop()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def check(self) -> None:
        if self.differing:
            raise RuntimeError("; ".join(f"batch {batch} has {b} outcomes of {a} requests" for _, batch, a, b in self.differing))


class LateRows(StreamingQueryListener):
    """Rows that stateful operators dropped because they came behind the watermark, added up for each query over all its batches."""

    def __init__(self):
        self.dropped = defaultdict(int)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.dropped[str(event.progress.id)] += sum(s.numRowsDroppedByWatermark for s in event.progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
