"""How many rows of a stream came too late: behind its watermark."""

from __future__ import annotations

import threading
from collections import defaultdict
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

# Name of the metrics that :func:`observed` adds to a stream.
METRICS = "event_times"


def observed(stream: DataFrame, time: str) -> DataFrame:
    """``stream`` with its rows, rows without a time, and first and last time counted in every batch, in passing."""
    at = F.col(time)
    return stream.observe(
        METRICS,
        F.count("*").alias("n_rows"),
        F.count_if(at.isNull()).alias("n_without_time"),
        F.min(at).alias("first"),
        F.max(at).alias("last"),
    )


@dataclass
class Batch:
    """What a batch read and dropped: rows, and in ``late`` those that a state operator met behind the watermark."""

    number: int
    rows: int
    late: int
    watermark: str | None
    times: dict = field(default_factory=dict)


class LateRows(StreamingQueryListener):
    """Counts, per query, what its state operators dropped behind the watermark.

    Rows of one window and key that a task sums before they reach the state count once there, since they
    arrive as one. Read the numbers once a query has ended or with :meth:`settled`: progress is reported after each
    batch, from another thread.
    """

    def __init__(self) -> None:
        self._batches: dict[str, list[Batch]] = defaultdict(list)
        self._ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def onQueryStarted(self, event: StreamingQueryListener.QueryStartedEvent) -> None:
        self._ended[str(event.runId)].clear()

    def onQueryProgress(self, event: StreamingQueryListener.QueryProgressEvent) -> None:
        progress = event.progress
        late = sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)
        seen = progress.observedMetrics.get(METRICS)
        self._batches[str(progress.runId)].append(
            Batch(progress.batchId, progress.numInputRows, late, progress.eventTime.get("watermark"), seen.asDict() if seen else {})
        )

    def onQueryIdle(self, event: StreamingQueryListener.QueryIdleEvent) -> None:
        pass

    def onQueryTerminated(self, event: StreamingQueryListener.QueryTerminatedEvent) -> None:
        self._ended[str(event.runId)].set()

    def settled(self, query: StreamingQuery, seconds: float = 30) -> bool:
        """Wait until the end of a stopped or finished ``query`` has been reported."""
        return self._ended[str(query.runId)].wait(seconds)

    def batches(self, query: StreamingQuery) -> list[Batch]:
        return list(self._batches[str(query.runId)])

    def late(self, query: StreamingQuery) -> int:
        """Late rows of all batches so far."""
        return sum(batch.late for batch in self.batches(query))


def count_late_rows(spark: SparkSession) -> LateRows:
    """A listener that counts late rows of all queries started from now on; remove it with ``removeListener``."""
    listener = LateRows()
    spark.streams.addListener(listener)
    return listener
