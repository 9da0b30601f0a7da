"""Stream sinks: the console for looking, parquet for keeping."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def console_writer(
    stream: DataFrame, output_mode: str = "update", rows: int = 50, interval: str | None = None
) -> DataStreamWriter:
    """Writer that prints each batch in full width; call ``start()`` on it."""
    writer = (
        stream.writeStream.format("console")
        .outputMode(output_mode)
        .option("truncate", False)
        .option("numRows", rows)
    )
    return writer if interval is None else writer.trigger(processingTime=interval)


def start_batches(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    output_mode: str = "update",
    interval: str | None = None,
) -> StreamingQuery:
    """Start a query that hands each batch to ``handle(batch, batch_id)``.

    Without ``interval`` it processes what is there and stops. ``handle`` may see the same
    ``batch_id`` again after a failure, so its writes must be keyed by it.
    """
    writer = (
        stream.writeStream.foreachBatch(handle)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def start_append(
    stream: DataFrame, path: str, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Start a query that appends final rows to parquet files under ``path``, exactly once."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return writer.trigger(**trigger).start()
