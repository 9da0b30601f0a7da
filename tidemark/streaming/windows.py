"""Tumbling and sliding windows. The same functions work on batch and streaming DataFrames."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import (
    ExpiredTimerInfo,
    StatefulProcessor,
    StatefulProcessorHandle,
    TimerValues,
)
from pyspark.sql.types import LongType, StructField, StructType


_EVER = -(1 << 63)


def with_event_time(df: DataFrame, time: str, delay: str) -> DataFrame:
    """``df`` with ``time`` as a timestamp under a watermark of ``delay``.

    Without a watermark the state of a windowed stream is never released.
    """
    return df.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)


def tumbling_sum(
    df: DataFrame, time: str, size: str, keys: Sequence[str], value: Column, name: str
) -> DataFrame:
    """Sum of ``value`` per window and key: ``window, *keys, name``."""
    return df.groupBy(F.window(time, size), *keys).agg(F.sum(value).alias(name))


def sliding_sum(
    df: DataFrame, time: str, size: str, slide: str, keys: Sequence[str], value: Column, name: str
) -> DataFrame:
    """Sum of ``value`` per sliding window and key: ``window, *keys, name``.

    Rows are first summed per slide, so that each sum, not each row, is repeated for all the
    windows it falls into. ``size`` must be a multiple of ``slide``. On a batch the repetition
    comes after the last shuffle, on a stream there is none: each key holds its recent sums.
    """
    steps = df.groupBy(F.window(time, slide).alias("_step"), *keys).agg(F.sum(value).alias("_part"))
    if not df.isStreaming:
        return _windows_of_blocks(steps, size, slide, keys, name)
    return _windows_of_state(steps, size, slide, keys, name)


def _micros(spark, interval: str) -> int:
    """Length of an interval of days or less."""
    length: timedelta = spark.sql(f"SELECT INTERVAL '{interval}' AS i").first().i
    return length // timedelta(microseconds=1)


def closed_windows(
    starts: np.ndarray, parts: np.ndarray, size: int, slide: int, after: int, until: int
) -> tuple[np.ndarray, np.ndarray]:
    """Ends and sums of the windows that end after ``after`` and at ``until`` at the latest.

    ``parts`` are the sums of the slides that begin at ``starts``, in order. Windows without a slide are left out.
    """
    ends = np.unique(starts[:, None] + slide * np.arange(1, size // slide + 1)[None, :])
    ends = ends[(ends > after) & (ends <= until)]
    if not len(ends):
        return ends, parts[:0]
    low, high = np.searchsorted(starts, ends - size), np.searchsorted(starts, ends)
    bounds = np.column_stack([low, high]).ravel()
    return ends, np.add.reduceat(np.append(parts, parts[:1] * 0), bounds)[::2]


class _RecentSums(StatefulProcessor):
    """Per key the sums of the slides that lie in open windows, as two arrays, and one timer."""

    def __init__(self, keys: Sequence[str], name: str, kind: str, size: int, slide: int) -> None:
        self.keys, self.name, self.kind, self.size, self.slide = list(keys), name, kind, size, slide

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", f"starts array<long>, parts array<{self.kind}>, done long")

    def handleInputRows(
        self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues
    ) -> Iterator[pd.DataFrame]:
        return self._windows(key, list(rows), timerValues)

    def handleExpiredTimer(
        self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo
    ) -> Iterator[pd.DataFrame]:
        return self._windows(key, [], timerValues)

    def _windows(self, key: tuple, fresh: list[pd.DataFrame], timer: TimerValues) -> Iterator[pd.DataFrame]:
        starts, parts, done = self.sums.get() or ([], [], _EVER)
        starts = np.concatenate([np.array(starts, dtype=np.int64), *[r["slide_start"].to_numpy() for r in fresh]])
        parts = np.array([*parts, *[p for r in fresh for p in r["slide_sum"]]])
        order = np.argsort(starts, kind="stable")
        starts, parts = starts[order], parts[order]
        now = timer.getCurrentWatermarkInMs() * 1000
        ends, sums = closed_windows(starts, parts, self.size, self.slide, done, now)
        if len(ends):
            columns = {k: [v] * len(ends) for k, v in zip(self.keys, key, strict=True)}
            yield pd.DataFrame({**columns, "window_end": ends, self.name: sums})
        held = starts + self.size > now  # the last window with the slide is still open
        if held.any():
            self.sums.update((starts[held].tolist(), parts[held].tolist(), now))
            # the first end of a window that holds any of them
            self.handle.registerTimer(int(max(starts[held][0], now // self.slide * self.slide) + self.slide) // 1000)
        else:
            self.sums.clear()

    def close(self) -> None:
        pass


def _windows_of_state(steps: DataFrame, size: str, slide: str, keys: Sequence[str], name: str) -> DataFrame:
    """Windows over a stream's sums per slide, emitted from state once the watermark has passed their end.

    A sum is shuffled once, when its slide is closed, to the state of its key. This is one row per key, whatever the
    number of windows. Spark keeps such state in RocksDB only (see ``session.CLUSTER_CONF``).
    """
    spark = steps.sparkSession
    length, step = _micros(spark, size), _micros(spark, slide)
    start = F.unix_micros("_step.start").alias("slide_start")
    # names that begin with an underscore do not reach the state's frames
    closed = steps.select(F.window_time("_step").alias("slide_time"), start, *keys, F.col("_part").alias("slide_sum"))
    part = closed.schema["slide_sum"].dataType
    out = StructType([*[closed.schema[k] for k in keys], StructField("window_end", LongType()), StructField(name, part)])
    grouped = closed.groupBy(*keys).transformWithStateInPandas(
        _RecentSums(keys, name, part.simpleString(), length, step), out, "append", "EventTime"
    )
    end = F.col("window_end")
    window = F.struct(F.timestamp_micros(end - length).alias("start"), F.timestamp_micros(end).alias("end"))
    return grouped.select(window.alias("window"), *keys, name)


def _windows_of_blocks(
    steps: DataFrame, size: str, slide: str, keys: Sequence[str], name: str
) -> DataFrame:
    """Windows over sums per slide, with the sums shuffled and not their repetitions.

    Windows are dealt to tasks by key and the hour (the day, for longer windows) in which they start.
    A sum goes to the one or two blocks in which windows that hold it start, and is repeated there.
    """
    long, step = F.expr(f"INTERVAL '{size}'"), F.expr(f"INTERVAL '{slide}'")
    first, last = F.col("_start") - long + step, F.col("_start")
    starts = F.sequence(first, last, step)
    hour = F.lit(0).cast("timestamp") + long <= F.lit(3600).cast("timestamp")

    def block(start: Column) -> Column:
        return F.when(hour, F.date_trunc("hour", start)).otherwise(F.date_trunc("day", start))

    parts = steps.select(*keys, F.col("_step.start").alias("_start"), "_part")
    # windows of an hour or less start in two blocks at most
    blocks = F.when(hour, F.array(block(first), block(last))).otherwise(F.transform(starts, block))
    dealt = parts.withColumn("_block", F.explode(F.array_distinct(blocks))).repartition(*keys, "_block")
    sums = (
        dealt.withColumn("_begin", F.explode(starts))
        .where(block(F.col("_begin")) == F.col("_block"))
        .groupBy(*keys, "_block", "_begin")
        .agg(F.sum("_part").alias(name))
    )
    window = F.struct(F.col("_begin").alias("start"), (F.col("_begin") + long).alias("end"))
    return sums.select(window.alias("window"), *keys, name)


def flat_window(df: DataFrame) -> DataFrame:
    """Replace the ``window`` struct by ``window_start`` and ``window_end`` without time zone."""
    others = [c for c in df.columns if c != "window"]
    return df.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        *others,
    )
