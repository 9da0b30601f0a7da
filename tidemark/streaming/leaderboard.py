"""Ranking of keys over the last hour (or other time), renewed after every batch of a stream.

The stream holds only sums per slide as state, a slide being a minute, say. What a batch changed of
the last hour is stored below ``steps/batch_id=<id>``, and the sum of every key over that hour below
``sums/batch_id=<id>``. The sums of the next batch come from these: its new steps are added, the steps they
replace and those that the hour has left behind are subtracted. Only the slides concerned are
read for that, so a batch costs as much as it changes, besides writing its ranking.

After every ``COMPACT_EVERY`` batches all that still counts is stored once more below
``compacted/batch_id=<id>``, the sums are taken anew from it, so that errors of floating-point sums do not
pile up, and what was written a round earlier is removed. Steps are looked up in the last compacted ones and
those of the batches since, which are found by their numbers: however long the stream has run, at
most ``COMPACT_EVERY`` + 1 folders, and none is listed. Rankings hold all keys and go to
``boards/batch_id=<id>``.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.caching import reused
from tidemark.operators.ordering import top
from tidemark.sources.files import folder_names, remove_folder
from tidemark.sources.sinks import start_batches
from tidemark.streaming.updates import latest_per_key
from tidemark.streaming.windows import flat_window, tumbling_sum

LAST_HOUR = timedelta(hours=1)
COMPACT_EVERY = 20
ROWS_PER_FILE = 1_000_000


def step_sums(
    events: DataFrame, time: str, slide: str, key: str, value: Column, name: str
) -> DataFrame:
    """``window_start, window_end, key, name``: one row per slide and key."""
    return flat_window(tumbling_sum(events, time, slide, [key], value, name))


def ranking(
    steps: DataFrame, key: str, name: str, end: datetime, size: timedelta, rows: int | None = None
) -> DataFrame:
    """Keys of ``steps`` in the window up to their newest ``end``: ``key, name, window_end``.

    All keys, or the ``rows`` with the largest sums.
    """
    sums = _since(steps, end, size).groupBy(key).agg(F.sum(name).alias(name))
    if rows is not None:
        sums = top(sums, rows, F.desc(name), key)
    return sums.withColumn("window_end", _time(end))


def _time(value: datetime) -> Column:
    """A literal without time zone; by way of text, which no local time zone can shift."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def _since(steps: DataFrame, end: datetime, size: timedelta) -> DataFrame:
    """The steps of the window that ends at ``end``, which none of ``steps`` is after."""
    return steps.where(F.col("window_start") >= _time(end - size))


def _write(df: DataFrame, path: str, rows: int, by: str | None = None) -> None:
    """Replace ``path`` by at most ``rows`` rows in files of about ``ROWS_PER_FILE``, sorted and divided ``by``."""
    files = 1 + rows // ROWS_PER_FILE
    dealt = df.repartition(files) if by is None else df.repartitionByRange(files, by).sortWithinPartitions(by)
    dealt.write.mode("overwrite").parquet(path)


def step_changes(
    recent: DataFrame, known: DataFrame, key: str, name: str, start: datetime, before: tuple[datetime, datetime]
) -> DataFrame:
    """``key, name, steps``: what to add to the sums per key of the window ``before`` for that from ``start`` on.

    ``recent`` are the steps that a batch wrote into the new window, ``known`` all written until then. A
    step counts with its value and as one, so that keys without any step left can be told.
    """
    old_start, old_end = before
    first = F.col("window_start")
    expired = known.where((first >= _time(old_start)) & (first < _time(min(start, old_end))))
    in_both = known.where((first >= _time(start)) & (first < _time(old_end)))
    again = recent.where(first < _time(old_end)).select("window_start", key)
    replaced = in_both.join(again, ["window_start", key], "left_semi")
    keys = ["window_start", "window_end", key]
    gone = latest_per_key(expired.unionByName(replaced), keys).select(
        key, (-F.col(name)).alias(name), F.lit(-1).cast("bigint").alias("steps")
    )
    return recent.select(key, name, F.lit(1).cast("bigint").alias("steps")).unionByName(gone)


def summed(changes: DataFrame, key: str, name: str) -> DataFrame:
    """Sums per key of values and steps; keys without steps are gone."""
    sums = changes.groupBy(key).agg(F.sum(name).alias(name), F.sum("steps").alias("steps"))
    return sums.where(F.col("steps") > 0)


def write_leaderboard(
    spark: SparkSession,
    path: str,
    key: str,
    name: str,
    size: timedelta = LAST_HOUR,
    rows: int | None = None,
    report: Callable[[DataFrame], None] | None = None,
    compact_every: int = COMPACT_EVERY,
) -> Callable[[DataFrame, int], None]:
    """Batch handler that stores the sums per slide and then the ranking they give.

    Repeating a batch overwrites what it wrote before, and only that. ``report`` is called with
    each stored ranking. Keep ``compact_every`` while a stream goes on from its checkpoint.
    """
    store, totals, boards = f"{path}/steps", f"{path}/sums", f"{path}/boards"
    compacted = f"{path}/compacted"
    keys = ["window_start", "window_end", key]

    def remove_before(batch_id: int) -> None:
        """Remove the round of batches up to ``batch_id``; a repeated later batch needs none of them."""
        for old in range(batch_id - compact_every + 1, batch_id + 1):
            for folder in (store, totals, boards):
                remove_folder(spark, f"{folder}/batch_id={old}")
        remove_folder(spark, f"{compacted}/batch_id={batch_id - compact_every}")

    def steps_before(batch_id: int, base: int, like: DataFrame) -> DataFrame:
        """All steps written before ``batch_id`` that may still count."""
        paths = [f"{store}/batch_id={i}" for i in range(base + 1, batch_id)]
        if base >= 0:
            paths.append(f"{compacted}/batch_id={base}")
        return spark.read.schema(like.schema).parquet(*paths) if paths else like.limit(0)

    def write_board(sums: DataFrame, end: datetime, batch_id: int) -> None:
        with reused(sums) as kept:
            number = kept.count()
            _write(kept, f"{totals}/batch_id={batch_id}", number)
            board = kept.select(key, name)
            if rows is not None:
                board = top(board, rows, F.desc(name), key)
            _write(board.withColumn("window_end", _time(end)), f"{boards}/batch_id={batch_id}", number)

    def handle(batch: DataFrame, batch_id: int) -> None:
        base = batch_id // compact_every * compact_every - 1
        last = batch_id == base + compact_every
        stored = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        board = spark.read.parquet(f"{boards}/batch_id={batch_id - 1}")
        old_end = board.agg(F.max("window_end")).first()[0]
        with reused(stored) as changed:
            number, newest = changed.agg(F.count("*"), F.max("window_end")).first()
            end = max((e for e in (newest, old_end) if e is not None), default=None)
            recent = changed if end is None else _since(changed, end, size)
            _write(recent, f"{store}/batch_id={batch_id}", number, "window_start")
            known = steps_before(batch_id, base, stored)
            if end is None:
                board.write.mode("overwrite").parquet(f"{boards}/batch_id={batch_id}")
                if last:
                    _write(recent, f"{compacted}/batch_id={batch_id}", 0)
            elif last or old_end is None:
                steps = latest_per_key(_since(known.unionByName(recent), end, size), keys)
                with reused(steps.withColumn("batch_id", F.lit(batch_id).cast("bigint"))) as kept:
                    if last:
                        _write(kept.select(stored.columns), f"{compacted}/batch_id={batch_id}", kept.count(), "window_start")
                    ones = kept.select(key, name, F.lit(1).cast("bigint").alias("steps"))
                    write_board(summed(ones, key, name), end, batch_id)
            else:
                changes = step_changes(recent, known, key, name, end - size, (old_end - size, old_end))
                sums = spark.read.parquet(f"{totals}/batch_id={batch_id - 1}")
                write_board(summed(sums.unionByName(changes), key, name), end, batch_id)
        if last and base >= 0:
            remove_before(base)
        if report is not None:
            report(spark.read.parquet(f"{boards}/batch_id={batch_id}").orderBy(F.desc(name), key))

    return handle


def start_leaderboard(
    events: DataFrame,
    path: str,
    checkpoint: str,
    *,
    time: str,
    key: str,
    value: Column,
    name: str,
    size: timedelta = LAST_HOUR,
    slide: str = "1 minute",
    rows: int | None = None,
    report: Callable[[DataFrame], None] | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Start a query that renews the ranking under ``path/boards`` after every batch."""
    spark = events.sparkSession
    steps = step_sums(events, time, slide, key, value, name)
    empty = spark.createDataFrame([], steps.select(key, name, "window_end").schema)
    empty.write.mode("overwrite").parquet(f"{path}/boards/batch_id=-1")
    handle = write_leaderboard(spark, path, key, name, size, rows, report)
    return start_batches(steps, handle, checkpoint, "update", interval)


def read_leaderboard(spark: SparkSession, path: str) -> DataFrame:
    """The ranking stored last. Only the names of the boards of two rounds are listed, not their files."""
    names = folder_names(spark, f"{path}/boards")
    newest = max(int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id="))
    return spark.read.parquet(f"{path}/boards/batch_id={newest}")
