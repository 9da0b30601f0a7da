"""Keeping a DataFrame that several jobs read."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import DataFrame
from pyspark.storagelevel import StorageLevel

from tidemark.session import shared_folder

# Rows that keep a task of an iterative fit busy for longer than it takes to start it.
ROWS_PER_TASK = 50_000
# Rows that a task of such a fit can take; more tasks than these need, and than two a core, only send
# the driver more results.
MOST_ROWS_PER_TASK = 1_000_000


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared folder and read back, for jobs that run after its maker has returned."""
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


@contextmanager
def reused(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep ``df`` in memory or on disk meanwhile; parts lost with an executor are computed again."""
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()


@contextmanager
def spread(
    df: DataFrame,
    rows_per_task: int = ROWS_PER_TASK,
    most_rows: int = MOST_ROWS_PER_TASK,
    keep: bool = True,
    level: StorageLevel = StorageLevel.MEMORY_AND_DISK,
) -> Iterator[DataFrame]:
    """Keep ``df`` like :func:`reused`, in enough partitions to use the cores on it, and not in many more.

    A table in fewer partitions than cores is small, so one shuffle of it costs little beside the
    many passes of a fit; but tasks of a few rows would cost more than they gain. Every task of every pass sends
    the driver a result with its metrics, so a table in many more partitions is read by two tasks a core,
    each of several kept partitions, or by one for ``most_rows`` if those are more. Without ``keep`` what ``df`` reads
    is kept already, and only what a shuffle makes of it is kept anew.
    """
    with reused(df, level) if keep else nullcontext(df) as kept:
        cores = kept.sparkSession.sparkContext.defaultParallelism
        rows = kept.count()
        tasks = min(cores, -(-rows // rows_per_task))
        most = max(2 * cores, -(-rows // most_rows))
        partitions = kept.rdd.getNumPartitions()
        if partitions > most:
            yield kept.coalesce(most)
        elif partitions >= tasks:
            yield kept
        else:
            with reused(kept.repartition(tasks), level) as even:
                yield even
