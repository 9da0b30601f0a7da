"""A table of the latest value per key, fed by a stream in update mode.

Each batch writes its changed keys below ``batch_id=<id>``; a repeated batch overwrites its own
folder. Readers take the value of the highest batch per key.

Where the keys are given, every ``COMPACT_EVERY`` batches the latest values of all keys are written once more
below ``_snapshots/batch_id=<id>``. The file ``_latest`` names the snapshot to read; it is replaced only after
the snapshot is complete, and what only the snapshot before it needs is removed then. A reader opens one
snapshot and the batches since, however long the stream has run.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.sources.files import folder_names, read_text_file, remove_folder, replace_text_file
from tidemark.sources.sinks import start_batches

COMPACT_EVERY = 20
# Both begin with an underscore, so that Spark passes over them where it lists the batches.
SNAPSHOTS, POINTER = "_snapshots", "_latest"


def write_updates(
    path: str, keys: Sequence[str] | None = None, compact_every: int = COMPACT_EVERY
) -> Callable[[DataFrame, int], None]:
    """Batch handler that stores the changed keys of a batch under ``path``.

    With ``keys`` it also keeps the table compact. A repeated batch changes nothing else.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        if keys is not None and (batch_id + 1) % compact_every == 0:
            compact(batch.sparkSession, path, keys, batch_id)

    return handle


def compact(spark: SparkSession, path: str, keys: Sequence[str], batch_id: int) -> None:
    """Store the latest values up to ``batch_id`` as the snapshot to read, and remove older ones.

    What the snapshot before it holds or replaced is removed only now, so a reader that has just begun with it
    finds its files for another round. Nothing happens if there is such a snapshot already.
    """
    before = _newest_snapshot(spark, path)
    if before is not None and before >= batch_id:
        return
    latest = _latest(spark, path, keys, before, batch_id)
    latest.write.mode("overwrite").parquet(f"{path}/{SNAPSHOTS}/batch_id={batch_id}")
    replace_text_file(spark, f"{path}/{POINTER}", str(batch_id))
    if before is not None:
        for number in _batches(spark, path):
            if number <= before:
                remove_folder(spark, f"{path}/batch_id={number}")
        for number in _batches(spark, f"{path}/{SNAPSHOTS}"):
            if number < before:
                remove_folder(spark, f"{path}/{SNAPSHOTS}/batch_id={number}")


def _newest_snapshot(spark: SparkSession, path: str) -> int | None:
    text = read_text_file(spark, f"{path}/{POINTER}")
    return None if text is None else int(text)


def _batches(spark: SparkSession, path: str) -> list[int]:
    names = folder_names(spark, path)
    return sorted(int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id="))


def _latest(spark: SparkSession, path: str, keys: Sequence[str], snapshot: int | None, last: int | None = None) -> DataFrame:
    """The latest values of ``snapshot`` and the batches since, up to ``last``."""
    since = [n for n in _batches(spark, path) if (snapshot is None or n > snapshot) and (last is None or n <= last)]
    folders = [f"{path}/batch_id={n}" for n in since]
    if snapshot is not None:
        # its own rows come before those of all batches since
        folders.append(f"{path}/{SNAPSHOTS}/batch_id={snapshot}")
    found = spark.read.parquet(*folders)
    number = F.regexp_extract(F.input_file_name(), r"batch_id=(-?\d+)/[^/]*$", 1).cast("long")
    return latest_per_key(found.withColumn("batch_id", number), keys)


def latest_per_key(updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last written values per key; a partial aggregate, so no key's history is gathered."""
    values = [c for c in updates.columns if c not in keys and c != "batch_id"]
    newest = F.max_by(F.struct(*values), "batch_id").alias("newest")
    return updates.groupBy(*keys).agg(newest).select(*keys, "newest.*")


def read_latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The latest value of every key: the newest snapshot, if there is one, and the batches since."""
    return _latest(spark, path, keys, _newest_snapshot(spark, path))


def rewrite_latest(spark: SparkSession, path: str, target: str, keys: Sequence[str]) -> None:
    """Copy the latest values to the fresh folder ``target``, for a stopped stream to go on in.

    They come before every batch, so a last batch that runs again still overwrites only itself.
    """
    read_latest(spark, path, keys).write.parquet(f"{target}/batch_id=-1")


def start_updates(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    interval: str | None = None,
    keys: Sequence[str] | None = None,
    compact_every: int = COMPACT_EVERY,
) -> StreamingQuery:
    """Start storing an aggregated ``stream`` as updates under ``path``, kept compact if ``keys`` are given."""
    return start_batches(stream, write_updates(path, keys, compact_every), checkpoint, "update", interval)
