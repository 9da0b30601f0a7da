"""Session settings and the shared folder for checkpoints and stream output."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# UTC keeps event-time windows and calendar months independent of where the driver runs.
# AQE sizes shuffle partitions at run time and splits skewed join partitions.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
# RocksDB keeps the state of streams on disk, not on the heap, and checkpoints only what changed. On
# one machine with little state it only costs time.
CLUSTER_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(
    app_name: str,
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the package defaults, and those for a cluster unless ``master`` is local.

    ``conf`` overrides them. ``master`` is left to spark-submit unless given. On a cluster set
    ``spark.sql.shuffle.partitions`` to a high start value (AQE coalesces it) and
    ``spark.checkpoint.dir`` to a shared folder.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    local = master is not None and master.startswith("local")
    for key, value in {**SESSION_CONF, **({} if local else CLUSTER_CONF), **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Start streams with their state in RocksDB, as clusters have it; some operators need it everywhere."""
    before = {key: spark.conf.get(key, None) for key in CLUSTER_CONF}
    for key, value in CLUSTER_CONF.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run of ``name`` below ``spark.checkpoint.dir``.

    Only a local master may do without the setting: there every executor is this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="tidemark-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
