"""Numbers of rows in a global order, without gathering the rows anywhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import shared_folder

# Row numbers within a partition, as ``monotonically_increasing_id`` makes them.
_BITS = 33


def with_rank(df: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """``df`` sorted by ``order``, with the place of every row from 0 as ``name``.

    Rows are dealt by ranges of the order and sorted within them; numbers within a partition are moved up by the
    sizes of the partitions before it, of which there are as many as tasks. The sorted rows are written to the
    shared folder once, so that ranks do not change when a task is run again. Rows that ``order``
    does not tell apart are in any order, so end it with a key.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    place = "_place"
    folder = shared_folder(df.sparkSession, "ranks")
    ordered.withColumn(place, F.monotonically_increasing_id()).write.parquet(folder)
    written = df.sparkSession.read.parquet(folder)
    part = F.shiftright(place, _BITS)
    sizes = written.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    numbered = written.withColumn("_part", part).join(F.broadcast(starts), "_part")  # a row a task
    rank = F.col("_start") + F.col(place).bitwiseAND((1 << _BITS) - 1)
    return numbered.withColumn(name, rank).select(*df.columns, name)
