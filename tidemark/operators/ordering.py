"""Top rows, overall and per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first ``n`` rows in ``order``; each task keeps ``n`` rows, there is no full sort."""
    return df.orderBy(*order).limit(n)


def top_per_group(
    df: DataFrame, group: str, k: int, *order: Column | str, name: str = "rank"
) -> DataFrame:
    """The first ``k`` rows of every group in ``order``, numbered from 1.

    Spark limits each group to ``k`` rows per task before the shuffle, so a frequent group is cheap.
    It does so up to ``spark.sql.optimizer.windowGroupLimitThreshold``, 1000 unless raised.
    """
    window = Window.partitionBy(group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= k)
