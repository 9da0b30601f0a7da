"""Counts and sums per key, and the profile of a grouping key.

All of them aggregate partially before the shuffle, so a frequent key costs one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import words


def count_by(df: DataFrame, *keys: str, name: str = "total") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def sum_by(df: DataFrame, value: str | Column, *keys: str, name: str = "total") -> DataFrame:
    column = F.col(value) if isinstance(value, str) else value
    return df.groupBy(*keys).agg(F.sum(column).alias(name))


def key_profile(df: DataFrame, key: str) -> DataFrame:
    """Rows per key and the share of all rows it holds: shows skew without gathering a group."""
    sizes = count_by(df, key, name="key_rows")
    total = sizes.agg(F.sum("key_rows")).scalar()
    return sizes.select(key, "key_rows", (F.col("key_rows") / total).alias("share"))


def key_count(df: DataFrame, key: str, name: str = "key_count") -> DataFrame:
    """Number of groups that ``groupBy(key)`` would give, the null group included."""
    null_group = F.max(F.col(key).isNull().cast("bigint"))
    return df.agg((F.count_distinct(F.col(key)) + F.coalesce(null_group, F.lit(0))).alias(name))


def pivot_sum(
    df: DataFrame, row: str, column: str, value: str | Column, values: Sequence
) -> DataFrame:
    """Sum of ``value`` per ``row``, one output column per entry of ``values``; null if none.

    The values must be named: finding them would take a job of its own, and their number is the
    width of the result. All columns come from one shuffle by ``row``.
    """
    summed = F.col(value) if isinstance(value, str) else value
    sums = [F.sum(F.when(F.col(column) == v, summed)).alias(str(v)) for v in values]
    return df.groupBy(row).agg(*sums)


def word_counts(df: DataFrame, text: str, *groups: str, name: str = "n") -> DataFrame:
    """Occurrences of each word in whole texts, per group if given: ``*groups, word, n``."""
    tokens = df.select(*groups, F.explode(words(F.col(text))).alias("word"))
    return count_by(tokens, *groups, "word", name=name)


def words_in_every_group(counts: DataFrame, group: str) -> DataFrame:
    """``word, groups, n``: the words that every group with any word uses, and how often.

    ``counts`` holds the ``group, word, n`` rows of :func:`word_counts`. Both uses of it here need
    all three columns, so Spark splits the texts and shuffles the counts only once.
    """
    sizes = counts.groupBy(group).agg(F.sum("n").alias("n")).where(F.col("n") > 0)
    groups = sizes.agg(F.count(F.lit(1))).scalar()
    spread = counts.groupBy("word").agg(F.count(group).alias("groups"), F.sum("n").alias("n"))
    return spread.where(F.col("groups") == groups)
