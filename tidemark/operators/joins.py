"""Equi joins of a large table with one that may or may not be small."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegralType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

# A side of at most this many rows, and this many bytes of text in them, is broadcast.
BROADCAST_ROWS = 200_000
BROADCAST_TEXT_BYTES = 32 * 1024 * 1024
# Share of all rows from which on a key is spread over several tasks, and how many tasks each.
HOT_SHARE = 0.001
SALTS = 64
_SKETCHED = (IntegralType, StringType, FloatType, DoubleType, DateType, TimestampType, TimestampNTZType, DecimalType)


def lookup(
    facts: DataFrame,
    other: DataFrame,
    key: str,
    how: str = "inner",
    broadcast_rows: int = BROADCAST_ROWS,
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """Join ``facts`` with ``other`` on ``key``: broadcast if measured small, else salted.

    ``how`` is inner, left, left_semi (keep the rows whose key is in ``other``) or left_anti (keep
    those whose key is not). ``other`` is counted first, so it should be cheap to read.
    """
    if is_small(other, broadcast_rows):
        return facts.join(F.broadcast(other), key, how)
    return salted_join(facts, other, key, how, hot_from=hot_from)


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS, text_bytes: int = BROADCAST_TEXT_BYTES) -> bool:
    """Whether ``df`` has few rows and little text, in one pass; other variable-length columns are large."""
    kinds = dict(df.dtypes)
    if any("<" in kind or kind == "binary" for kind in kinds.values()):
        return False
    texts = [F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in kinds.items() if kind == "string"]
    size = df.agg(F.count("*").alias("rows"), F.sum(sum(texts, F.lit(0))).alias("bytes")).first()
    return size["rows"] <= rows and (size["bytes"] or 0) <= text_bytes


def salted_join(
    facts: DataFrame,
    other: DataFrame,
    key: str,
    how: str = "inner",
    hot_share: float = HOT_SHARE,
    salts: int = SALTS,
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """Shuffle join that spreads the rows of the most frequent keys over ``salts`` tasks.

    Keys that at least a ``hot_share`` of the rows of ``facts`` have are found first (:func:`hot_keys`), or those of
    ``hot_from`` if it has them and is cheaper to read; there are at most ``1 / hot_share``, and none
    where keys are even. Any choice of keys gives the same result. Their rows get a salt from the row's hash and its partition, which spreads copies of
    one row too and is the same when a lost task is run again; their rows in ``other`` are
    repeated once per salt. Null keys match nothing, so their rows of ``facts`` are spread as well. All
    other keys keep salt 0.
    """
    frequent = hot_keys(facts if hot_from is None else hot_from, key, hot_share)
    is_hot = F.coalesce(F.col(key).isin(frequent), F.lit(False))
    spread = F.xxhash64(*_hashable(facts)) + F.spark_partition_id()
    row_salt = F.pmod(spread, F.lit(salts)).cast("int")
    left = facts.withColumn("_salt", F.when(is_hot | F.col(key).isNull(), row_salt).otherwise(F.lit(0)))
    all_salts = F.sequence(F.lit(0), F.lit(salts - 1))
    right = other.withColumn("_salt", F.explode(F.when(is_hot, all_salts).otherwise(F.array(F.lit(0)))))
    return left.join(right, [key, "_salt"], how).drop("_salt")


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """Keys that about a ``share`` of the rows or more have, from one pass over the key column alone.

    A sketch of the most frequent items is kept in every task and merged, so nothing is shuffled by key. It
    holds four times as many counters as there can be such keys and never counts a key too low by more than a
    counter's share, so no hot key is missed; one a little below the share may be among them. Keys of types that
    the sketch does not take are counted by key instead.
    """
    most = max(1, int(1 / share))
    if not isinstance(df.schema[key].dataType, _SKETCHED):
        counted = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_rows"))
        least = max(2.0, share * df.count())
        return [row[0] for row in counted.where(F.col("_rows") >= least).select(key).collect()]
    items = F.expr(f"approx_top_k(`{key}`, {most}, {min(1_000_000, 4 * most)})")
    found = df.where(F.col(key).isNotNull()).agg(F.count("*").alias("n"), items.alias("items")).first()
    least = max(2.0, share * found["n"])
    return [row["item"] for row in found["items"] or [] if row["item"] is not None and row["count"] >= least]


def _hashable(df: DataFrame) -> list[Column]:
    """Columns of ``df`` that can be hashed (maps cannot)."""
    return [F.col(name) for name, kind in df.dtypes if "map<" not in kind]


def flag_members(groups: DataFrame, members: DataFrame, key: str, name: str = "is_member") -> DataFrame:
    """``groups`` with a boolean for whether the key is among the distinct keys ``members``.

    Filter by it where ``groups`` is an aggregate: Spark moves a semi or anti join below the
    aggregate, where it would shuffle every row of a frequent key instead of one count.
    """
    marked = members.select(key, F.lit(True).alias(name))
    flag = F.coalesce(F.col(name), F.lit(False))
    return groups.join(marked, key, "left").withColumn(name, flag)
