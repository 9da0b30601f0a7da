"""Summary statistics and correlations, each in a single pass over the data."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def describe_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, count, mean, stddev, min, max, min_text, max_text``, one row per column.

    Numbers have all but the texts; columns of other types have only the count and the first and last
    value in text order.
    """
    numeric = {field.name for field in df.schema if isinstance(field.dataType, NumericType)}
    numbers, others = [c for c in columns if c in numeric], [c for c in columns if c not in numeric]
    # Extremes of text are aggregated by sorting, so that numbers have an aggregate of their own, by hashing. No
    # column is read twice.
    parts = [
        df.agg(F.array(*[_summary(c, c in numeric) for c in part]).alias("rows")) for part in (numbers, others) if part
    ]
    return reduce(DataFrame.unionAll, parts).selectExpr("inline(rows)")


def _summary(column: str, numeric: bool) -> Column:
    number, text = F.lit(None).cast("double"), F.lit(None).cast("string")
    value = F.col(column)
    return F.struct(
        F.lit(column).alias("column"),
        F.count(value).alias("count"),
        (F.avg(value) if numeric else number).alias("mean"),
        (F.stddev_samp(value) if numeric else number).alias("stddev"),
        (F.min(value).cast("double") if numeric else number).alias("min"),
        (F.max(value).cast("double") if numeric else number).alias("max"),
        (text if numeric else F.min(value.cast("string"))).alias("min_text"),
        (text if numeric else F.max(value.cast("string"))).alias("max_text"),
    )


def correlation_steps(df: DataFrame, steps: Sequence[Sequence[tuple[str, str]]]) -> DataFrame:
    """``step, col_a, col_b, corr`` of lists of pairs, numbered from 1, in one aggregate.

    A pair that occurs in several steps or in both orders is computed once. Meant for tens of columns,
    since every pair is an aggregate.
    """
    wanted = [(step, *pair) for step, pairs in enumerate(steps, 1) for pair in pairs]
    unordered = sorted({tuple(sorted(pair)) for _, *pair in wanted})
    names = {pair: f"corr_{n}" for n, pair in enumerate(unordered)}
    found = df.agg(*[F.corr(*pair).alias(name) for pair, name in names.items()])
    rows = [
        F.struct(
            F.lit(step).alias("step"),
            F.lit(a).alias("col_a"),
            F.lit(b).alias("col_b"),
            F.col(names[tuple(sorted((a, b)))]).alias("corr"),
        )
        for step, a, b in wanted
    ]
    return found.select(F.inline(F.array(*rows)))


def correlations_with(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column with ``target``: ``column, corr``."""
    found = correlation_steps(df, [[(c, target) for c in columns]])
    return found.select(F.col("col_a").alias("column"), "corr")


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, in both orders: ``col_a, col_b, corr``."""
    return correlation_steps(df, [list(product(columns, columns))]).drop("step")
