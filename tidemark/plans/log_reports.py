"""Log lines counted by level and calendar month."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.text import joined_key
from tidemark.functions.times import month_name
from tidemark.operators.aggregates import count_by, key_count, key_profile
from tidemark.operators.ordering import top
from tidemark.streaming.leaderboard import start_leaderboard
from tidemark.streaming.windows import sliding_sum


def level_month_counts(logs: DataFrame, level: str = "level", time: str = "datetime") -> DataFrame:
    """``level, month_num, total``: grouped by month number, names are formatted afterwards."""
    months = logs.select(F.col(level).alias("level"), F.month(time).alias("month_num"))
    return count_by(months, "level", "month_num")


def month_report(
    logs: DataFrame, level: str = "level", time: str = "datetime", rows: int | None = None
) -> DataFrame:
    """``level, month, total`` in calendar order, then by level; only the first ``rows`` if given."""
    counts = level_month_counts(logs, level, time)
    ordered = counts.orderBy("month_num", "level") if rows is None else top(counts, rows, "month_num", "level")
    return ordered.withColumn("month", month_name(F.col("month_num"))).select("level", "month", "total")


def month_report_sql(spark: SparkSession, logs: DataFrame, rows: int | None = None) -> DataFrame:
    """:func:`month_report` as SQL over ``level, datetime``."""
    report = spark.sql(f"""
        WITH counts AS (
            SELECT level, month(datetime) AS month_num, count(*) AS total
            FROM {{logs}}
            GROUP BY level, month_num)
        SELECT *, date_format(make_date(2000, month_num, 1), 'MMMM') AS month
        FROM counts
        ORDER BY month_num, level
        {"" if rows is None else f"LIMIT {rows}"}""", logs=logs)
    return report.drop("month_num")


def keyed_month_report(
    logs: DataFrame, level: str = "level", time: str = "datetime", rows: int | None = None
) -> DataFrame:
    """:func:`month_report` with one ``level:month`` key: ``level_month, total``."""
    report = month_report(logs, level, time, rows)
    return report.select(joined_key(F.col("level"), F.col("month")).alias("level_month"), "total")


def rows_per_key(logs: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Size and share of every group, and the number of groups."""
    return key_profile(logs, key), key_count(logs, key)


def live_level_counts(
    logs: DataFrame, level: str = "level", time: str = "timestamp",
    size: str = "2 minutes", slide: str = "2 seconds",
) -> DataFrame:
    """Lines per level in sliding windows; ``logs`` may be a stream with a watermark."""
    return sliding_sum(logs, time, size, slide, [level], F.lit(1), "total")


def start_level_counts(
    logs: DataFrame, path: str, checkpoint: str, level: str = "level", time: str = "timestamp",
    rows: int | None = None, report: Callable[[DataFrame], None] | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Start counting the lines per level in the last two minutes after every batch."""
    return start_leaderboard(
        logs, path, checkpoint, time=time, key=level, value=F.lit(1), name="total",
        size=timedelta(minutes=2), slide="2 seconds", rows=rows, report=report, interval=interval,
    )
