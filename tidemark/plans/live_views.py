"""Viewing time of courses from a stream of heartbeats."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.streaming.leaderboard import start_leaderboard
from tidemark.streaming.windows import sliding_sum, tumbling_sum

# Fixed value: one heartbeat stands for five seconds of viewing.
HEARTBEAT_SECONDS = 5


def viewing_seconds(heartbeats: DataFrame, course: str, time: str, size: str = "2 minutes") -> DataFrame:
    """``window, course, seconds_watched`` in tumbling windows."""
    return tumbling_sum(
        heartbeats, time, size, [course], F.lit(HEARTBEAT_SECONDS), "seconds_watched"
    )


def viewing_seconds_sql(
    spark: SparkSession, heartbeats: DataFrame, course: str, time: str, size: str = "2 minutes"
) -> DataFrame:
    """:func:`viewing_seconds` as SQL over a table, which may be a stream."""
    return spark.sql(f"""
        WITH beats AS (
            SELECT window({time}, '{size}') AS window, string({course}) AS course_name
            FROM {{heartbeats}})
        SELECT window, course_name, {HEARTBEAT_SECONDS} * count(*) AS seconds_watched
        FROM beats
        GROUP BY ALL""", heartbeats=heartbeats)


def viewing_last_hour(heartbeats: DataFrame, course: str, time: str) -> DataFrame:
    """``window, course, seconds_watched`` over 60 minutes, every minute."""
    return sliding_sum(
        heartbeats, time, "60 minutes", "1 minute", [course], F.lit(HEARTBEAT_SECONDS),
        "seconds_watched",
    )


def start_course_leaderboard(
    heartbeats: DataFrame, path: str, checkpoint: str, course: str, time: str,
    rows: int | None = None, report: Callable[[DataFrame], None] | None = None, interval: str | None = None,
) -> StreamingQuery:
    """Start ranking courses by viewing time in the last hour, under ``path``."""
    return start_leaderboard(
        heartbeats, path, checkpoint, time=time, key=course, value=F.lit(HEARTBEAT_SECONDS),
        name="seconds_watched", rows=rows, report=report, interval=interval,
    )
