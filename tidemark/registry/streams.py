"""Event-time windows over the events, in batch and as streams of the same files."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.live_views import (
    start_course_leaderboard,
    viewing_last_hour,
    viewing_seconds,
    viewing_seconds_sql,
)
from tidemark.plans.log_reports import live_level_counts, start_level_counts
from tidemark.session import shared_folder, state_on_disk
from tidemark.sources.files import read_table
from tidemark.sources.schemas import EVENTS
from tidemark.sources.sinks import start_append
from tidemark.sources.streams import table_stream
from tidemark.streaming.leaderboard import read_leaderboard
from tidemark.streaming.updates import read_latest, start_updates
from tidemark.streaming.windows import flat_window, with_event_time

DELAY = "10 minutes"


def events_batch(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "events").select("ts", "event_type", "user_id")


@contextmanager
def in_utc(spark: SparkSession) -> Iterator[None]:
    """Run streams in UTC: a watermark needs times with a zone, and those of the events have none."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def events_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The events as a stream under a watermark."""
    stream = table_stream(spark, folder, "events", EVENTS).select("ts", "event_type", "user_id")
    return with_event_time(stream, "ts", DELAY)


def finish(query: StreamingQuery) -> None:
    """Wait until the query has read all there is; its error, if any, is raised here."""
    query.awaitTermination()


def tumbling_2m(spark: SparkSession, folder: str) -> DataFrame:
    return flat_window(viewing_seconds(events_batch(spark, folder), "event_type", "ts"))


def sliding_2m_2s(spark: SparkSession, folder: str) -> DataFrame:
    return flat_window(live_level_counts(events_batch(spark, folder), "event_type", "ts"))


def sliding_60m_1m(spark: SparkSession, folder: str) -> DataFrame:
    return flat_window(viewing_last_hour(events_batch(spark, folder), "event_type", "ts"))


def stream_tumbling_sql(spark: SparkSession, folder: str) -> DataFrame:
    """SQL over a streaming view, in update mode, merged to the last value per window."""
    base = shared_folder(spark, "tumbling")
    with in_utc(spark):
        windows = viewing_seconds_sql(spark, events_stream(spark, folder), "event_type", "ts")
        keys = ["window_start", "window_end", "course_name"]
        finish(start_updates(flat_window(windows), f"{base}/updates", f"{base}/checkpoint", keys=keys, compact_every=1))
    return read_latest(spark, f"{base}/updates", keys)


def stream_last_hour(spark: SparkSession, folder: str) -> DataFrame:
    """Sliding hours whose end the watermark has passed, appended once each."""
    base = shared_folder(spark, "last-hour")
    with in_utc(spark), state_on_disk(spark):
        hours = viewing_last_hour(events_stream(spark, folder), "event_type", "ts")
        finish(start_append(flat_window(hours), f"{base}/hours", f"{base}/checkpoint"))
    return spark.read.parquet(f"{base}/hours")


def stream_leaderboard(spark: SparkSession, folder: str) -> DataFrame:
    """Users by viewing time in the last hour of the stream."""
    base = shared_folder(spark, "leaderboard")
    with in_utc(spark):
        events = events_stream(spark, folder)
        finish(start_course_leaderboard(events, f"{base}/out", f"{base}/checkpoint", "user_id", "ts"))
    return read_leaderboard(spark, f"{base}/out")


def stream_level_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Events per type in the last two minutes of the stream."""
    base = shared_folder(spark, "levels")
    with in_utc(spark):
        events = events_stream(spark, folder)
        finish(start_level_counts(events, f"{base}/out", f"{base}/checkpoint", "event_type", "ts"))
    return read_leaderboard(spark, f"{base}/out")


QUERIES = {
    "tumbling_2m": tumbling_2m,
    "sliding_2m_2s": sliding_2m_2s,
    "sliding_60m_1m": sliding_60m_1m,
    "stream_tumbling_sql": stream_tumbling_sql,
    "stream_last_hour": stream_last_hour,
    "stream_leaderboard": stream_leaderboard,
    "stream_level_counts": stream_level_counts,
}


def tumbling_sql(key: str) -> str:
    return f"""
        SELECT time_bucket(INTERVAL '2 minutes', ts) AS window_start,
               time_bucket(INTERVAL '2 minutes', ts) + INTERVAL '2 minutes' AS window_end,
               event_type AS {key}, sum(5)::BIGINT AS seconds_watched
        FROM events GROUP BY ALL"""


HOURS = """
    SELECT time_bucket(INTERVAL '1 minute', ts) - to_minutes(i) AS window_start,
           time_bucket(INTERVAL '1 minute', ts) - to_minutes(i) + INTERVAL '1 hour' AS window_end,
           event_type, sum(5)::BIGINT AS seconds_watched
    FROM events, range(60) AS slides(i) GROUP BY ALL"""

SQL = {
    "tumbling_2m": tumbling_sql("event_type"),
    "sliding_2m_2s": """
        SELECT time_bucket(INTERVAL '2 seconds', ts) - to_seconds(2 * i) AS window_start,
               time_bucket(INTERVAL '2 seconds', ts) - to_seconds(2 * i) + INTERVAL '2 minutes'
                   AS window_end,
               event_type, count(*) AS total
        FROM events, range(60) AS slides(i) GROUP BY ALL""",
    "sliding_60m_1m": HOURS,
    "stream_tumbling_sql": tumbling_sql("course_name"),
    "stream_last_hour": f"""
        SELECT * FROM ({HOURS})
        WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL '10 minutes'""",
    "stream_leaderboard": """
        WITH last AS (SELECT time_bucket(INTERVAL '1 minute', max(ts)) + INTERVAL '1 minute'
                             AS window_end FROM events)
        SELECT user_id, sum(5)::BIGINT AS seconds_watched, window_end
        FROM events, last WHERE ts >= window_end - INTERVAL '1 hour'
        GROUP BY ALL""",
    "stream_level_counts": """
        WITH last AS (SELECT time_bucket(INTERVAL '2 seconds', max(ts)) + INTERVAL '2 seconds'
                             AS window_end FROM events)
        SELECT event_type, count(*) AS total, window_end
        FROM events, last WHERE ts >= window_end - INTERVAL '2 minutes'
        GROUP BY ALL""",
}
