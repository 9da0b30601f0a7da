"""Popularity of courses from the chapters their users watched."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.rules import score_band
from tidemark.operators.aggregates import count_by, sum_by
from tidemark.operators.joins import BROADCAST_ROWS, lookup


def chapters_per_course(chapters: DataFrame, course: str = "course_id") -> DataFrame:
    return count_by(chapters, course, name="chapter_count")


def chapters_seen(
    views: DataFrame,
    chapters: DataFrame,
    user: str = "user_id",
    chapter: str = "chapter_id",
    course: str = "course_id",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Number of different chapters each user saw of each course: ``user, course, seen``.

    Repeated views go before the join, so copies of one view are never shuffled for it.
    """
    distinct_views = views.select(user, chapter).distinct()
    bridge = chapters.select(chapter, course)
    located = lookup(
        distinct_views, bridge, chapter, broadcast_rows=broadcast_rows, hot_from=views.select(chapter)
    )
    return count_by(located, user, course, name="seen")


def watched_shares(seen: DataFrame, chapter_counts: DataFrame, course: str = "course_id") -> DataFrame:
    """Users per course and watched share: ``course, share, users``.

    All users of a course who saw equally many chapters score the same, so they are counted before
    the join. A popular course then brings as many rows as it has chapters, not users.
    """
    alike = count_by(seen, course, "seen", name="users")
    share = F.try_divide(F.col("seen"), F.col("chapter_count"))
    return alike.join(chapter_counts, course).select(course, share.alias("share"), "users")


def course_points(shares: DataFrame, course: str = "course_id") -> DataFrame:
    """Sum of the users' scores per course: ``course, score``."""
    return sum_by(shares, score_band(F.col("share")) * F.col("users"), course, name="score")


def course_scores(
    views: DataFrame,
    chapters: DataFrame,
    titles: DataFrame,
    user: str = "user_id",
    chapter: str = "chapter_id",
    course: str = "course_id",
    title: str = "title",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``score, title`` from the most to the least popular course.

    Courses without views, chapters or title do not appear.
    """
    seen = chapters_seen(views, chapters, user, chapter, course, broadcast_rows)
    shares = watched_shares(seen, chapters_per_course(chapters, course), course)
    named = course_points(shares, course).join(titles.select(course, title), course)
    return named.select("score", title).orderBy(F.desc("score"), title)
