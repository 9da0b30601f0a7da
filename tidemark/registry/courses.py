"""Course popularity: a nation watches parts, and parts of one brand and type are a course."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.rules import score_band
from tidemark.plans.course_popularity import (
    chapters_per_course,
    chapters_seen,
    course_scores as popularity,
    watched_shares,
)
from tidemark.sources.files import read_table


def part_views(spark: SparkSession, folder: str) -> DataFrame:
    """``user_id, chapter_id``: every order line, with repeats."""
    lines = read_table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    customers = read_table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    buyers = orders.join(customers, orders.o_custkey == customers.c_custkey)
    return lines.join(buyers, lines.l_orderkey == buyers.o_orderkey).select(
        F.col("c_nationkey").alias("user_id"), F.col("l_partkey").alias("chapter_id")
    )


def part_chapters(spark: SparkSession, folder: str) -> DataFrame:
    """``chapter_id, course_id``."""
    course = F.concat("p_brand", F.lit(" "), "p_type")
    parts = read_table(spark, folder, "part")
    return parts.select(F.col("p_partkey").alias("chapter_id"), course.alias("course_id"))


def part_titles(spark: SparkSession, folder: str) -> DataFrame:
    """``course_id, title``."""
    courses = part_chapters(spark, folder).select("course_id").distinct()
    return courses.withColumn("title", F.concat(F.lit("Course "), "course_id"))


def seen(spark: SparkSession, folder: str) -> DataFrame:
    return chapters_seen(part_views(spark, folder), part_chapters(spark, folder))


def course_scores(spark: SparkSession, folder: str) -> DataFrame:
    return popularity(
        part_views(spark, folder), part_chapters(spark, folder), part_titles(spark, folder)
    )


def distinct_views(spark: SparkSession, folder: str) -> DataFrame:
    return part_views(spark, folder).distinct()


def course_chapters(spark: SparkSession, folder: str) -> DataFrame:
    return chapters_per_course(part_chapters(spark, folder))


def course_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Watched shares with the score each one earns."""
    chapters = part_chapters(spark, folder)
    shares = watched_shares(seen(spark, folder), chapters_per_course(chapters))
    return shares.withColumn("score", score_band(F.col("share")))


QUERIES = {
    "course_scores": course_scores,
    "distinct_views": distinct_views,
    "course_chapters": course_chapters,
    "user_course_views": seen,
    "course_shares": course_shares,
}

VIEWS = """
    views AS (SELECT DISTINCT c_nationkey AS user_id, l_partkey AS chapter_id
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                            JOIN customer ON o_custkey = c_custkey),
    chapters AS (SELECT p_partkey AS chapter_id, p_brand || ' ' || p_type AS course_id FROM part),
    seen AS (SELECT user_id, course_id, count(*) AS seen
             FROM views JOIN chapters USING (chapter_id) GROUP BY ALL),
    sizes AS (SELECT course_id, count(*) AS chapter_count FROM chapters GROUP BY ALL),
    shares AS (SELECT user_id, course_id, seen / chapter_count::DOUBLE AS share
               FROM seen JOIN sizes USING (course_id)),
    scores AS (SELECT *, CASE WHEN share > 0.9 THEN 10 WHEN share > 0.5 THEN 4
                              WHEN share > 0.25 THEN 2 ELSE 0 END::BIGINT AS score
               FROM shares)"""

SQL = {
    "course_scores": f"""
        WITH {VIEWS}
        SELECT sum(score)::BIGINT AS score, 'Course ' || course_id AS title
        FROM scores GROUP BY course_id ORDER BY score DESC, title""",
    "distinct_views": f"WITH {VIEWS} SELECT * FROM views",
    "course_chapters": f"WITH {VIEWS} SELECT * FROM sizes",
    "user_course_views": f"WITH {VIEWS} SELECT * FROM seen",
    "course_shares": f"""
        WITH {VIEWS}
        SELECT course_id, share, count(*) AS users, score FROM scores GROUP BY ALL""",
}
