"""Words: a document's source is its course."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import words
from tidemark.operators.aggregates import word_counts, words_in_every_group
from tidemark.operators.joins import flag_members
from tidemark.plans.keywords import course_keywords as keywords
from tidemark.sources.files import read_table


def benchmark_words(spark: SparkSession, folder: str) -> DataFrame:
    """The words of the benchmark texts, as a word set."""
    texts = read_table(spark, folder, "benchmark")
    return texts.select(F.explode(words(F.col("text"))).alias("word")).distinct()


def common_words(spark: SparkSession, folder: str) -> DataFrame:
    counts = word_counts(read_table(spark, folder, "documents"), "text", "source")
    return words_in_every_group(counts, "source")


def flagged_words(spark: SparkSession, folder: str) -> DataFrame:
    counts = word_counts(read_table(spark, folder, "documents"), "text")
    return flag_members(counts, benchmark_words(spark, folder), "word")


def anti_words(spark: SparkSession, folder: str) -> DataFrame:
    return flagged_words(spark, folder).where("NOT is_member").drop("is_member")


def semi_words(spark: SparkSession, folder: str) -> DataFrame:
    return flagged_words(spark, folder).where("is_member").drop("is_member")


def course_keywords(spark: SparkSession, folder: str) -> DataFrame:
    return keywords(read_table(spark, folder, "documents"), "source")


QUERIES = {
    "common_words": common_words,
    "anti_words": anti_words,
    "semi_words": semi_words,
    "course_keywords": course_keywords,
}

TOKENS = """
    tokens AS (SELECT source, unnest(regexp_split_to_array(text, '[ \\t\\r\\n]+')) AS word
               FROM documents),
    used AS (SELECT source, word FROM tokens WHERE word <> ''),
    known AS (SELECT DISTINCT unnest(regexp_split_to_array(text, '[ \\t\\r\\n]+')) AS word
              FROM benchmark),
    common AS (SELECT word, count(DISTINCT source) AS groups, count(*) AS n FROM used GROUP BY word
               HAVING groups = (SELECT count(DISTINCT source) FROM used))"""

SQL = {
    "common_words": f"WITH {TOKENS} SELECT word, groups, n FROM common",
    "anti_words": f"""
        WITH {TOKENS} SELECT word, count(*) AS n FROM used
        WHERE word NOT IN (SELECT word FROM known) GROUP BY word""",
    "semi_words": f"""
        WITH {TOKENS} SELECT word, count(*) AS n FROM used
        WHERE word IN (SELECT word FROM known) GROUP BY word""",
    "course_keywords": f"""
        WITH {TOKENS} SELECT source, word, count(*) AS n FROM used
        WHERE word NOT IN (SELECT word FROM common) GROUP BY ALL""",
}
