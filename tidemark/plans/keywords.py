"""Keywords of courses: their words without those that every course uses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.aggregates import word_counts, words_in_every_group
from tidemark.operators.joins import flag_members


def course_keywords(texts: DataFrame, course: str, text: str = "text") -> DataFrame:
    """``course, word, n``: occurrences of each word that is not common to all courses.

    Words are counted per course first; both sides of the join start from that one shuffle. Texts
    without a course are left out.
    """
    counts = word_counts(texts.where(texts[course].isNotNull()), text, course)
    flagged = flag_members(counts, words_in_every_group(counts, course), "word")
    return flagged.where(~F.col("is_member")).select(course, "word", "n")
