"""Pass flags on exam results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.rules import has_passed


def pass_flags(results: DataFrame, grade: str = "score", subject: str = "subject") -> DataFrame:
    """``results`` with a boolean ``pass``."""
    return results.withColumn("pass", has_passed(F.col(grade), F.col(subject)))
