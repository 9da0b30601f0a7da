"""Business rules as native expressions, and the same rules as named SQL functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Countries reported under their own code, and codes reported as EUROPE.
REPORTED_COUNTRIES = ("GB", "US", "IN", "UNKNOWN")
EUROPEAN_COUNTRIES = (
    "BE", "BG", "CZ", "DK", "DE", "EE", "IE", "EL", "ES", "FR", "HR", "IT", "CY", "LV", "LT", "LU",
    "HU", "MT", "NL", "AT", "PL", "PT", "RO", "SI", "SK", "FI", "SE", "CH", "IS", "NO", "LI", "EU",
)
# Points for the share of a course watched, highest band first.
SCORE_BANDS = ((0.9, 10), (0.5, 4), (0.25, 2))
# Grades that pass, and the subject that only passes with the best one.
PASS_GRADES = ("A", "B", "C")
STRICT_SUBJECT, STRICT_GRADE = "Biology", "A"


def country_group(
    country: Column,
    reported: Sequence[str] = REPORTED_COUNTRIES,
    europe: Sequence[str] = EUROPEAN_COUNTRIES,
) -> Column:
    """Reporting group of a country code; an unknown or null code is OTHER."""
    return (
        F.when(country.isin(*reported), country)
        .when(country.isin(*europe), F.lit("EUROPE"))
        .otherwise(F.lit("OTHER"))
    )


def has_passed(grade: Column, subject: Column) -> Column:
    """Pass flag of a letter grade such as ``B+``; null if either input is null."""
    strict = grade.startswith(STRICT_GRADE)
    usual = F.substring(grade, 1, 1).isin(*PASS_GRADES)
    return F.when(subject == STRICT_SUBJECT, strict).when(subject != STRICT_SUBJECT, usual)


def score_band(share: Column, bands: Sequence[tuple[float, int]] = SCORE_BANDS) -> Column:
    """Points of the first band whose threshold ``share`` exceeds, else 0."""
    hits = [F.when(share > threshold, F.lit(points).cast("bigint")) for threshold, points in bands]
    return F.coalesce(*hits, F.lit(0).cast("bigint"))


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def converted_label(payments: Column) -> Column:
    """1 if there is at least one payment, else (and for null) 0."""
    return F.when(payments >= 1, 1).otherwise(0)


def inactive_label(views: Column) -> Column:
    """0 if there are views; 1 for none, and for null."""
    return F.when(views > 0, 0).otherwise(1)


def register_rules(spark: SparkSession) -> None:
    """Make ``country_group`` and ``has_passed`` callable by name from SQL.

    They are SQL functions, so Catalyst inlines their bodies as it does native expressions.
    """

    def listed(values: Sequence[str]) -> str:
        return ", ".join(f"'{v}'" for v in values)

    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION country_group(country STRING) RETURNS STRING
        RETURN CASE WHEN country IN ({listed(REPORTED_COUNTRIES)}) THEN country
                    WHEN country IN ({listed(EUROPEAN_COUNTRIES)}) THEN 'EUROPE'
                    ELSE 'OTHER' END""")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION has_passed(grade STRING, subject STRING) RETURNS BOOLEAN
        RETURN CASE WHEN subject = '{STRICT_SUBJECT}' THEN startswith(grade, '{STRICT_GRADE}')
                    WHEN subject <> '{STRICT_SUBJECT}'
                    THEN substring(grade, 1, 1) IN ({listed(PASS_GRADES)}) END""")
