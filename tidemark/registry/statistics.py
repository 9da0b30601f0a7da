"""Summary statistics and correlations of order lines."""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.moments import correlation_pairs
from tidemark.operators.statistics import correlation_matrix, correlations_with, describe_columns
from tidemark.plans.forecasts import screen_features
from tidemark.sources.files import read_table

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
TEXTS = ["l_returnflag", "l_linestatus"]


def rounded(df: DataFrame, *columns: str, digits: int = 8) -> DataFrame:
    """Rounded columns, because engines add doubles in different orders; -0.0 becomes 0.0."""
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})


def describe_cols(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem")
    return rounded(describe_columns(lines, [*MEASURES, *TEXTS]), "mean", "stddev", digits=6)


def corr_target(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem")
    return rounded(correlations_with(lines, "l_extendedprice", MEASURES), "corr")


def corr_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(correlation_matrix(read_table(spark, folder, "lineitem"), MEASURES), "corr")


def corr_matrix_wide(spark: SparkSession, folder: str) -> DataFrame:
    """The same pairs from one matrix of products a task, as hundreds of columns need it."""
    return rounded(correlation_pairs(read_table(spark, folder, "lineitem"), MEASURES), "corr")


def feature_screen(spark: SparkSession, folder: str) -> DataFrame:
    """Both steps of feature screening on one table, as rows of pairs."""
    measures = read_table(spark, folder, "lineitem").select(*MEASURES, "l_linenumber", "l_returnflag")
    found = screen_features(
        measures, "l_extendedprice", dropped=["l_returnflag"], dropped_later=["l_linenumber", "l_tax"]
    )
    return rounded(found, "corr")


QUERIES = {
    "describe_cols": describe_cols,
    "corr_target": corr_target,
    "corr_matrix": corr_matrix,
    "corr_matrix_wide": corr_matrix_wide,
    "feature_screen": feature_screen,
}


def corr_sql(a: str, b: str, columns: str) -> str:
    return f"SELECT {columns}, round(corr({a}, {b}), 8) + 0.0 AS corr FROM lineitem"


def pair_sql(a: str, b: str, extra: str = "") -> str:
    return corr_sql(a, b, f"'{a}' AS col_a, '{b}' AS col_b{extra}")


SCREENED = [*MEASURES, "l_linenumber"]
REMAINING = MEASURES[:3]

SQL = {
    "describe_cols": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean,
                   round(stddev_samp({c}), 6) AS stddev, min({c}) AS min, max({c}) AS max,
                   NULL::VARCHAR AS min_text, NULL::VARCHAR AS max_text
            FROM lineitem"""
        for c in MEASURES
    )
    + "".join(
        f""" UNION ALL SELECT '{c}', count({c}), NULL, NULL, NULL, NULL, min({c}), max({c}) FROM lineitem"""
        for c in TEXTS
    ),
    "corr_target": " UNION ALL ".join(
        corr_sql(c, "l_extendedprice", f"""'{c}' AS "column" """) for c in MEASURES
    ),
    "corr_matrix": " UNION ALL ".join(pair_sql(a, b) for a, b in product(MEASURES, MEASURES)),
    "corr_matrix_wide": " UNION ALL ".join(pair_sql(a, b) for a, b in product(MEASURES, MEASURES)),
    "feature_screen": " UNION ALL ".join(
        [pair_sql(c, "l_extendedprice", ", 1 AS step") for c in SCREENED]
        + [pair_sql(a, b, ", 2 AS step") for a, b in product(REMAINING, REMAINING)]
    ),
}
