"""Log reports: an order is a log line, its priority the level, its date the time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import field, joined_key
from tidemark.functions.times import month_name, month_number, parse_log_time
from tidemark.operators.aggregates import count_by
from tidemark.plans.log_reports import keyed_month_report, month_report, month_report_sql, rows_per_key
from tidemark.sources.files import read_table


def order_log(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders")
    return orders.select(
        F.col("o_orderpriority").alias("level"), F.col("o_orderdate").alias("datetime")
    )


def log_month_counts(spark: SparkSession, folder: str) -> DataFrame:
    return month_report(order_log(spark, folder))


def log_month_counts_sql(spark: SparkSession, folder: str) -> DataFrame:
    return month_report_sql(spark, order_log(spark, folder))


def log_level_month_key(spark: SparkSession, folder: str) -> DataFrame:
    return keyed_month_report(order_log(spark, folder))


def log_time_text(spark: SparkSession, folder: str) -> DataFrame:
    """Times written without leading zeros, read back."""
    orders = read_table(spark, folder, "orders")
    day = F.concat_ws("-", F.year("o_orderdate"), F.month("o_orderdate"), F.day("o_orderdate"))
    lines = orders.select("o_orderkey", F.concat_ws(" ", day, F.lit("16:24:07")).alias("datetime"))
    time = parse_log_time(F.col("datetime")).cast("timestamp_ntz")
    return lines.select("o_orderkey", "datetime", time.alias("log_time"))


def month_names_back(spark: SparkSession, folder: str) -> DataFrame:
    """Month names counted, then turned back into numbers."""
    named = order_log(spark, folder).select(month_name(F.month("datetime")).alias("month"))
    return count_by(named, "month").withColumn("month_num", month_number(F.col("month")))


def log_line_fields(spark: SparkSession, folder: str) -> DataFrame:
    """Lines without those that begin like a header, split into fields and keyed again."""
    log = order_log(spark, folder)
    text = F.concat_ws(",", "level", F.date_format("datetime", "yyyy-MM-dd"))
    lines = log.select(text.alias("value")).filter(~F.col("value").startswith("1-URGENT,"))
    level, year = field(F.col("value"), 0), field(field(F.col("value"), 1), 0, "-")
    return count_by(lines.select(joined_key(level, year).alias("level_year")), "level_year")


def key_skew(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem").select("l_partkey")
    return rows_per_key(lines, "l_partkey")[0]


def key_groups(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem").select("l_partkey")
    return rows_per_key(lines, "l_partkey")[1]


QUERIES = {
    "log_month_counts": log_month_counts,
    "log_month_counts_sql": log_month_counts_sql,
    "log_level_month_key": log_level_month_key,
    "log_time_text": log_time_text,
    "month_names_back": month_names_back,
    "log_line_fields": log_line_fields,
    "key_skew": key_skew,
    "key_groups": key_groups,
}

MONTHS = """
    SELECT o_orderpriority AS level, monthname(o_orderdate) AS month, count(*) AS total
    FROM orders GROUP BY o_orderpriority, monthname(o_orderdate), month(o_orderdate)
    ORDER BY month(o_orderdate), level"""

SQL = {
    "log_month_counts": MONTHS,
    "log_month_counts_sql": MONTHS,
    "log_level_month_key": f"SELECT level || ':' || month AS level_month, total FROM ({MONTHS})",
    "log_time_text": """
        SELECT o_orderkey,
               year(o_orderdate) || '-' || month(o_orderdate) || '-' || day(o_orderdate)
                   || ' 16:24:07' AS datetime,
               CAST(o_orderdate::DATE AS TIMESTAMP) + INTERVAL '16:24:07' AS log_time
        FROM orders""",
    "month_names_back": """
        SELECT monthname(o_orderdate) AS month, count(*) AS total,
               CAST(month(o_orderdate) AS INTEGER) AS month_num
        FROM orders GROUP BY ALL""",
    "log_line_fields": """
        SELECT o_orderpriority || ':' || year(o_orderdate) AS level_year, count(*) AS total
        FROM orders WHERE o_orderpriority <> '1-URGENT' GROUP BY 1""",
    "key_skew": """
        SELECT l_partkey, count(*) AS key_rows,
               count(*) / (SELECT count(*) FROM lineitem)::DOUBLE AS share
        FROM lineitem GROUP BY 1""",
    "key_groups": "SELECT count(DISTINCT l_partkey) AS key_count FROM lineitem",
}
