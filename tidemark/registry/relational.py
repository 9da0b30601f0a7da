"""Projections, filters, rules, joins, aggregates and top rows over the business tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.rules import country_group, register_rules
from tidemark.functions.text import field
from tidemark.operators.aggregates import count_by, pivot_sum, sum_by
from tidemark.operators.audit import audit_constraints
from tidemark.operators.joins import lookup
from tidemark.operators.ordering import top, top_per_group as ranked_per_group
from tidemark.plans.conversions import labelled_trials
from tidemark.plans.exam_flags import pass_flags as flagged
from tidemark.plans.forecasts import clean_chapter_views, with_inactive_label, with_views_label
from tidemark.plans.live_views import HEARTBEAT_SECONDS
from tidemark.plans.recommendations import PERCENT
from tidemark.sources.files import read_table

# Stand-in constants: the day on which customers are observed, and how nations are grouped.
OBSERVED = "2001-01-01"
MONTH_BEFORE, MONTH_AFTER = "2000-12-01", "2001-02-01"
REPORTED_NATIONS = ("NATION_0", "NATION_1", "NATION_2", "NATION_3")
EUROPEAN_NATIONS = ("NATION_4", "NATION_5", "NATION_6", "NATION_7", "NATION_8", "NATION_9")


def day(text: str):
    return F.lit(text).cast("timestamp_ntz")


def chapter_views(spark: SparkSession, folder: str) -> DataFrame:
    """One subscription per customer, its orders standing for chapter views."""
    date = F.col("o_orderdate")
    past = date < day(OBSERVED)
    last_month = past & (date >= day(MONTH_BEFORE))
    next_month = (date >= day(OBSERVED)) & (date < day(MONTH_AFTER))
    views = read_table(spark, folder, "orders").groupBy("o_custkey").agg(
        F.sum(F.when(past, 1)).alias("all_time_views"),
        F.sum(F.when(last_month, 1)).alias("last_month_views"),
        F.sum(F.when(next_month, 1)).alias("next_month_views"),
        F.coalesce(F.datediff(day(OBSERVED), F.min(F.when(past, date))), F.lit(0)).alias("age"),
    )
    customers = read_table(spark, folder, "customer")
    nations = read_table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country")
    )
    balance = F.col("c_acctbal")
    joined = customers.join(views, customers.c_custkey == views.o_custkey, "left")
    return lookup(joined, nations, "c_nationkey", "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_mktsegment").alias("payment_method_type"),
        "country",
        F.when(balance < 2000, 1).when(balance < 6000, 6).otherwise(12).alias("rebill_period_in_months"),
        F.when(balance > 1000, 1).alias("firstSub"),
        F.coalesce("age", F.lit(0)).alias("age"),
        "all_time_views",
        "last_month_views",
        "next_month_views",
        (balance < 0).alias("is_cancelled"),
        F.lit(OBSERVED).cast("date").alias("observation_date"),
    )


def free_trials(spark: SparkSession, folder: str) -> DataFrame:
    """One trial per customer; orders after the observed day stand for payments."""
    date = F.col("o_orderdate")
    usage = read_table(spark, folder, "orders").groupBy("o_custkey").agg(
        F.count_if(date >= day(OBSERVED)).alias("payments_made"),
        F.count_if(date < day(OBSERVED)).alias("chapter_access_count"),
        F.coalesce(F.sum(F.when(date < day(OBSERVED), F.floor("o_totalprice"))), F.lit(0)).alias(
            "seconds_watched"
        ),
    )
    views = chapter_views(spark, folder).select("customer_id", "country", "rebill_period_in_months")
    return views.join(usage, views.customer_id == usage.o_custkey).select(
        "customer_id",
        "country",
        F.col("rebill_period_in_months").alias("rebill_period"),
        "payments_made",
        "chapter_access_count",
        "seconds_watched",
    )


def full_scan(spark: SparkSession, folder: str) -> DataFrame:
    read_table(spark, folder, "customer").createOrReplaceTempView("customer_table")
    return spark.sql("SELECT * FROM customer_table")


def constraint_audit(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents")
    return audit_constraints(documents, key=["doc_id"], required=["text", "source"])


def composite_key_audit(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem")
    return audit_constraints(lines, key=["l_orderkey", "l_linenumber"], required=["l_partkey"])


def project_filter(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem").filter("l_returnflag = 'R' AND l_quantity > 25")
    kept = lines.select("l_orderkey", "l_partkey", "l_quantity", "l_linestatus", "l_shipdate")
    return kept.withColumnRenamed("l_quantity", "label").drop("l_linestatus")


def ratio_column(spark: SparkSession, folder: str) -> DataFrame:
    lines = read_table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity"
    )
    return lines.withColumn("unit_price", F.try_divide("l_extendedprice", "l_quantity"))


def scaled_rating(spark: SparkSession, folder: str) -> DataFrame:
    """Swapped key and value, the value scaled, and a constant beside them."""
    lines = read_table(spark, folder, "lineitem")
    return lines.select(
        (F.col("l_discount") * PERCENT).alias("percent"),
        F.col("l_partkey").alias("item"),
        F.lit(1).cast("bigint").alias("one"),
    )


def field_cast(spark: SparkSession, folder: str) -> DataFrame:
    """A field of a delimited text as a number, and as null where it is none."""
    parts = read_table(spark, folder, "part")
    brand = field(F.col("p_brand"), 1, "#")
    return parts.select(
        "p_partkey",
        brand.cast("int").alias("brand_number"),
        field(F.col("p_name"), 0, " ").try_cast("int").alias("name_number"),
        field(F.col("p_name"), 5, " ").alias("sixth_word"),
    )


def country_groups(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents")
    group = country_group(F.upper("lang"))
    grouped = documents.select(F.upper("lang").alias("country"), group.alias("grouped"))
    return count_by(grouped, "country", "grouped")


def exam_results(spark: SparkSession, folder: str) -> DataFrame:
    """The return flag of a line is its grade; half of the lines are in Biology."""
    lines = read_table(spark, folder, "lineitem")
    subject = F.when(F.col("l_linestatus") == "O", "Biology").otherwise("Maths")
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        F.concat("l_returnflag", F.lit("+")).alias("score"),
        subject.alias("subject"),
    )


def pass_flags(spark: SparkSession, folder: str) -> DataFrame:
    return flagged(exam_results(spark, folder))


def country_groups_sql(spark: SparkSession, folder: str) -> DataFrame:
    """:func:`country_groups` with the rule called by name from SQL."""
    register_rules(spark)
    query = """
        SELECT upper(lang) AS country, country_group(upper(lang)) AS grouped, count(1) AS total
        FROM {documents} GROUP BY country, grouped"""
    return spark.sql(query, documents=read_table(spark, folder, "documents"))


def pass_flags_sql(spark: SparkSession, folder: str) -> DataFrame:
    """:func:`pass_flags` with the rule called by name from SQL."""
    register_rules(spark)
    query = "SELECT *, has_passed(score, subject) AS pass FROM {results}"
    return spark.sql(query, results=exam_results(spark, folder))


def views_labels(spark: SparkSession, folder: str) -> DataFrame:
    clean = with_views_label(clean_chapter_views(chapter_views(spark, folder)))
    return clean.select("customer_id", "firstSub", "all_time_views", "last_month_views", "label")


def inactive_labels(spark: SparkSession, folder: str) -> DataFrame:
    clean = with_inactive_label(clean_chapter_views(chapter_views(spark, folder)))
    return clean.select("customer_id", "payment_method_type", "label")


def trial_labels(spark: SparkSession, folder: str) -> DataFrame:
    trials = labelled_trials(free_trials(spark, folder), REPORTED_NATIONS, EUROPEAN_NATIONS)
    return trials.select("customer_id", "country", "label", "seconds_watched")


def lookup_left(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with the label of their key, or null."""
    documents = read_table(spark, folder, "documents").select("doc_id", "source")
    labels = read_table(spark, folder, "labels").select("doc_id", "quality")
    return lookup(documents, labels, "doc_id", "left")


def history_of_users(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of the customers who ever placed an urgent one."""
    orders = read_table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    urgent = orders.where(F.col("o_orderpriority") == "1-URGENT").select("o_custkey").distinct()
    return lookup(orders, urgent, "o_custkey", "left_semi")


def users_without_history(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of the customers who never placed an urgent one."""
    orders = read_table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_orderpriority")
    urgent = orders.where(F.col("o_orderpriority") == "1-URGENT").select("o_custkey").distinct()
    return lookup(orders, urgent, "o_custkey", "left_anti")


def distinct_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "lineitem").select("l_partkey", "l_suppkey").distinct()


def distinct_values(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "orders").select("o_orderpriority").distinct()


def group_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_by(read_table(spark, folder, "lineitem"), "l_suppkey", "l_returnflag")


def group_sums(spark: SparkSession, folder: str) -> DataFrame:
    return sum_by(read_table(spark, folder, "lineitem"), "l_quantity", "l_partkey", name="quantity")


def const_sum(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events")
    return sum_by(events, F.lit(HEARTBEAT_SECONDS), "user_id", name="seconds_watched")


def top_n(spark: SparkSession, folder: str) -> DataFrame:
    """The hundred dearest orders."""
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return top(orders, 100, F.desc("o_totalprice"), "o_orderkey")


def top_per_group(spark: SparkSession, folder: str) -> DataFrame:
    """Five dearest orders per customer."""
    orders = read_table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return ranked_per_group(orders, "o_custkey", 5, F.desc("o_totalprice"), F.asc("o_orderkey"))


def pivoted_sum(spark: SparkSession, folder: str) -> DataFrame:
    """Order value per customer, one column per order status."""
    orders = read_table(spark, folder, "orders")
    wide = pivot_sum(orders, "o_custkey", "o_orderstatus", "o_totalprice", ["F", "O", "P"])
    return wide.select("o_custkey", *[F.round(c, 2).alias(f"sum_{c.lower()}") for c in "FOP"])


QUERIES = {
    "full_scan": full_scan,
    "constraint_audit": constraint_audit,
    "composite_key_audit": composite_key_audit,
    "project_filter": project_filter,
    "ratio_column": ratio_column,
    "scaled_rating": scaled_rating,
    "field_cast": field_cast,
    "country_groups": country_groups,
    "pass_flags": pass_flags,
    "country_groups_sql": country_groups_sql,
    "pass_flags_sql": pass_flags_sql,
    "views_labels": views_labels,
    "inactive_labels": inactive_labels,
    "trial_labels": trial_labels,
    "lookup_left": lookup_left,
    "history_of_users": history_of_users,
    "users_without_history": users_without_history,
    "distinct_pairs": distinct_pairs,
    "distinct_values": distinct_values,
    "group_counts": group_counts,
    "group_sums": group_sums,
    "const_sum": const_sum,
    "top_n": top_n,
    "top_per_group": top_per_group,
    "pivot_sum": pivoted_sum,
}

ACTIVITY = """
    views AS (
        SELECT o_custkey,
               count(*) FILTER (o_orderdate < '2001-01-01') AS all_time_views,
               count(*) FILTER (o_orderdate >= '2000-12-01' AND o_orderdate < '2001-01-01')
                   AS last_month_views,
               count(*) FILTER (o_orderdate >= '2001-01-01' AND o_orderdate < '2001-02-01')
                   AS next_month_views
        FROM orders GROUP BY 1),
    activity AS (
        SELECT c_custkey AS customer_id, c_mktsegment AS payment_method_type,
               CASE WHEN c_acctbal > 1000 THEN 1 ELSE 0 END AS "firstSub",
               coalesce(all_time_views, 0) AS all_time_views,
               coalesce(last_month_views, 0) AS last_month_views,
               coalesce(next_month_views, 0) AS next_month_views
        FROM customer LEFT JOIN views ON c_custkey = o_custkey
        WHERE NOT c_acctbal < 0)"""

EXAMS = """
    exams AS (SELECT l_orderkey, l_linenumber, l_returnflag || '+' AS score,
                     CASE WHEN l_linestatus = 'O' THEN 'Biology' ELSE 'Maths' END AS subject
              FROM lineitem),
    flagged AS (SELECT *, CASE subject WHEN 'Biology' THEN score LIKE 'A%'
                          ELSE score LIKE 'A%' OR score LIKE 'B%' OR score LIKE 'C%' END AS pass
                FROM exams)"""

COUNTRIES = """
    SELECT upper(lang) AS country,
           CASE WHEN upper(lang) IN ('GB', 'US', 'IN', 'UNKNOWN') THEN upper(lang)
                WHEN upper(lang) IN ('DE', 'ES', 'FR') THEN 'EUROPE' ELSE 'OTHER' END AS grouped,
           count(*) AS total
    FROM documents GROUP BY ALL"""

SQL = {
    "full_scan": "SELECT * FROM customer",
    "constraint_audit": """
        SELECT 'not_null(text)' AS check_name, count(*) - count(text) AS violations FROM documents
        UNION ALL SELECT 'not_null(source)', count(*) - count(source) FROM documents
        UNION ALL SELECT 'unique(doc_id)', count(*) - count(DISTINCT doc_id) FROM documents""",
    "composite_key_audit": """
        SELECT 'not_null(l_partkey)' AS check_name, count(*) - count(l_partkey) AS violations
        FROM lineitem
        UNION ALL
        SELECT 'unique(l_orderkey,l_linenumber)', count(*) - count(DISTINCT (l_orderkey, l_linenumber))
        FROM lineitem""",
    "project_filter": """
        SELECT l_orderkey, l_partkey, l_quantity AS label, l_shipdate
        FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 25""",
    "ratio_column": """
        SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity,
               l_extendedprice / nullif(l_quantity, 0) AS unit_price
        FROM lineitem""",
    "scaled_rating": """
        SELECT l_discount * 100 AS percent, l_partkey AS item, 1::BIGINT AS one FROM lineitem""",
    "field_cast": """
        SELECT p_partkey, CAST(split_part(p_brand, '#', 2) AS INTEGER) AS brand_number,
               TRY_CAST(split_part(p_name, ' ', 1) AS INTEGER) AS name_number,
               string_split(p_name, ' ')[6] AS sixth_word
        FROM part""",
    "country_groups": COUNTRIES,
    "country_groups_sql": COUNTRIES,
    "pass_flags": f"WITH {EXAMS} SELECT * FROM flagged",
    "pass_flags_sql": f"WITH {EXAMS} SELECT * FROM flagged",
    "views_labels": f"""
        WITH {ACTIVITY}
        SELECT customer_id, "firstSub", all_time_views, last_month_views, next_month_views AS label
        FROM activity""",
    "inactive_labels": f"""
        WITH {ACTIVITY}
        SELECT customer_id, payment_method_type,
               CASE WHEN next_month_views > 0 THEN 0 ELSE 1 END AS label
        FROM activity""",
    "trial_labels": """
        SELECT c_custkey AS customer_id,
               CASE WHEN n_nationkey <= 3 THEN n_name WHEN n_nationkey <= 9 THEN 'EUROPE'
                    ELSE 'OTHER' END AS country,
               max(CASE WHEN o_orderdate >= '2001-01-01' THEN 1 ELSE 0 END) AS label,
               sum(CASE WHEN o_orderdate < '2001-01-01' THEN floor(o_totalprice)::BIGINT
                   ELSE 0 END)::BIGINT AS seconds_watched
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey
        GROUP BY c_custkey, n_nationkey, n_name""",
    "lookup_left": """
        SELECT doc_id, source, quality FROM documents LEFT JOIN labels USING (doc_id)""",
    "history_of_users": """
        SELECT o_custkey, o_orderkey, o_orderpriority FROM orders
        WHERE o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
    "users_without_history": """
        SELECT o_custkey, o_orderkey, o_orderpriority FROM orders
        WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
    "distinct_pairs": "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem",
    "distinct_values": "SELECT DISTINCT o_orderpriority FROM orders",
    "group_counts": """
        SELECT l_suppkey, l_returnflag, count(*) AS total FROM lineitem GROUP BY ALL""",
    "group_sums": "SELECT l_partkey, sum(l_quantity) AS quantity FROM lineitem GROUP BY ALL",
    "const_sum": """
        SELECT user_id, sum(5)::BIGINT AS seconds_watched FROM events GROUP BY ALL""",
    "top_n": """
        SELECT o_orderkey, o_totalprice FROM orders
        ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""",
    "top_per_group": """
        SELECT o_custkey, o_orderkey, o_totalprice,
               CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)
                    AS INTEGER) AS rank
        FROM orders QUALIFY rank <= 5""",
    "pivot_sum": """
        SELECT o_custkey, round(sum(o_totalprice) FILTER (o_orderstatus = 'F'), 2) AS sum_f,
               round(sum(o_totalprice) FILTER (o_orderstatus = 'O'), 2) AS sum_o,
               round(sum(o_totalprice) FILTER (o_orderstatus = 'P'), 2) AS sum_p
        FROM orders GROUP BY 1""",
}
