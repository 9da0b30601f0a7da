from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from executed_plans import plan_of
from tidemark.operators.joins import flag_members, hot_keys, is_small, lookup, salted_join


@pytest.fixture
def facts(spark):
    """One key holds a third of the rows, another has many copies of one row, some are null."""
    key = (
        F.when(F.col("id") % 3 == 0, 7)
        .when(F.col("id") % 3 == 1, F.col("id") % 50)
        .when(F.col("id") % 9 == 2, None)
        .otherwise(8)
    )
    row = F.when(key == 8, 0).otherwise(F.col("id"))
    return spark.range(3000).select(key.cast("bigint").alias("k"), row.alias("row"))


@pytest.fixture
def dimension(spark):
    """Keys 0 to 39, key 7 twice, and a null key."""
    data = [(k, f"name {k}") for k in range(40)] + [(7, "other 7"), (None, "nothing")]
    return spark.createDataFrame(data, "k bigint, name string")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(facts, dimension, rows, how):
    wanted = rows(facts.join(dimension, "k", how))
    assert rows(salted_join(facts, dimension, "k", how, hot_share=0.2, salts=8)) == wanted
    assert rows(salted_join(facts, dimension, "k", how)) == wanted
    assert rows(salted_join(facts, dimension, "k", how, hot_from=dimension)) == wanted
    assert rows(lookup(facts, dimension, "k", how)) == wanted
    assert rows(lookup(facts, dimension, "k", how, broadcast_rows=0)) == wanted


def test_salted_join_spreads_a_hot_key(spark, facts, dimension):
    salted = salted_join(facts, dimension, "k", "left_semi", salts=8)
    assert "_salt" not in salted.columns
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        salted = salted_join(facts, dimension, "k", "left_semi", salts=8)
        parts = salted.where("k = 7").select(F.spark_partition_id().alias("p")).distinct().count()
        plain = facts.join(dimension, "k", "left_semi").where("k = 7")
        assert plain.select(F.spark_partition_id().alias("p")).distinct().count() == 1
        assert parts > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_even_keys_are_not_salted(spark, dimension):
    """A key is hot by its share of the rows, not by its place among the keys."""
    even = spark.range(4000).select((F.col("id") % 40).alias("k"))
    plan = plan_of(salted_join(even, dimension, "k", hot_share=0.03))
    assert "k#" in plan and " IN (" not in plan and "INSET" not in plan
    hot = even.union(spark.range(4000).selectExpr("7L AS k"))
    assert salted_join(hot, dimension, "k", hot_share=0.03).count() == hot.join(dimension, "k").count()


@pytest.mark.parametrize("how", ["left", "left_anti"])
def test_salted_join_spreads_null_keys(spark, dimension, how):
    """Half the facts have no key; they take part in no match, but must not meet in one task."""
    facts = spark.range(4000).select(F.when(F.col("id") % 2 == 0, F.col("id") % 30).alias("k"), "id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        nulls = salted_join(facts, dimension, "k", how).where("k IS NULL")
        sizes = [r["count"] for r in nulls.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 2000 and max(sizes) < 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_hot_keys_from_a_sketch(spark):
    """Exact while the sketch holds all keys; no hot key is missed among a hundred thousand others."""
    facts = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"))
    assert hot_keys(facts, "k", 0.1) == [7]
    many = spark.range(300_000).select(
        F.when(F.col("id") % 4 == 0, F.col("id") % 20).otherwise(F.col("id")).cast("string").alias("k")
    )
    found = hot_keys(many.repartition(8), "k", 0.01)
    exact = {r.k for r in many.groupBy("k").count().where("count >= 3000").collect()}
    assert exact <= set(found) and len(exact) == 5 and len(found) < 20
    dates = facts.select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("k").cast("int")).alias("k"))
    assert [str(d) for d in hot_keys(dates, "k", 0.1)] == ["2024-01-08"]
    assert hot_keys(facts.select((F.col("k") == 7).alias("k")), "k", 0.4) == [False]
    assert hot_keys(facts.select(F.lit(None).cast("string").alias("k")), "k") == []
    assert hot_keys(facts.limit(0), "k") == []


def test_hot_keys_are_found_in_one_pass(spark, facts):
    """No shuffle by key: what reaches the one reducing task is a sketch a task."""
    key = facts.where("k IS NOT NULL").agg(F.count("*"), F.expr("approx_top_k(k, 10, 40)"))
    plan = plan_of(key)
    assert plan.count("Exchange SinglePartition") == 1 and "hashpartitioning" not in plan


def test_salted_join_of_nothing(spark, facts, dimension):
    assert salted_join(facts.limit(0), dimension, "k", "left").count() == 0
    nulls = facts.where("k IS NULL")
    assert salted_join(nulls, dimension, "k", "left").count() == nulls.count() > 0


def test_is_small_looks_at_rows_and_text(spark):
    numbers = spark.range(100)
    assert is_small(numbers) and not is_small(numbers, rows=99)
    texts = numbers.select("id", F.repeat(F.lit("x"), 100).alias("t"))
    assert is_small(texts, text_bytes=10_000) and not is_small(texts, text_bytes=9_999)
    assert not is_small(numbers.select(F.array("id").alias("a")))


def test_membership(spark, facts, rows):
    members = spark.createDataFrame([(7,), (7,), (999,)], "k bigint")
    assert lookup(facts, members, "k", "left_semi").count() == facts.where("k = 7").count()
    assert lookup(facts, members, "k", "left_anti").count() == facts.where("k IS NULL OR k <> 7").count()
    counts = facts.groupBy("k").count()
    flagged = flag_members(counts, members.distinct(), "k")
    assert rows(flagged.where("is_member").select("k")) == [(7,)]
    assert flagged.count() == counts.count()


def test_flagged_counts_are_aggregated_before_the_join(spark, facts):
    """An anti join would be moved below the aggregate and shuffle every row."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        members = spark.range(5).withColumnRenamed("id", "k")
        counts = facts.groupBy("k").count()
        plan = plan_of(flag_members(counts, members, "k").where("NOT is_member"))
        assert plan.index("Join") < plan.index("HashAggregate")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
