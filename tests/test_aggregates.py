from __future__ import annotations

import math
import re

import pytest
from pyspark.sql import functions as F

from executed_plans import plan_of
from tidemark.operators.aggregates import (
    count_by,
    key_count,
    key_profile,
    pivot_sum,
    sum_by,
    word_counts,
    words_in_every_group,
)
from tidemark.operators.audit import audit_constraints
from tidemark.operators.ordering import top, top_per_group
from tidemark.operators.statistics import correlation_matrix, correlations_with, describe_columns
from tidemark.plans.forecasts import screen_features
from tidemark.plans.keywords import course_keywords

SALES = [("a", "x", 1.0), ("a", "y", 2.0), ("a", "x", 4.0), ("b", "z", 8.0), (None, "x", 16.0)]


@pytest.fixture
def sales(spark):
    return spark.createDataFrame(SALES, "k string, c string, v double")


def test_counts_and_sums(sales, rows):
    assert rows(count_by(sales, "k")) == [("a", 3), ("b", 1), (None, 1)]
    assert rows(sum_by(sales, "v", "k")) == [("a", 7.0), ("b", 8.0), (None, 16.0)]
    assert rows(sum_by(sales, F.lit(5), "k", name="s")) == [("a", 15), ("b", 5), (None, 5)]


def test_key_profile(sales, rows):
    assert rows(key_profile(sales, "k")) == [("a", 3, 0.6), ("b", 1, 0.2), (None, 1, 0.2)]
    assert key_count(sales, "k").first()[0] == count_by(sales, "k").count() == 3
    assert key_count(sales.limit(0), "k").first()[0] == 0


def test_pivot_sum_equals_the_pivot_of_spark(sales, rows):
    found = pivot_sum(sales, "k", "c", "v", ["x", "y", "none"])
    assert rows(found) == rows(sales.groupBy("k").pivot("c", ["x", "y", "none"]).sum("v"))
    assert plan_of(found).count("Exchange hashpartitioning") == 1


def test_words(spark, rows):
    data = [("s1", "the cat the dog"), ("s2", "the\tbird\r\n"), ("s3", "the  cat"), ("s4", "  ")]
    texts = spark.createDataFrame(data, "source string, text string")
    counts = word_counts(texts, "text", "source")
    assert ("s1", "the", 2) in rows(counts) and counts.count() == 7
    assert rows(words_in_every_group(counts, "source")) == [("the", 3, 4)]
    assert rows(course_keywords(texts, "source").select("source", "word", "n")) == [
        ("s1", "cat", 1), ("s1", "dog", 1), ("s2", "bird", 1), ("s3", "cat", 1)
    ]


def test_texts_are_split_once(spark, tmp_path):
    spark.createDataFrame([("s", "a b")], "source string, text string").write.parquet(f"{tmp_path}/t")
    plan = plan_of(course_keywords(spark.read.parquet(f"{tmp_path}/t"), "source"))
    assert plan.count("FileScan") == 1


def test_audit(spark, rows):
    table = spark.createDataFrame([(1, "t"), (1, None), (1, "u"), (None, "v")], "id int, title string")
    assert rows(audit_constraints(table, ["id"], ["id", "title"])) == [
        ("not_null(id)", 1), ("not_null(title)", 1), ("unique(id)", 2)
    ]


def test_top(spark, sales, rows):
    assert [r.v for r in top(sales, 2, F.desc("v")).collect()] == [16.0, 8.0]
    assert "TakeOrderedAndProject" in plan_of(top(sales, 2, F.desc("v")))


def test_top_per_group_limits_before_the_shuffle(spark, sales, rows):
    found = top_per_group(sales, "k", 2, F.desc("v"))
    assert rows(found.select("k", "v", "rank")) == [
        ("a", 2.0, 2), ("a", 4.0, 1), ("b", 8.0, 1), (None, 16.0, 1)
    ]
    plan = plan_of(found)
    assert "Partial" in plan and "WindowGroupLimit" in plan


@pytest.fixture
def measures(spark):
    data = [(float(i), float(i * i), float(-i), None if i == 3 else 1.0 * (i % 2)) for i in range(6)]
    return spark.createDataFrame(data, "a double, b double, c double, d double")


def test_correlations(measures, rows):
    columns = ["a", "b", "c", "d"]
    matrix = {(r.col_a, r.col_b): r["corr"] for r in correlation_matrix(measures, columns).collect()}
    assert len(matrix) == 16
    for a in columns:
        assert math.isclose(matrix[a, a], 1.0)
        for b in columns:
            assert matrix[a, b] == matrix[b, a]
            if "d" not in (a, b):
                assert math.isclose(matrix[a, b], measures.stat.corr(a, b), abs_tol=1e-12)
    target = {r.column: r["corr"] for r in correlations_with(measures, "a", columns).collect()}
    assert all(math.isclose(target[c], matrix[c, "a"], abs_tol=1e-12) for c in columns)


def test_screening_drops_columns_in_two_steps(measures):
    found = screen_features(measures, "a", ["d"], ["c"]).collect()
    assert [(r.col_a, r.col_b) for r in found if r.step == 1] == [("a", "a"), ("b", "a"), ("c", "a")]
    assert {(r.col_a, r.col_b) for r in found if r.step == 2} == {(x, y) for x in "ab" for y in "ab"}
    assert all(math.isclose(r["corr"], measures.stat.corr(r.col_a, r.col_b), abs_tol=1e-12) for r in found)


def test_describe_equals_spark(measures):
    found = {r.column: r for r in describe_columns(measures, ["a", "d"]).collect()}
    wanted = {r.summary: r for r in measures.describe("a", "d").collect()}
    for c in ("a", "d"):
        for name in ("count", "mean", "stddev", "min", "max"):
            assert math.isclose(float(found[c][name]), float(wanted[name][c]))


def test_describe_of_text(spark):
    df = spark.createDataFrame([("b", 1, True), (None, 2, False), ("a", None, None)], "t string, n int, f boolean")
    found = {r.column: r for r in describe_columns(df, ["t", "n", "f"]).collect()}
    assert (found["t"]["count"], found["t"].min_text, found["t"].max_text, found["t"].mean) == (2, "a", "b", None)
    assert (found["n"].min, found["n"].max, found["n"].min_text) == (1.0, 2.0, None)
    assert (found["f"]["count"], found["f"].min_text, found["f"].max_text) == (2, "false", "true")
    assert describe_columns(df.limit(0), ["t"]).first()["count"] == 0


def test_describe_sums_numbers_by_hashing(spark, tmp_path):
    """Text beside numbers does not make their aggregate sort, and no column is read twice."""
    data = spark.range(1000).select("id", (F.col("id") / 7).alias("x"), F.concat(F.lit("t"), "id").alias("t"))
    data.write.parquet(str(tmp_path / "data"))
    read = spark.read.parquet(str(tmp_path / "data"))
    plan = plan_of(describe_columns(read, ["id", "t", "x"]))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert sorted(schemas) == ["id:bigint,x:double", "t:string"]
    assert plan.count("HashAggregate") >= 2 and plan.count("SortAggregate") == 2
    found = {r.column: r for r in describe_columns(read, ["id", "t", "x"]).collect()}
    assert (found["id"].max, found["t"].max_text, found["x"]["count"]) == (999.0, "t999", 1000)
