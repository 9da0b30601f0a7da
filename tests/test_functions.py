from __future__ import annotations

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.functions.rules import (
    converted_label,
    country_group,
    has_passed,
    inactive_label,
    register_rules,
    score_band,
    zero_if_null,
)
from tidemark.functions.text import field, joined_key, words
from tidemark.functions.times import month_name, month_number, parse_log_time


def values(spark, schema, data, column):
    df = spark.createDataFrame(data, schema).withColumn("_out", column)
    return [r["_out"] for r in df.collect()]


def test_country_group(spark):
    codes = [(c,) for c in ("GB", "US", "IN", "UNKNOWN", "FR", "EL", "GR", "gb", "", None)]
    found = values(spark, "c string", codes, country_group(F.col("c")))
    assert found == ["GB", "US", "IN", "UNKNOWN", "EUROPE", "EUROPE", "OTHER", "OTHER", "OTHER", "OTHER"]
    changed = country_group(F.col("c"), reported=["FR"], europe=["GR"])
    assert values(spark, "c string", codes, changed)[4:7] == ["FR", "OTHER", "EUROPE"]


EXAMS = [
    ("A+", "Biology"), ("B", "Biology"), ("A", "Maths"), ("C-", "Maths"), ("D", "Maths"), ("", "Maths"),
    (None, "Maths"), ("A", None), (None, "Biology"),
]
PASSED = [True, False, True, True, False, False, None, None, None]


def test_has_passed(spark):
    found = values(spark, "g string, s string", EXAMS, has_passed(F.col("g"), F.col("s")))
    assert found == PASSED


def test_rules_by_name_in_sql(spark):
    register_rules(spark)
    spark.createDataFrame(EXAMS, "g string, s string").createOrReplaceTempView("exams")
    assert [r[0] for r in spark.sql("SELECT has_passed(g, s) FROM exams").collect()] == PASSED
    grouped = spark.sql("SELECT country_group('SE'), country_group('GR'), country_group(NULL)")
    assert tuple(grouped.first()) == ("EUROPE", "OTHER", "OTHER")


def test_score_band(spark):
    shares = [(s,) for s in (1.0, 0.91, 0.9, 0.51, 0.5, 0.26, 0.25, 0.0, None)]
    assert values(spark, "s double", shares, score_band(F.col("s"))) == [10, 10, 4, 4, 2, 2, 0, 0, 0]


def test_labels_of_counts(spark):
    counts = [(0,), (1,), (5,), (None,)]
    assert values(spark, "n int", counts, converted_label(F.col("n"))) == [0, 1, 1, 0]
    assert values(spark, "n int", counts, inactive_label(F.col("n"))) == [1, 0, 0, 1]
    assert values(spark, "n int", counts, zero_if_null(F.col("n"))) == [0, 1, 5, 0]


def test_log_time(spark):
    texts = [("2015-2-6 16:24:07",), ("2012-10-18 04:35:19",)]
    found = values(spark, "t string", texts, parse_log_time(F.col("t")).cast("string"))
    assert found == ["2015-02-06 16:24:07", "2012-10-18 04:35:19"]
    dirty = [("yesterday",), ("2015-13-1 00:00:00",), (None,)]
    assert values(spark, "t string", dirty, parse_log_time(F.col("t"), strict=False)) == [None] * 3
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
        values(spark, "t string", dirty[:1], parse_log_time(F.col("t")))


def test_months_there_and_back(spark):
    months = spark.range(1, 13).select(month_name(F.col("id").cast("int")).alias("name"), "id")
    found = months.withColumn("back", month_number(F.col("name"))).orderBy("id").collect()
    assert [r.back for r in found] == list(range(1, 13))
    assert (found[0].name, found[11].name) == ("January", "December")


def test_fields_and_keys(spark):
    lines = [("WARN,2016-7-26",), ("a|b",), (None,)]
    assert values(spark, "l string", lines, field(F.col("l"), 1)) == ["2016-7-26", None, None]
    assert values(spark, "l string", lines, field(F.col("l"), 1, "|"))[1] == "b"
    assert values(spark, "l string", lines, joined_key(F.col("l"), F.lit("x")))[1] == "a|b:x"


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="ab \t\r\nÉ", max_size=20), min_size=1, max_size=5))
def test_words_of_any_text(spark, texts):
    wanted = [text.split() for text in texts]
    assert values(spark, "t string", [(t,) for t in texts], words(F.col("t"))) == wanted


def test_rules_by_name_in_the_dataframe_api(spark):
    register_rules(spark)
    called = F.call_function("has_passed", F.col("g"), F.col("s"))
    assert values(spark, "g string, s string", EXAMS, called) == PASSED
    grouped = F.call_function("country_group", F.col("c"))
    assert values(spark, "c string", [("FR",), ("XX",)], grouped) == ["EUROPE", "OTHER"]


def test_month_report_holds_all_levels(spark):
    from tidemark.plans.log_reports import keyed_month_report, month_report, month_report_sql

    logs = spark.range(1440).selectExpr(
        "concat('level', id % 12) AS level", "make_timestamp(2020, cast(id div 12 % 12 AS int) + 1, 1, 0, 0, 0) AS datetime"
    )
    for report in (month_report(logs), month_report_sql(spark, logs), keyed_month_report(logs)):
        assert {r["total"] for r in report.collect()} == {10} and report.count() == 144
    assert month_report(logs, rows=5).count() == 5
