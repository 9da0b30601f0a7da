"""Plans of registered queries: what is read, shuffled and formatted."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

from tidemark.registry import QUERIES

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="test tables are not here")


def physical_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_columns_and_filters_reach_the_scan(spark):
    plan = physical_plan(QUERIES["project_filter"](spark, str(FOLDER)))
    assert "PushedFilters: [IsNotNull(l_returnflag), IsNotNull(l_quantity)" in plan
    scanned = plan.split("ReadSchema: ")[1]
    assert "l_comment" not in scanned and "l_tax" not in scanned

    plan = physical_plan(QUERIES["log_month_counts"](spark, str(FOLDER)))
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz,o_orderpriority:string>" in plan
    assert "Sort [" in plan and "Limit" not in plan


def test_months_are_grouped_as_numbers(spark):
    """Names are formatted after the aggregate, so not once per row."""
    plan = physical_plan(QUERIES["log_month_counts"](spark, str(FOLDER)))
    assert "date_format" not in plan[plan.index("HashAggregate") :]


def test_sliding_windows_are_repeated_after_the_last_shuffle(spark):
    plan = physical_plan(QUERIES["sliding_2m_2s"](spark, str(FOLDER)))
    before = plan[: plan.index("Exchange")]
    assert "explode(sequence(" in before and plan.count("Exchange") == 2


def test_summaries_read_numbers_and_text_apart(spark):
    """Two aggregates, by hashing and by sorting; no column is read twice."""
    plan = physical_plan(QUERIES["describe_cols"](spark, str(FOLDER)))
    read = [c.split(":")[0] for s in re.findall(r"ReadSchema: struct<([^>]*)>", plan) for c in s.split(",")]
    assert plan.count("FileScan") == 2 and len(read) == len(set(read)) == 6


@pytest.mark.parametrize("name", ["corr_matrix", "feature_screen", "hash_split"])
def test_one_scan_and_at_most_one_shuffle(spark, name):
    plan = physical_plan(QUERIES[name](spark, str(FOLDER)))
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == (name != "hash_split")
