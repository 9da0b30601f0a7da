"""Registered queries: the same rows as SQL on whole tables, or a plain version in other files."""

from __future__ import annotations

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_points
from tidemark.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, name):
    found = QUERIES[name](spark, FOLDER).toPandas()
    duck = duckdb.connect()
    for table in ("documents", "conversations", "pages"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    wanted = duck.sql(SQL[name]).df()
    columns = sorted(wanted.columns)
    assert sorted(found.columns) == columns

    def ordered(frame):
        return frame[columns].sort_values(columns).reset_index(drop=True)

    pd.testing.assert_frame_equal(ordered(found), ordered(wanted), check_dtype=False)


def test_all_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {n.split("_")[0] for n in QUERIES if n.startswith("op")}
    assert QUERIES.keys() <= entry_points.queries().keys()
    assert SQL.keys() <= entry_points.oracle_sql().keys()
