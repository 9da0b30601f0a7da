"""Every registered query against its SQL in DuckDB, on whole tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_points
from tidemark.registry import QUERIES, SQL

FOLDER = Path("/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# No Python on rows, no crossed tables; windows are listed below, since one may be a single task.
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "InPandas", "MapInArrow")

pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def ordered(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, duck, name):
    query = QUERIES[name](spark, str(FOLDER))
    found = query.toArrow()
    wanted = duck.sql(SQL[name]).to_arrow_table()
    assert {f.name: str(f.type) for f in found.schema} == {f.name: str(f.type) for f in wanted.schema}
    pd.testing.assert_frame_equal(
        ordered(found.to_pandas()), ordered(wanted.to_pandas()), check_exact=True, check_dtype=False
    )
    plan = query._jdf.queryExecution().executedPlan().toString()
    # products of blocks of rows are numpy's; the window of ranks has a row a task
    if name not in ("als_new_counts", "als_known_topk", "als_history_counts", "corr_matrix_wide"):
        assert not [word for word in FORBIDDEN if word in plan]
    assert not [word for word in FORBIDDEN[:-1] if word in plan]
    assert ("Window [" in plan) == (name in ("top_per_group", "string_index_table"))


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - SQL.keys()))
def test_models_give_rows(spark, name):
    assert QUERIES[name](spark, str(FOLDER)).count() > 0


def test_entry_points(spark):
    assert SQL.keys() <= QUERIES.keys()
    assert QUERIES.keys() <= entry_points.queries().keys()
    assert SQL.keys() <= entry_points.oracle_sql().keys()
    flagship = entry_points.entry(spark)
    assert flagship.columns == ["level", "month", "total"]
    assert flagship.count() > 0
