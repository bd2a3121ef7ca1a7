"""The training-data queries that SQL can express against it, on the smallest tables."""

import glob
import os

import duckdb
import pytest

from sylvaspark.llm import queries
from tests.test_oracle import DIR, rows


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{DIR}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got, want = queries.queries()[name](spark, DIR).toPandas(), duck.sql(queries.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got) == len(want)
    assert rows(got) == rows(want)
