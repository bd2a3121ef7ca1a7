"""Each registered query against its SQL in DuckDB, on the smallest tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from sylvaspark.plans import q_domain, q_relational, registry  # noqa: F401

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{DIR}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def _value(v):
    if v is None or v is pd.NaT or v is pd.NA or isinstance(v, float) and v != v:
        return ""
    if isinstance(v, bool):
        return str(v)
    try:
        return f"{float(v):.9g}"
    except (TypeError, ValueError):
        return str(v)


def rows(df):
    df = df[sorted(df.columns)].astype(object)
    return sorted(tuple(map(_value, r)) for r in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_equals_sql(spark, duck, name):
    got, want = registry.queries()[name](spark, DIR).toPandas(), duck.sql(registry.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_all_queries_have_sql():
    assert set(registry.QUERIES) == set(registry.SQL)


def test_entry(spark):
    import __spark_entry__

    out = __spark_entry__.entry(spark)
    assert out.columns == q_relational.EXPORT_COLS and out.count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
