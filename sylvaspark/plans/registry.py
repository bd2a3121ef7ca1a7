"""Where queries are registered with their SQL for the oracle."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sylvaspark.plans.roles import Roles, with_roles
from sylvaspark.plans.scratch import scratch

__all__ = ["QUERIES", "SQL", "queries", "query", "scratch"]

QUERIES: dict[str, Callable[[Roles], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a function of the roles; the SQL may name roles as tables."""

    def register(f):
        assert name not in QUERIES, name
        QUERIES[name] = f
        if sql:
            SQL[name] = with_roles(sql)
        return f

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, sf_dir, f=f: f(Roles(spark, sf_dir))) for name, f in QUERIES.items()}
