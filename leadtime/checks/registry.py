"""Named queries with, where SQL can express it, the statement that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} exists")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn
    return keep


def r(column, digits: int = 6):
    """Rounded for comparison, without a negative zero."""
    from pyspark.sql import functions as F
    return F.round(F.col(column) if isinstance(column, str) else column, digits) + F.lit(0.0)
