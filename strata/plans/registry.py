"""Registration of runnable queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register ``fn(spark, sf_dir)``; `sql` computes the same rows in ANSI SQL.

    A registered query sets the session to UTC, the zone its tables are meant in.
    """

    def register(fn: Query) -> Query:
        key = name or fn.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        QUERIES[key] = run
        if sql:
            ORACLE[key] = sql
        return fn

    return register
