"""Finding tables in the session catalog."""

from __future__ import annotations

from pyspark.sql import SparkSession


def databases(spark: SparkSession, containing: str = "") -> list[str]:
    return [d.name for d in spark.catalog.listDatabases() if containing in d.name]


def tables(spark: SparkSession, database: str) -> list[str]:
    """Names of the tables and views of a database."""
    return sorted(t.name for t in spark.catalog.listTables(database))
