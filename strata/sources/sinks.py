"""Table sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet",
          partition_by: list[str] = (), **options) -> str:
    """Write a table folder. Rows of one partition value are brought together first.

    ``rebalance`` lets the runtime split an oversized value over several tasks and files
    and merge small ones, so neither a dominant value nor many tiny values hurt.
    """
    shaped = df.hint("rebalance", *partition_by) if partition_by else df
    writer = shaped.write.format(fmt).mode(mode).options(**options)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)
    return path


def fan_out(df: DataFrame, path: str, column: str) -> str:
    """One branch per value of `column`, all written in a single pass."""
    return write(df, path, partition_by=[column])


def branch(spark: SparkSession, path: str, column: str, value: str, schema=None) -> DataFrame:
    """One branch of a fan-out; only its own folder is read."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path).where(f"`{column}` = '{value}'")
