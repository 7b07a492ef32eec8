"""Named tables of the session catalog: create, append, replace partitions, and buckets that joins and groupings reuse."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Layout:
    """How a table lies on disk. Rows of one `bucket_by` value share a bucket; `sort_by` orders rows inside its files."""

    partition_by: tuple[str, ...] = ()
    buckets: int = 0
    bucket_by: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()


def buckets_for(rows: int, each: int = 500_000, least: int = 8) -> int:
    """Buckets for a table of so many rows: a task that writes, sorts or joins one has about `each`, however large the table is."""
    return max(least, -(-rows // each))


def _shaped(df: DataFrame, layout: Layout) -> DataFrame:
    """Rows dealt so that each task writes whole buckets or partitions, not a file for each of them."""
    if layout.buckets:
        # The hash that the table's buckets use, so a task has the rows of one bucket.
        return df.repartition(layout.buckets, *layout.bucket_by)
    return df.hint("rebalance", *layout.partition_by) if layout.partition_by else df


def create(df: DataFrame, name: str, path: str | None = None, layout: Layout = Layout(), replace: bool = False) -> DataFrame:
    """Create the Parquet table `name` with the rows of `df` and return it; with `path`, its files lie there.

    An existing table is an error unless `replace`, which drops its definition; files at a `path` are overwritten.
    """
    spark = df.sparkSession
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    writer = _shaped(df, layout).write.format("parquet").mode("overwrite" if replace else "errorifexists")
    writer = writer.option("path", path) if path else writer
    writer = writer.partitionBy(*layout.partition_by) if layout.partition_by else writer
    writer = writer.bucketBy(layout.buckets, *layout.bucket_by) if layout.buckets else writer
    writer = writer.sortBy(*layout.sort_by) if layout.buckets and layout.sort_by else writer
    writer.saveAsTable(name)
    return spark.table(name)


def layout_of(spark: SparkSession, name: str) -> Layout:
    """The layout that the catalog has for a table."""
    told = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    columns = spark.catalog.listColumns(name)

    def listed(key: str) -> tuple[str, ...]:
        return tuple(c.strip().strip("`") for c in told.get(key, "[]").strip("[]").split(",") if c.strip())

    return Layout(tuple(c.name for c in columns if c.isPartition), int(told.get("Num Buckets", 0)), listed("Bucket Columns"), listed("Sort Columns"))


def _placed(df: DataFrame, name: str) -> DataFrame:
    """The columns of `df` in the table's order and types; one that is missing becomes null, one too many is an error."""
    target = df.sparkSession.table(name).schema
    unknown = set(df.columns) - set(target.names)
    if unknown:
        raise ValueError(f"table {name} has no columns {sorted(unknown)}")
    return df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in target])


def append(df: DataFrame, name: str) -> None:
    """Add rows, by column name, in the table's own layout."""
    placed = _placed(df, name)
    _shaped(placed, layout_of(df.sparkSession, name)).write.insertInto(name)


def replace_partitions(df: DataFrame, name: str) -> None:
    """Replace the partitions that `df` has rows of and leave the others alone."""
    spark = df.sparkSession
    layout = layout_of(spark, name)
    if not layout.partition_by:
        raise ValueError(f"table {name} has no partitions")
    # Inserts into named tables know this by the session's setting only.
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        _shaped(_placed(df, name), layout).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(setting, before)
