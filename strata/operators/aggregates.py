"""Aggregations that can be refreshed or combined without rereading their base."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def partial_stats(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Mergeable statistics per key: min, max, sum and count."""
    return df.groupBy(*keys).agg(F.min(value).alias("min_value"), F.max(value).alias("max_value"),
                                 F.sum(value).alias("sum_value"), F.count(value).alias("n_values"))


def merge_stats(stored: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """Stored statistics after appending rows whose statistics are `delta`.

    Only for append-only bases: a removed or changed row needs a full recompute.
    """
    return (stored.unionByName(delta).groupBy(*keys)
            .agg(F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"),
                 F.sum("sum_value").cast(stored.schema["sum_value"].dataType).alias("sum_value"),
                 F.sum("n_values").alias("n_values")))


def finish_stats(stats: DataFrame, keys: list[str]) -> DataFrame:
    """Published form: min, max, avg and total per key."""
    as_double = [F.col(c).cast("double").alias(n) for c, n in
                 (("min_value", "min_amount"), ("max_value", "max_amount"), ("sum_value", "total_amount"))]
    average = (F.col("sum_value").cast("double") / F.col("n_values")).alias("avg_amount")
    return stats.select(*keys, *as_double, average)


def global_stats(value: str) -> list[Column]:
    """Count, max, min, average and sample standard deviation of one column."""
    return [F.count(value).alias("events"), F.max(value).alias("max"), F.min(value).alias("min"),
            F.avg(value).alias("average"), F.stddev(value).alias("stddev")]


def with_sentinel(values: DataFrame, column: str, sentinel: str) -> DataFrame:
    """Distinct values of a column plus one sentinel row, for pick lists."""
    return values.select(column).distinct().union(values.sparkSession.range(1).select(F.lit(sentinel)))


def shares(df: DataFrame, label: str) -> DataFrame:
    """Row count per label and its share of all rows; the total is taken over the counts."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("t")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def dedup(df: DataFrame, subset: list[str], order: list[str]) -> DataFrame:
    """One row per `subset`: the first by `order`. Combines on the map side, unlike a row-number window."""
    rest = [c for c in df.columns if c not in subset]
    first = F.min(F.struct(*order, *[c for c in rest if c not in order])).alias("_first")
    return df.groupBy(*subset).agg(first).select(*subset, "_first.*").select(*df.columns)
