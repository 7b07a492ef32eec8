"""Statistics per key that are stored in hash buckets and refreshed by appends alone."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import workspace
from strata.operators import aggregates

BUCKET, THROUGH = "_bucket", "_through"


@dataclass(frozen=True)
class StoredStats:
    """min, max, sum and count of `value` per key below `path`; `schema` has the keys and `value`, as in the rows appended.

    Buckets are folders. An append reads and replaces those its keys fall into, so with many more buckets than keys in an append
    its cost follows the append and not the table. Each bucket carries the number of the last append it has seen: an append that was
    cut off half-way is simply given again and goes into the buckets that lack it. Appends have rising numbers.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: list[str]
    value: str
    buckets: int = 1024

    @property
    def stored(self) -> T.StructType:
        """What the files hold."""
        empty = aggregates.partial_stats(self.spark.createDataFrame([], self.schema), self.keys, self.value)
        return T.StructType([*empty.schema, T.StructField(THROUGH, T.LongType()), T.StructField(BUCKET, T.IntegerType())])

    def append(self, rows: DataFrame, number: int) -> list[int]:
        """Add rows; returns the buckets that were replaced."""
        stats = aggregates.partial_stats(rows.select(*self.schema.names), self.keys, self.value)
        place = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        delta = workspace.materialize(stats.withColumn(BUCKET, place), "stats-delta")
        touched = {r[0] for r in delta.select(BUCKET).distinct().collect()}
        old = self.buckets_of(sorted(touched))
        done = {r[0] for r in old.where(F.col(THROUGH) >= number).select(BUCKET).distinct().collect()}
        some = sorted(touched - done)
        if not some:
            return []
        old, delta = (df.where(F.col(BUCKET).isin(some)).drop(THROUGH) for df in (old, delta))
        merged = aggregates.merge_stats(old.select(*delta.columns), delta, [*self.keys, BUCKET])
        merged = workspace.materialize(merged.withColumn(THROUGH, F.lit(number).cast("bigint")), "stats-merged")
        (merged.select(*self.stored.names).hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET)
         .option("partitionOverwriteMode", "dynamic").parquet(self.path))
        return some

    def buckets_of(self, some: list[int] | None = None) -> DataFrame:
        """The stored rows, of some buckets or of all."""
        if not workspace.exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.stored)
        rows = self.spark.read.schema(self.stored).parquet(self.path)
        return rows if some is None else rows.where(F.col(BUCKET).isin(some))

    def read(self) -> DataFrame:
        """min, max, avg and total per key, without a shuffle."""
        return aggregates.finish_stats(self.buckets_of(), self.keys)
