"""Stored snapshots whose differences are found by bucket digests.

Rows are dealt into buckets by a hash of their key, one folder each. With every snapshot goes a small table of digests: for each
bucket the number of rows and two sums of row hashes, which do not depend on the order of rows. Two snapshots
differ only in buckets whose digests differ; all other folders are neither read nor joined.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import workspace
from strata.operators import snapshots
from strata.operators.cdc import END, START

BUCKET = "_bucket"


def _hash(columns: list[str], *more: Column) -> Column:
    """Hash of a row in which a null differs from nothing at its place."""
    return F.xxhash64(*more, *[c for name in columns for c in (F.col(name), F.col(name).isNull())])


@dataclass(frozen=True)
class SnapshotStore:
    """Snapshots of one table below `path`; `schema` without map columns, keys may be null.

    Choose `buckets` so that one holds a few hundred MB: the unit that is read when a row in it has changed.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: list[str]
    buckets: int = 256

    def _rows(self, version) -> str:
        return f"{self.path}/rows/version={version}"

    def _digests(self, version) -> str:
        return f"{self.path}/digests/version={version}"

    def _bucketed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(BUCKET, F.pmod(_hash(self.keys), F.lit(self.buckets)).cast("int"))

    def write(self, snapshot: DataFrame, version) -> None:
        """Store a snapshot. It counts as there once its digests, which are taken from the stored rows, are."""
        rows = self._bucketed(snapshot.select(*self.schema.names))
        rows.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(self._rows(version))
        total = "decimal(38,0)"
        digests = self.read(version, bucket=True).groupBy(BUCKET).agg(
            F.count(F.lit(1)).alias("n"), F.sum(_hash(self.schema.names).cast(total)).alias("h1"),
            F.sum(_hash(self.schema.names, F.lit("second")).cast(total)).alias("h2"))
        digests.repartition(1).write.mode("overwrite").parquet(self._digests(version))

    def versions(self) -> list[str]:
        """Names of the complete snapshots, sorted."""
        names = [n.split("=", 1)[1] for n in workspace.child_dirs(self.spark, f"{self.path}/digests")]
        return [v for v in names if workspace.committed(self.spark, self._digests(v))]

    def read(self, version, some: list[int] | None = None, bucket: bool = False) -> DataFrame:
        """A snapshot, or only some of its buckets; the others are not listed."""
        stored = T.StructType([*self.schema, T.StructField(BUCKET, T.IntegerType())])
        rows = self.spark.read.schema(stored).parquet(self._rows(version))
        rows = rows if some is None else rows.where(F.col(BUCKET).isin(some))
        return rows if bucket else rows.drop(BUCKET)

    def changed(self, before, after) -> list[int]:
        """The buckets in which two snapshots differ; there are at most `buckets`."""
        sums = T.StructType.fromDDL(f"{BUCKET} INT, n BIGINT, h1 DECIMAL(38,0), h2 DECIMAL(38,0)")
        old, new = (self.spark.read.schema(sums).parquet(self._digests(v)) for v in (before, after))
        differ = (old.unionByName(new).groupBy(BUCKET, "n", "h1", "h2").count().where("count = 1").select(BUCKET).distinct())
        return sorted(r[0] for r in differ.collect())

    def change_set(self, before, after) -> DataFrame:
        """Rows that turn one snapshot into another, with ``_change`` insert, update or delete."""
        some = self.changed(before, after)
        return snapshots.change_set(self.read(before, some), self.read(after, some), self.keys)

    def current(self, versions: list) -> DataFrame:
        """Type 1: the first snapshot, in which each later one replaces the rows that it changes, bucket by bucket."""
        first, *later = versions
        target = workspace.new_dir(self.spark, "type1")
        self._replace(self.read(first, bucket=True), target)
        for before, after in zip(versions, later):
            some = self.changed(before, after)
            rows = self._stored(target, self.schema).where(F.col(BUCKET).isin(some))
            step = snapshots.apply_change_set(rows.drop(BUCKET), self.change_set(before, after), self.keys)
            self._replace(self._bucketed(workspace.materialize(step, "type1-step")), target, some)
        return self._stored(target, self.schema).drop(BUCKET)

    def history(self, versions: list, track: list[str] | None = None) -> DataFrame:
        """Type 2 history of a series; as `snapshots.history`, but a step joins only what has changed.

        Open versions are kept by bucket and replaced where a snapshot changes something, closed ones are appended.
        """
        first, *later = versions
        base = workspace.new_dir(self.spark, "type2")
        at = F.lit(first)
        opened = self.read(first, bucket=True).withColumns({START: at, END: F.when(F.lit(False), at)})
        schema = T.StructType([f for f in opened.schema if f.name != BUCKET])
        self._replace(opened, f"{base}/open")
        closed = [self.spark.createDataFrame([], schema)]
        for before, after in zip(versions, later):
            some = self.changed(before, after)
            rows = self._stored(f"{base}/open", schema).where(F.col(BUCKET).isin(some)).drop(BUCKET)
            step = snapshots.advance_history(rows, self.read(after, some), after, self.keys, track)
            step = workspace.materialize(step.select(*schema.names), "type2-step")
            closed.append(step.where(F.col(END).isNotNull()))
            self._replace(self._bucketed(step.where(F.col(END).isNull())), f"{base}/open", some)
        return reduce(DataFrame.unionByName, closed, self._stored(f"{base}/open", schema).drop(BUCKET))

    def _stored(self, path: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(T.StructType([*schema, T.StructField(BUCKET, T.IntegerType())])).parquet(path)

    def _replace(self, rows: DataFrame, path: str, some: list[int] | None = None) -> None:
        """Write `rows` over the buckets they belong to, and over all buckets in `some`, even if no row is left."""
        (rows.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET)
         .option("partitionOverwriteMode", "static" if some is None else "dynamic").parquet(path))
        if some:
            left = {r[0] for r in rows.select(BUCKET).distinct().collect()}
            for bucket in set(some) - left:
                workspace.remove(self.spark, f"{path}/{BUCKET}={bucket}")
