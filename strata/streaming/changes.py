"""Change feeds as streams into a keyed table on plain files.

Each micro-batch is reduced to what a reader needs and stored as one folder named by
its batch id. A folder gets its name when it is complete, so readers see whole batches only, and a
batch that is repeated after that changes nothing. The cost of a batch depends on the
batch, not on the table. `compact` folds older folders into a base every so many batches;
batch and base folders older than the newest base are no longer read.
Deletes stay in the stored rows, so a late change cannot bring a deleted key back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import workspace
from strata.operators import cdc
from strata.streaming import runner


class ChangeTable:
    """Keyed table fed by change batches; `scd_type` 1 stores newest changes, 2 stores all."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], sequence_by: str,
                 deletes: str | None = None, except_columns: list[str] = (), scd_type: int = 1,
                 compact_every: int | None = 100):
        self.compact_every = compact_every
        self.spark, self.path, self.keys, self.sequence_by = spark, path, keys, sequence_by
        self.deletes, self.except_columns, self.scd_type = deletes, list(except_columns), scd_type
        self.schema = schema
        self.stored = T.StructType(schema.fields + [T.StructField("_deleted", T.BooleanType())])

    def _merged(self, flagged: DataFrame) -> DataFrame:
        """What has to be kept of changes already marked ``_deleted``: the newest, or all distinct ones."""
        if self.scd_type == 1:
            return cdc.newest(flagged, self.keys, self.sequence_by)
        return flagged.dropDuplicates()

    def fold(self, batch: DataFrame, batch_id: int) -> None:
        """Store one micro-batch."""
        self._complete(self._merged(cdc.flag_deletes(batch, self.deletes)), f"changes/batch={batch_id}")
        if self.compact_every and batch_id % self.compact_every == self.compact_every - 1:
            self.compact()

    def _complete(self, rows: DataFrame, name: str) -> None:
        """Write `rows` aside and give them their name, unless they have it already from a run before."""
        final = f"{self.path}/{name}"
        if not workspace.exists(self.spark, final):
            staged = f"{self.path}/staged/{uuid.uuid4().hex}"
            rows.write.parquet(staged)
            workspace.make_dir(self.spark, final.rsplit("/", 1)[0])
            workspace.rename(self.spark, staged, final)

    def _base(self) -> int:
        """Last batch id covered by the newest base, -1 without one."""
        return max((int(n.split("=")[1]) for n in workspace.child_dirs(self.spark, f"{self.path}/base")), default=-1)

    def _changes(self, last: int | None = None) -> DataFrame:
        """Stored rows: the base plus the batches after it, up to `last`."""
        through = self._base()
        rows = self.spark.createDataFrame([], self.stored)
        if workspace.exists(self.spark, f"{self.path}/changes"):
            in_folders = T.StructType(self.stored.fields + [T.StructField("batch", T.LongType())])
            later = (self.spark.read.schema(in_folders).parquet(f"{self.path}/changes")
                     .where(F.col("batch") > through))
            rows = (later if last is None else later.where(F.col("batch") <= last)).drop("batch")
        if through >= 0:
            rows = rows.unionByName(self.spark.read.schema(self.stored).parquet(f"{self.path}/base/through={through}"))
        return rows

    def read(self) -> DataFrame:
        """The table as of the batches stored so far."""
        changes = self._changes()
        if self.scd_type == 1:
            return cdc.drop_deleted(self._merged(changes), self.except_columns)
        return cdc.apply_changes(changes, self.keys, self.sequence_by, "_deleted",
                                 [*self.except_columns, "_deleted"], 2)

    def compact(self) -> None:
        """Fold all stored batches into a new base. Readers switch once it is complete."""
        ids = [int(n.split("=")[1]) for n in workspace.child_dirs(self.spark, f"{self.path}/changes")]
        if not ids or max(ids) <= self._base():
            return
        last = max(ids)
        self._complete(self._merged(self._changes(last)), f"base/through={last}")

    def run(self, changes: DataFrame, checkpoint: str, every: str | None = None):
        """Start folding a stream of changes into this table."""
        return runner.folded(changes, self.fold, checkpoint, every)


_UPDATED = "_updated_in"


def aggregate_table(stream: DataFrame, keys: list[str], path: str, **options) -> ChangeTable:
    """The change table behind `upsert`: the sequence of a group is the batch that changed it."""
    schema = T.StructType([*stream.schema.fields, T.StructField(_UPDATED, T.LongType())])
    return ChangeTable(stream.sparkSession, path, schema, keys, _UPDATED, except_columns=[_UPDATED], **options)


def upsert(stream: DataFrame, keys: list[str], path: str, checkpoint: str, every: str | None = None, **options):
    """Keep a keyed streaming aggregate up to date: every batch stores only the groups it changed.

    Update mode also lets a watermark evict closed groups from the state.
    """
    target = aggregate_table(stream, keys, path, **options)

    def store(changed: DataFrame, batch: int) -> None:
        target.fold(changed.withColumn(_UPDATED, F.lit(batch).cast("bigint")), batch)

    return (stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
            .foreachBatch(store).trigger(**runner._trigger(every)).start())


def upserted(stream: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Run a keyed aggregate over available data and read its final state."""
    base = workspace.new_dir(stream.sparkSession, label)
    runner.finish(upsert(stream, keys, f"{base}/table", f"{base}/checkpoint"))
    return aggregate_table(stream, keys, f"{base}/table").read()
