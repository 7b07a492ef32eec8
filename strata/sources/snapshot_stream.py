"""Hourly snapshot folders as a streaming source whose offset is the hour of a snapshot.

``<root>/yyyy-MM-dd HH`` holds one complete snapshot as Parquet. The source goes from hour to hour and waits at a missing one, so a late
snapshot keeps its place; a folder counts once it has a ``_SUCCESS`` file. A query that is restarted goes on after the last hour of its
checkpoint. Register it once per session (`register`), then::

    spark.readStream.format("snapshot_folders").schema("id INT, version STRING").load(root)
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from strata.sources.snapshots import HOUR_FORMAT
from strata.sources.storage import store_of

VERSION = "version"


def _hours(root: str) -> list[datetime]:
    """Hours for which there is a folder, in order; one listing."""
    store, path = store_of(root)
    found = []
    for info in store.get_file_info(fs.FileSelector(path, allow_not_found=True)):
        try:
            found.append(datetime.strptime(info.base_name, HOUR_FORMAT))
        except ValueError:
            continue
    return sorted(found)


def reachable(hours: list[datetime], last: datetime | None, complete: Callable[[datetime], bool], skip_gaps: bool) -> datetime | None:
    """The last hour that can be reached from `last` (the first one there if None) over complete snapshots."""
    for hour in hours:
        if last is not None and hour <= last:
            continue
        if (last is not None and hour != last + timedelta(hours=1) and not skip_gaps) or not complete(hour):
            break
        last = hour
    return last


class Files(InputPartition):
    """One file of a snapshot."""

    def __init__(self, path: str, version: str):
        self.path, self.version = path, version


class SnapshotFolders(DataSource):
    """Options: ``path``; ``after``, the hour after which to begin; ``skipGaps``, true to leave missing hours out."""

    @classmethod
    def name(cls) -> str:
        return "snapshot_folders"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _Reader(schema, self.options)


class _Reader(DataSourceStreamReader):
    def __init__(self, schema: StructType, options: dict):
        self.schema, self.root = schema, options["path"].rstrip("/")
        self.skip_gaps = str(options.get("skipGaps", "false")).lower() == "true"
        self.first = options.get("after") or ""
        self.last = self._hour(self.first)

    @staticmethod
    def _hour(text: str | None) -> datetime | None:
        return datetime.strptime(text, HOUR_FORMAT) if text else None

    def _complete(self, hour: datetime) -> bool:
        store, path = store_of(f"{self.root}/{hour.strftime(HOUR_FORMAT)}/_SUCCESS")
        return store.get_file_info(path).type == fs.FileType.File

    def initialOffset(self) -> dict:
        return {"hour": self.first}

    def latestOffset(self) -> dict:
        self.last = reachable(_hours(self.root), self.last, self._complete, self.skip_gaps)
        return {"hour": "" if self.last is None else self.last.strftime(HOUR_FORMAT)}

    def partitions(self, start: dict, end: dict) -> list[Files]:
        since, until = self._hour(start["hour"]), self._hour(end["hour"])
        found = []
        for hour in _hours(self.root):
            if until is not None and hour <= until and (since is None or hour > since):
                version = hour.strftime(HOUR_FORMAT)
                store, path = store_of(f"{self.root}/{version}")
                found += [Files(info.path, version) for info in store.get_file_info(fs.FileSelector(path, recursive=True))
                          if info.type == fs.FileType.File and info.base_name[0] not in "._" and info.size]
        return found

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = store_of(self.root)
        target = to_arrow_schema(self.schema)
        names = [f.name for f in target if f.name != VERSION]
        with store.open_input_file(partition.path) as file:
            stored = pq.ParquetFile(file)
            have = set(stored.schema_arrow.names)
            for batch in stored.iter_batches(batch_size=8192, columns=[n for n in names if n in have]):
                columns = [pa.array([partition.version] * batch.num_rows, f.type) if f.name == VERSION
                           else batch.column(f.name).cast(f.type) if f.name in have else pa.nulls(batch.num_rows, f.type) for f in target]
                yield pa.RecordBatch.from_arrays(columns, schema=target)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(SnapshotFolders)


def stream(spark: SparkSession, root: str, schema: str, after: str | None = None, skip_gaps: bool = False) -> DataFrame:
    """Rows of all snapshots with their `version`; give `after` if folders that were read may have been removed."""
    register(spark)
    reader = spark.readStream.format("snapshot_folders").schema(f"{schema}, {VERSION} STRING").option("skipGaps", skip_gaps)
    return (reader.option("after", after) if after else reader).load(root)


def in_order(fold: Callable[[DataFrame, str], None]) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: hands the snapshots of a batch to `fold`, one by one, oldest first."""

    def step(batch: DataFrame, _: int) -> None:
        rows = batch.persist()
        try:
            for version in sorted(r[0] for r in rows.select(VERSION).distinct().collect()):
                fold(rows.where(F.col(VERSION) == version).drop(VERSION), version)
        finally:
            rows.unpersist()

    return step
