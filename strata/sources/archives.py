"""Unpacking of archives and nested lists: one input row to many output rows."""

from __future__ import annotations

import io
import tarfile
import zlib
from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager
from typing import BinaryIO

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.storage import store_of

MEMBERS = "path STRING, modificationTime TIMESTAMP, length BIGINT, member_id STRING, body STRING, error STRING"
# Output is handed to Spark whenever this much text has been unpacked, so a task holds
# one archive and one such portion, whatever the number of members.
PORTION_BYTES = 16 << 20


def archive_files(spark: SparkSession, path: str, streaming: bool = False, with_content: bool = True) -> DataFrame:
    """Files under `path` with path, modificationTime and length; contents only when asked for.

    Leaving out `content` means the files are listed but not opened.
    """
    if streaming:
        schema = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"
        files = spark.readStream.format("binaryFile").schema(schema).load(path)
    else:
        files = spark.read.format("binaryFile").load(path)
    return files if with_content else files.select("path", "modificationTime", "length")


def split_path(df: DataFrame, path: str = "path") -> DataFrame:
    """Bucket (host part) and key (everything after it) of a URL-like path."""
    parts = F.split(path, "/", 4)
    return df.withColumn("bucket_name", F.get(parts, F.lit(2))).withColumn("source_key", F.get(parts, F.lit(3)))


def _members(source: BinaryIO) -> Iterator[bytes]:
    with tarfile.open(fileobj=source, mode="r|gz") as archive:
        for entry in archive:
            if entry.isfile():
                yield archive.extractfile(entry).read().rstrip()


def _unpacked(batches: Iterator[pd.DataFrame], opened: Callable[[tuple], AbstractContextManager[BinaryIO]]) -> Iterator[pd.DataFrame]:
    columns = ["path", "modificationTime", "length", "member_id", "body", "error"]
    for batch in batches:
        for file in batch.itertuples(index=False):
            stem = file.path.replace("/", "_").replace(".", "_")
            rows, held = [], 0
            try:
                with opened(file) as source:
                    for i, body in enumerate(_members(source)):
                        try:
                            text, problem = body.decode(), None
                        except UnicodeDecodeError as failure:
                            text, problem = None, repr(failure)
                        rows.append((file.path, file.modificationTime, file.length, f"{stem}{i}", text, problem))
                        held += len(body)
                        if held >= PORTION_BYTES:
                            yield pd.DataFrame(rows, columns=columns)
                            rows, held = [], 0
            except (tarfile.TarError, OSError, EOFError, zlib.error) as failure:
                rows.append((file.path, file.modificationTime, file.length, None, None, repr(failure)))
            if rows:
                yield pd.DataFrame(rows, columns=columns)


def unpack_archives(files: DataFrame) -> DataFrame:
    """One row per member of every tar.gz in column content; an unreadable archive gives one row with ``error``
    set, a member that is no UTF-8 text a row with ``error`` and without body.

    Archives are independent rows, so Spark spreads them over the cluster. How many a task
    holds at once is bounded by ``spark.sql.execution.arrow.maxBytesPerBatch``. Contents are limited to 2 GB; see `unpack_stored`.
    """
    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _unpacked(batches, lambda file: io.BytesIO(file.content))

    return files.select("path", "modificationTime", "length", "content").mapInPandas(unpack, MEMBERS)


def unpack_stored(files: DataFrame) -> DataFrame:
    """The same for a listing without contents: each archive is read from storage as a stream by the task that unpacks it.

    Archives may have any size; a task holds one member and a portion of text. Works on batch and streaming listings.
    """
    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def opened(file: tuple) -> AbstractContextManager[BinaryIO]:
            store, path = store_of(file.path)
            return store.open_input_stream(path, compression=None)

        return _unpacked(batches, opened)

    return files.select("path", "modificationTime", "length").mapInPandas(unpack, MEMBERS)


def unpack_list(df: DataFrame, key: str, items: str) -> DataFrame:
    """One row (key, row_id, item) per list element, item as JSON."""
    return (df.select(key, F.posexplode(items).alias("row_id", "_item"))
            .select(key, F.col("row_id").cast("bigint").alias("row_id"), F.to_json("_item").alias("item")))


def unpack_list_in_pandas(df: DataFrame, key: str, items: str) -> DataFrame:
    """The same through `mapInPandas`, the template for formats Spark cannot explode itself."""
    import json

    key_type = df.schema[key].dataType.simpleString()

    def explode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(k, i, json.dumps(item, ensure_ascii=False, separators=(",", ":")))
                    for k, found in zip(batch[key], batch[items]) for i, item in enumerate(found)]
            yield pd.DataFrame(rows, columns=[key, "row_id", "item"])

    return df.select(key, items).mapInPandas(explode, f"{key} {key_type}, row_id BIGINT, item STRING")
