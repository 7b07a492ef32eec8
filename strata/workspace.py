"""Shared-storage folders for checkpoints and written tables.

Everything goes through the Hadoop FileSystem API, so the same code works on a
local disk in tests and on an object store or HDFS on a cluster.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def _hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _hadoop_path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Without that setting it is a folder of the session's warehouse, which all executors reach, too.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return (configured or f"{spark.conf.get('spark.sql.warehouse.dir')}/_work").rstrip("/")


def new_dir(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing folder path under the shared root."""
    return f"{root(spark)}/strata/{label}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    return _file_system(spark, path).exists(_hadoop_path(spark, path))


def is_directory(spark: SparkSession, path: str) -> bool:
    fs = _file_system(spark, path)
    target = _hadoop_path(spark, path)
    return fs.exists(target) and fs.getFileStatus(target).isDirectory()


def child_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of `path`, sorted; empty when `path` is missing."""
    if not is_directory(spark, path):
        return []
    listing = _file_system(spark, path).listStatus(_hadoop_path(spark, path))
    return sorted(s.getPath().getName() for s in listing if s.isDirectory())


def some_files(spark: SparkSession, path: str, n: int) -> list[str]:
    """Up to `n` data files below `path`, without listing the rest."""
    listing = _file_system(spark, path).listFiles(_hadoop_path(spark, path), True)
    found: list[str] = []
    while len(found) < n and listing.hasNext():
        file = listing.next()
        if file.getLen() > 0 and file.getPath().getName()[0] not in "._":
            found.append(file.getPath().toString())
    return found


def committed(spark: SparkSession, path: str) -> bool:
    """Whether a Spark write into `path` finished."""
    return exists(spark, f"{path}/_SUCCESS")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Store `df` in the shared folder and read it back: its lineage ends here and survives lost executors."""
    path = new_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def make_dir(spark: SparkSession, path: str) -> None:
    """Create a folder and those above it, where they are missing."""
    _file_system(spark, path).mkdirs(_hadoop_path(spark, path))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library has written."""
    _file_system(spark, path).delete(_hadoop_path(spark, path), True)


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Give a folder its final name, which must be free."""
    if exists(spark, to) or not _file_system(spark, path).rename(_hadoop_path(spark, path), _hadoop_path(spark, to)):
        raise FileExistsError(to)


def write_text(spark: SparkSession, path: str, text: str, replace: bool = False) -> None:
    """Create a small text file. Unless `replace`, it fails if the file exists, so of two writers one gets an error."""
    out = _file_system(spark, path).create(_hadoop_path(spark, path), replace)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """The content of a small text file."""
    stream = _file_system(spark, path).open(_hadoop_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def child_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly in `path`, sorted; empty when `path` is missing."""
    if not is_directory(spark, path):
        return []
    listing = _file_system(spark, path).listStatus(_hadoop_path(spark, path))
    return sorted(s.getPath().getName() for s in listing if s.isFile() and s.getPath().getName()[0] not in "._")
