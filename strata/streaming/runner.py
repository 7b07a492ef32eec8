"""Running streams to a table: once over what is there, or continuously."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from types import MappingProxyType

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata import session, workspace
from strata.sources.files import union_evolved


def _trigger(every: str | None) -> dict:
    return {"processingTime": every} if every else {"availableNow": True}


def append(stream: DataFrame, target: str, checkpoint: str, partition_by: list[str] = (), fmt: str = "parquet",
           every: str | None = None, conf: Mapping[str, str] = MappingProxyType({})) -> StreamingQuery:
    """Append a stream to a table folder, exactly once per checkpoint.

    Without `every`, processes what is available and stops. A full refresh is a run with
    a new target and a new checkpoint. `conf` has session settings that the stream needs; it keeps those of its start.
    """
    writer = (stream.writeStream.format(fmt).outputMode("append")
              .option("checkpointLocation", checkpoint).trigger(**_trigger(every)))
    with session.settings(stream.sparkSession, conf):
        return (writer.partitionBy(*partition_by) if partition_by else writer).start(target)


def append_flows(flows: dict[str, DataFrame], target: str, checkpoints: str, every: str | None = None) -> list[StreamingQuery]:
    """Start several streams into one table: a folder and a checkpoint per flow."""
    return [append(flow, f"{target}/{name}", f"{checkpoints}/{name}", every=every) for name, flow in flows.items()]


def read_flows(spark: SparkSession, target: str, schema, names: list[str], tag: str = "_flow") -> DataFrame:
    """The union of what the flows have appended, tagged with the flow's name."""
    return union_evolved([spark.read.schema(schema).parquet(f"{target}/{n}").withColumn(tag, F.lit(n)) for n in names])


def replace(stream: DataFrame, target: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Publish a complete-mode aggregate: every batch writes its own version of the result.

    For results that stay small. State is never evicted in this mode; a keyed result that
    grows belongs into `changes.upsert`.
    """

    def publish(result: DataFrame, batch: int) -> None:
        result.write.mode("overwrite").parquet(f"{target}/version={batch:012d}")

    return (stream.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
            .foreachBatch(publish).trigger(**_trigger(every)).start())


def latest_version(spark: SparkSession, target: str) -> DataFrame:
    """The newest finished version written by `replace`."""
    done = [v for v in workspace.child_dirs(spark, target) if workspace.committed(spark, f"{target}/{v}")]
    return spark.read.parquet(f"{target}/{done[-1]}")


def finish(query: StreamingQuery) -> None:
    """Wait for a run over available data; an error in the stream is raised here."""
    query.awaitTermination()


def appended(stream: DataFrame, label: str, **options) -> DataFrame:
    """Run an append stream over available data and read back what it wrote."""
    spark = stream.sparkSession
    base = workspace.new_dir(spark, label)
    finish(append(stream, f"{base}/table", f"{base}/checkpoint", **options))
    return spark.read.schema(stream.schema).parquet(f"{base}/table")


def completed(stream: DataFrame, label: str) -> DataFrame:
    """Run a complete-mode stream over available data and read its final result."""
    spark = stream.sparkSession
    base = workspace.new_dir(spark, label)
    finish(replace(stream, f"{base}/table", f"{base}/checkpoint"))
    return latest_version(spark, f"{base}/table")


def folded(stream: DataFrame, fold: Callable[[DataFrame, int], None], checkpoint: str,
           every: str | None = None) -> StreamingQuery:
    """Hand every micro-batch and its id to `fold`, which must tolerate a repeated id."""
    return (stream.writeStream.option("checkpointLocation", checkpoint)
            .foreachBatch(fold).trigger(**_trigger(every)).start())
