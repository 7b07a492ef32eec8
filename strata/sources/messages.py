"""Message-broker rows: (key, value, timestamp) with a binary JSON value."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def broker_stream(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """A topic from its beginning. Needs the Kafka connector on the classpath."""
    defaults = {"startingOffsets": "earliest", "failOnDataLoss": "false"}
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers).option("subscribe", topic)
            .options(**{**defaults, **options}).load())


def broker_sink(messages: DataFrame, servers: str, topic: str, checkpoint: str, **options):
    """Start writing encoded messages to a topic. Needs the Kafka connector on the classpath."""
    return (messages.writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers).option("topic", topic)
            .option("checkpointLocation", checkpoint).options(**options).start())


def decode(messages: DataFrame, schema, value: str = "value", keep: list[str] = ("timestamp",)) -> DataFrame:
    """Fields of the JSON payload next to the kept broker columns; batch or stream."""
    parsed = F.from_json(F.col(value).cast("string"), schema)
    return messages.select(*keep, parsed.alias("_event")).select(*keep, "_event.*")


def encode(df: DataFrame, key: str, columns: list[str], timestamp: str | None = None) -> DataFrame:
    """The opposite of `decode`: a string key and the columns as one JSON value."""
    extra = [F.col(timestamp).alias("timestamp")] if timestamp else []
    return df.select(F.col(key).cast("string").alias("key"),
                     F.to_json(F.struct(*columns)).cast("binary").alias("value"), *extra)


def unwrap_envelope(messages: DataFrame, envelope: str = "payload") -> DataFrame:
    """After-image columns and operation of a change envelope; deletes keep their before-image."""
    image = F.coalesce(F.col(f"{envelope}.after"), F.col(f"{envelope}.before"))
    return messages.select(image.alias("_image"), F.col(f"{envelope}.op").alias("op")).select("_image.*", "op")
