"""Time-weighted averages over a stream, emitted once per closed interval."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OUTPUT = "location_id STRING, sensor STRING, timestamp TIMESTAMP, value FLOAT, count_rows INT"
KEYS = ["location_id", "sensor"]


def _whole_minutes(since: Column, until: Column) -> Column:
    return F.floor((F.unix_micros(until) - F.unix_micros(since)) / F.lit(60_000_000))


def _piece(seconds: int) -> Column:
    return F.floor(F.unix_seconds("timestamp") / seconds).alias("piece")


def _points() -> Column:
    return F.sort_array(F.collect_list(F.struct(F.col("timestamp").alias("t"), F.col("value").cast("double").alias("v")))).alias("p")


def _summary() -> Column:
    """End points, area in between and number of rows of one piece's sorted points `p`."""
    held = F.transform("p", lambda x, i: x["v"] * _whole_minutes(x["t"], F.coalesce(F.get("p", i + 1)["t"], x["t"])))
    return F.struct(F.get("p", F.lit(0)).alias("first"), F.element_at("p", -1).alias("last"),
                    F.aggregate(held, F.lit(0.0), lambda a, x: a + x).alias("area"), F.size("p").alias("n")).alias("s")


def _average(joined: DataFrame, start: Column, end: Column, minutes: int) -> DataFrame:
    """One row per interval from the sorted summaries `s` of its pieces. The first value also holds before its time."""
    between = F.transform("s", lambda x, i: x["area"] + x["last"]["v"] * _whole_minutes(
        x["last"]["t"], F.coalesce(F.get("s", i + 1)["first"]["t"], end)))
    opening = F.get("s", F.lit(0))["first"]
    area = F.aggregate(between, F.lit(0.0), lambda a, x: a + x) + opening["v"] * _whole_minutes(start, opening["t"])
    rows = F.aggregate("s", F.lit(0), lambda a, x: a + x["n"])
    return joined.select(*KEYS, end.alias("timestamp"), (area / minutes).cast("float").alias("value"), rows.alias("count_rows"))


def time_weighted_average(readings: DataFrame, interval_minutes: int = 10, delay: str = "10 minutes",
                          piece_seconds: int = 60) -> DataFrame:
    """Rows (location_id, sensor, timestamp, value) to one average per closed interval.

    State is kept per piece of an interval, so a busy sensor is buffered by many tasks; when the interval closes, every
    piece shrinks to its end points and area, and a second aggregation joins those. Rows are accepted until the interval is
    emitted, also those the strict form would already refuse.
    """
    width = f"{interval_minutes} minutes"
    buffered = (readings.withWatermark("timestamp", delay)
                .groupBy(*KEYS, _piece(piece_seconds), F.window("timestamp", width).alias("w")).agg(_points()))
    closed = buffered.select(*KEYS, "w", F.window_time("w").alias("at"), _summary())
    joined = closed.groupBy(*KEYS, F.window("at", width).alias("w")).agg(F.sort_array(F.collect_list("s")).alias("s"))
    return _average(joined, F.col("w.start"), F.col("w.end"), interval_minutes)


def strict_time_weighted_average(readings: DataFrame, interval_minutes: int = 10, delay: str = "10 minutes") -> DataFrame:
    """The same, refusing a row once its interval's end is at or before the watermark.

    The watermark follows the interval ends instead of the readings, so the built-in aggregate drops late rows and
    closes an interval by this rule itself.
    """
    interval = F.window("timestamp", f"{interval_minutes} minutes")
    ends = readings.withColumn("_start", interval["start"]).withColumn("_end", interval["end"]).withWatermark("_end", delay)
    closed = ends.groupBy(*KEYS, "_start", "_end").agg(_points())
    return _average(closed.select(*KEYS, "_start", "_end", F.array(_summary()).alias("s")),
                    F.col("_start"), F.col("_end"), interval_minutes)
