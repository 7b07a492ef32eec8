"""Windowed and deduplicating stream shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tumbling(stream: DataFrame, ts: str, width: str, aggregates: list[Column], keys: list[str] = (),
             delay: str | None = None) -> DataFrame:
    """Aggregates per fixed window; `delay` sets a watermark, which append mode needs.

    Pre-aggregated on the map side, so one busy window or key is merged from partial
    results. The window column is a struct of start and end.
    """
    timed = stream.withWatermark(ts, delay) if delay else stream
    return timed.groupBy(*keys, F.window(ts, width).alias("window")).agg(*aggregates)


def flat(windowed: DataFrame) -> DataFrame:
    """Window start and end as epoch seconds next to the other columns."""
    others = [c for c in windowed.columns if c != "window"]
    return windowed.select(F.unix_seconds("window.start").alias("window_start"),
                           F.unix_seconds("window.end").alias("window_end"), *others)


def newest_windows(windowed: DataFrame, n: int) -> DataFrame:
    """The newest `n` windows, of a table or of a complete-mode stream."""
    return windowed.orderBy(F.desc("window")).limit(n)


def dedup(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    """Drop repeated rows (all columns equal) that arrive within `delay` of each other's event time."""
    return stream.withWatermark(ts, delay).dropDuplicates()
