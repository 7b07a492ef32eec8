"""Event-time operators on bounded data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators import neighbors


def interval_end(ts: str, interval: str) -> Column:
    return F.window(ts, interval)["end"]


def time_weighted_average(df: DataFrame, keys: list[str], ts: str, value: str, interval_minutes: int = 10,
                          exact: bool = False, heavy_rows: int = neighbors.HEAVY_ROWS) -> DataFrame:
    """Average of a step signal over fixed intervals, one row per key and interval.

    Each value holds until the next reading of its interval; the first value also holds
    back to the interval's start and the last one on to its end. Holding times count in
    whole minutes unless `exact`. Every holding time is one row's own, so areas add up in
    a map-side sum and no interval is collected into a list. Decimal values stay exact.
    """
    group = [*keys, "_end"]
    rows = df.select(*keys, F.col(ts).alias("_ts"), F.col(value).alias("_v"),
                     interval_end(ts, f"{interval_minutes} minutes").alias("_end"))
    slices = neighbors.plan_slices(rows, group, "_ts", heavy_rows)
    order = ["_ts", "_v"]
    rows = neighbors.next_values(rows, slices, order, {"_next": "_ts"})
    rows = neighbors.previous_values(rows, slices, order, {"_prev": "_ts"})

    def minutes(since: Column, until: Column) -> Column:
        micros = F.unix_micros(until) - F.unix_micros(since)
        if exact:
            return (micros / F.lit(60e6)).cast("decimal(18,9)")
        return F.floor(micros / F.lit(60_000_000)).cast("bigint")

    start = F.col("_end") - F.make_dt_interval(mins=F.lit(interval_minutes))
    held = minutes(F.col("_ts"), F.coalesce(F.col("_next"), F.col("_end")))
    before = F.when(F.col("_prev").isNull(), minutes(start, F.col("_ts"))).otherwise(F.lit(0))
    area = F.sum(F.col("_v") * (held + before))
    return (rows.groupBy(*group)
            .agg((area.cast("double") / interval_minutes).cast("float").alias("value"),
                 F.count(F.lit(1)).cast("int").alias("count_rows"))
            .withColumnRenamed("_end", "timestamp"))


def resample_max(df: DataFrame, key: str, ts: str, value: str, step_seconds: int) -> DataFrame:
    """Maximum per key and time bin, with empty bins between a key's first and last set to 0.

    The grid has the bins' origin for any step. It is laid out in stretches of about a day, so a key with a
    long life spreads over many rows and tasks instead of one long array.
    """
    step = F.lit(step_seconds)
    binned = df.select(key, (F.floor(F.unix_seconds(ts) / step) * step).alias("bin"), F.col(value).alias("_v"))
    bins = binned.groupBy(key, "bin").agg(F.max("_v").alias("_max"))
    in_stretch = max(1, 86_400 // step_seconds)
    day = F.lit(in_stretch * step_seconds)
    spans = bins.groupBy(key).agg(F.min("bin").alias("_low"), F.max("bin").alias("_high"))
    days = spans.select(key, "_low", "_high", F.explode(F.sequence(
        F.floor(F.col("_low") / day), F.floor(F.col("_high") / day))).alias("_day"))
    in_day = F.sequence(F.lit(0).cast("bigint"), F.lit(in_stretch - 1).cast("bigint"))
    grid = (days.repartition(key, "_day")
            .select(key, "_low", "_high", "_day", F.explode(in_day).alias("_i"))
            .select(key, "_low", "_high", (F.col("_day") * day + F.col("_i") * step).alias("bin"))
            .where("bin BETWEEN _low AND _high").select(key, "bin"))
    return (grid.join(bins, [key, "bin"], "left")
            .select(key, "bin", F.coalesce("_max", F.lit(0).cast(bins.schema["_max"].dataType)).alias("value")))


def latest_bins(resampled: DataFrame, k: int) -> list[int]:
    """The newest `k` bins present, oldest first: at most k numbers on the driver."""
    newest = resampled.select("bin").distinct().orderBy(F.desc("bin")).limit(k).collect()
    return sorted(row["bin"] for row in newest)


def pivot_latest(resampled: DataFrame, key: str, k: int) -> DataFrame:
    """Key x time matrix of the newest `k` bins as columns ``t1`` (oldest) .. ``tk``."""
    bins = latest_bins(resampled, k)
    cells = [F.max(F.when(F.col("bin") == b, F.col("value"))).alias(f"t{i + 1}") for i, b in enumerate(bins)]
    return resampled.groupBy(key).agg(*cells)


def time_range(df: DataFrame, ts: str, key: str) -> DataFrame:
    """First and last time and the number of distinct keys."""
    per_key = df.groupBy(key).agg(F.min(ts).alias("a"), F.max(ts).alias("b"))
    return per_key.agg(F.min("a").alias("first_time"), F.max("b").alias("last_time"),
                       F.count(key).alias("n_keys"))


def last_span(df: DataFrame, at: str, seconds: int, matching: Column | None = None) -> DataFrame:
    """Rows no older than `seconds` before the newest row that is `matching`.

    `at` is an epoch-seconds column. The newest value is a scalar subquery, which reaches
    the scan as a pushed filter.
    """
    reference = df if matching is None else df.where(matching)
    newest = reference.select(at).agg(F.max(at).alias("newest"))
    return df.where(F.col(at) >= newest.select(F.col("newest") - F.lit(seconds)).scalar())


def latest_per_key(df: DataFrame, keys: list[str], sequence: str, matching: Column | None = None) -> DataFrame:
    """All rows whose (sequence, keys) is the greatest among `matching` rows of the key."""
    reference = df if matching is None else df.where(matching)
    newest = reference.groupBy(*keys).agg(F.max(sequence).alias(sequence))
    return df.join(newest, [*keys, sequence], "left_semi")
