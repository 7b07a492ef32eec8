"""Sensor streams: windows, resampling and time-weighted averages over the event table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import workspace
from strata.operators import timeseries
from strata.plans.registry import query
from strata.streaming import changes, integral, runner, timers, windows
from strata.tables import table, table_stream

_SUM = "CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE)"


def _average(rows: DataFrame) -> DataFrame:
    return rows.withColumn("average", F.col("total").cast("double") / F.col("n")).drop("total")


def _totals() -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).alias("total")]


@query(f"""SELECT epoch_us(w) // 1000000 AS window_start, epoch_us(w) // 1000000 + 3600 AS window_end, COUNT(*) AS n,
             {_SUM} / COUNT(*) AS average FROM (SELECT *, time_bucket(INTERVAL 1 HOUR, ts) AS w FROM events) GROUP BY w
           HAVING w + INTERVAL 1 HOUR <= (SELECT MAX(ts) - INTERVAL 3 SECOND FROM events)""")
def tumbling_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append mode: each window once, after the watermark has passed its end."""
    rows = windows.tumbling(table_stream(spark, sf_dir, "events"), "ts", "1 hour", _totals(), delay="3 seconds")
    return _average(runner.appended(windows.flat(rows), "windows"))


@query(f"""SELECT event_type, epoch_us(w) // 1000000 AS window_start, epoch_us(w) // 1000000 + 60 AS window_end, COUNT(*) AS n,
             {_SUM} / COUNT(*) AS average
           FROM (SELECT *, time_bucket(INTERVAL 1 MINUTE, ts) AS w FROM events) GROUP BY event_type, w""")
def tumbling_avg_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = windows.tumbling(table_stream(spark, sf_dir, "events"), "ts", "1 minute", _totals(), ["event_type"], delay="1 day")
    return _average(windows.flat(changes.upserted(rows, ["event_type", "window"], "windows-by-key")))


@query(f"""SELECT epoch_us(w) // 1000000 AS window_start, epoch_us(w) // 1000000 + 1 AS window_end, COUNT(*) AS n,
             {_SUM} / COUNT(*) AS average FROM (SELECT *, time_bucket(INTERVAL 1 SECOND, ts) AS w FROM events) GROUP BY w
           ORDER BY w DESC LIMIT 30""")
def latest_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest windows of a keyed result, so that closed windows can leave the state."""
    rows = windows.tumbling(table_stream(spark, sf_dir, "events"), "ts", "1 second", _totals(), delay="3 seconds")
    kept = changes.upserted(rows, ["window"], "by-second")
    return _average(windows.flat(windows.newest_windows(kept, 30)))


@query("SELECT event_id, user_id, event_type, value, epoch_us(ts) AS ts_us FROM events")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed that delivers purchases twice, brought back to single rows."""
    columns = ["event_id", "user_id", "event_type", "value", "ts"]
    feed = table_stream(spark, sf_dir, "events").select(*columns)
    repeated = table_stream(spark, sf_dir, "events").select(*columns).where("event_type = 'purchase'")
    rows = runner.appended(windows.dedup(feed.union(repeated), "ts", "1 day"), "dedup")
    return rows.withColumn("ts_us", F.unix_micros("ts")).drop("ts")


_INTEGRAL_SQL = """rows AS (SELECT user_id, event_type, ts, CAST(value AS DECIMAL(18,2)) AS v,
     time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2024-01-01') AS s FROM events),
   near AS (SELECT *, lead(ts) OVER w AS nxt, lag(ts) OVER w AS prv FROM rows
            WINDOW w AS (PARTITION BY user_id, event_type, s ORDER BY ts)),
   held AS (SELECT *, (epoch_us(COALESCE(nxt, s + INTERVAL 6 HOUR)) - epoch_us(ts)) // 60000000
                      + CASE WHEN prv IS NULL THEN (epoch_us(ts) - epoch_us(s)) // 60000000 ELSE 0 END AS m FROM near),
   averages AS (SELECT user_id, event_type, s + INTERVAL 6 HOUR AS e, epoch_us(s) // 1000000 + 21600 AS interval_end,
            CAST(CAST(SUM(v * m) AS DOUBLE) / 360 AS FLOAT) AS value, CAST(COUNT(*) AS INTEGER) AS count_rows
            FROM held GROUP BY user_id, event_type, s)"""


@query(f"WITH {_INTEGRAL_SQL} SELECT * EXCLUDE (e) FROM averages")
def time_weighted_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = table(spark, sf_dir, "events").withColumn("value", F.col("value").cast("decimal(18,2)"))
    averages = timeseries.time_weighted_average(readings, ["user_id", "event_type"], "ts", "value", 360)
    return averages.withColumn("interval_end", F.unix_seconds("timestamp")).drop("timestamp")


_STREAM_INTEGRAL_SQL = f"""WITH {_INTEGRAL_SQL}
  SELECT CAST(user_id AS VARCHAR) AS location_id, event_type AS sensor, interval_end, value, count_rows FROM averages"""


def _streamed(spark: SparkSession, sf_dir: str, average, label: str) -> DataFrame:
    readings = table_stream(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("location_id"), F.col("event_type").alias("sensor"),
        F.col("ts").alias("timestamp"), "value")
    rows = runner.appended(average(readings, 360), label)
    return rows.select("location_id", "sensor", F.unix_seconds("timestamp").alias("interval_end"), "value", "count_rows")


@query(_STREAM_INTEGRAL_SQL + " WHERE e <= (SELECT MAX(ts) - INTERVAL 10 MINUTE FROM events)")
def stream_time_weighted_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir, integral.time_weighted_average, "integral")


@query(_STREAM_INTEGRAL_SQL + " WHERE e < (SELECT MAX(e) - INTERVAL 10 MINUTE FROM averages)")
def stream_strict_time_weighted_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir, integral.strict_time_weighted_average, "strict-integral")


_LATE = "event_id % 10 = 0 AND ts < TIMESTAMP '2024-01-10'"
_IN_TIME_SQL = _INTEGRAL_SQL.replace("FROM events)", f"FROM events WHERE NOT ({_LATE}))", 1)


@query(f"""WITH {_IN_TIME_SQL} SELECT CAST(user_id AS VARCHAR) AS location_id, event_type AS sensor, interval_end, value, count_rows
           FROM averages WHERE e <= (SELECT MAX(ts) - INTERVAL 10 MINUTE FROM events)""")
def stream_timer_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timers close the intervals, also of keys that have gone silent; the tenth of the rows that arrives ten days late is refused."""
    base = workspace.new_dir(spark, "timers")
    events = table(spark, sf_dir, "events").withColumn("late", F.expr(_LATE))
    lots = ["NOT late AND ts < TIMESTAMP '2024-01-20'", "late", "NOT late AND ts >= TIMESTAMP '2024-01-20'"]
    schema = "location_id STRING, sensor STRING, timestamp TIMESTAMP, value DOUBLE"
    for lot in lots:
        rows = events.where(lot).select(F.col("user_id").cast("string").alias("location_id"), F.col("event_type").alias("sensor"),
                                        F.col("ts").alias("timestamp"), "value")
        rows.write.mode("append").parquet(f"{base}/in")
        averages = timers.timed_average(spark.readStream.schema(schema).parquet(f"{base}/in"), 360, piece_seconds=3600)
        runner.finish(runner.append(averages, f"{base}/out", f"{base}/checkpoint", conf=timers.SETTINGS))
    out = spark.read.schema(integral.OUTPUT).parquet(f"{base}/out")
    return out.select("location_id", "sensor", F.unix_seconds("timestamp").alias("interval_end"), "value", "count_rows")


_BINS_SQL = """bins AS (SELECT user_id, epoch_us(ts) // 21600000000 * 21600 AS bin, MAX(value) AS m FROM events GROUP BY 1, 2),
  spans AS (SELECT user_id, MIN(bin) AS lo, MAX(bin) AS hi FROM bins GROUP BY 1),
  grid AS (SELECT user_id, unnest(generate_series(lo, hi, 21600)) AS bin FROM spans),
  filled AS (SELECT user_id, bin, COALESCE(m, 0) AS value FROM grid LEFT JOIN bins USING (user_id, bin))"""


def _resampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeseries.resample_max(table(spark, sf_dir, "events"), "user_id", "ts", "value", 21_600)


@query(f"WITH {_BINS_SQL} SELECT * FROM filled")
def resample_gapfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _resampled(spark, sf_dir)


@query(f"""WITH {_BINS_SQL}, newest AS (SELECT bin, row_number() OVER (ORDER BY bin) AS i FROM
             (SELECT DISTINCT bin FROM filled ORDER BY bin DESC LIMIT 10))
           SELECT user_id, {', '.join(f'MAX(value) FILTER (i = {i}) AS t{i}' for i in range(1, 11))}
           FROM filled LEFT JOIN newest USING (bin) GROUP BY user_id""")
def resample_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeseries.pivot_latest(_resampled(spark, sf_dir), "user_id", 10)
