"""Station, status and weather feeds with their dashboard queries.

Stations are customers, station status and weather reports are events, nested the way the
feeds deliver them. Dashboards take a local date-time and a list of station names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import clean
from strata.operators import aggregates, quality, timeseries
from strata.operators.cdc import apply_changes
from strata.plans.ingest import K, SQL_K
from strata.plans.registry import query
from strata.tables import table

# Fixed value: the picker's entry for no choice.
ALL = "-- ALL STATIONS --"
ZONE = "America/Chicago"
AT = "2024-01-15 12:30:00"
_HOUR = "(epoch_us(TIMESTAMP '2024-01-15 18:00:00') // 1000000)"  # the hour of AT in UTC

_STATUS_SQL = f"""status AS (SELECT *, poll - reported AS secs_since_last_reported,
      poll // 3600 * 3600 AS last_updated_hr FROM
    (SELECT max(event_id) AS event_id, station_id, poll, arg_max({SQL_K} % 5, event_id) AS bikes,
            arg_max(CAST(floor(value) AS INTEGER) % 7, event_id) AS docks, arg_max({SQL_K} % 3, event_id) AS ebikes,
            arg_max(epoch_us(ts) // 1000000, event_id) AS reported
     FROM (SELECT *, user_id AS station_id, epoch_us(date_trunc('hour', ts)) // 1000000 + 1800 AS poll FROM events)
     GROUP BY station_id, poll))"""
_INFO_SQL = """info AS (SELECT c_custkey AS station_id, c_name AS name, CASE WHEN c_nationkey % 2 = 0 THEN 'classic' ELSE 'lightweight' END
   AS station_type, 10 + c_nationkey AS capacity, c_nationkey * 1.5::DOUBLE AS lat, c_nationkey * -0.5::DOUBLE AS lon FROM customer)"""
_WEATHER_SQL = f"""weather AS (SELECT event_id, user_id AS station_id, epoch_us(ts) // 1000000 AS dt,
   epoch_us(date_trunc('hour', ts)) // 1000000 AS dt_hr, 260 + value / 10 AS main_temp, {SQL_K} / 10.0::DOUBLE AS wind_speed,
   [event_type, CASE WHEN {SQL_K} < 50 THEN 'calm' ELSE 'breezy' END] AS weather_description FROM events)"""


def raw_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half-hourly polls; a station reports once per poll, with the last event of that hour."""
    last = F.max(F.struct("event_id", "k", "value", "ts")).alias("e")
    reports = (table(spark, sf_dir, "events").withColumn("k", F.expr(K))
               .groupBy("user_id", (clean.hour_epoch(F.col("ts")) + 1800).alias("last_updated")).agg(last))
    station = F.struct(F.col("user_id").alias("station_id"), (F.col("e.k") % 5).alias("num_bikes_available"),
                       (F.floor("e.value").cast("int") % 7).alias("num_docks_available"),
                       (F.col("e.k") % 3).alias("num_ebikes_available"), F.unix_seconds("e.ts").alias("last_reported"),
                       F.col("e.event_id").alias("report_id"))
    return reports.select("last_updated", F.struct(F.array(station).alias("stations")).alias("data"))


def clean_status(raw: DataFrame) -> DataFrame:
    """One row per station and poll, with times, hour bucket and staleness."""
    rows = raw.select(F.explode("data.stations").alias("s"), "last_updated").select("s.*", "last_updated")
    updated = F.timestamp_seconds("last_updated")
    timed = rows.withColumns({
        "last_reported_ts": F.timestamp_seconds("last_reported"), "last_updated_ts": updated,
        "last_updated_date": F.to_date(updated), "last_updated_hr": clean.hour_epoch(updated),
        "secs_since_last_reported": F.col("last_updated") - F.col("last_reported")})
    return quality.expect(timed, [quality.Rule("valid_station_id", "station_id IS NOT NULL", "drop"),
                                  quality.Rule("over_24hr_old_data", "secs_since_last_reported < 86400")])


def station_information(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current stations, upserted by station id from repeated information feeds."""
    station = F.struct(F.col("c_custkey").alias("station_id"), F.col("c_name").alias("name"),
                       F.when(F.col("c_nationkey") % 2 == 0, "classic").otherwise("lightweight").alias("station_type"),
                       (F.col("c_nationkey") + 10).alias("capacity"), (F.col("c_nationkey") * 1.5).alias("lat"),
                       (F.col("c_nationkey") * -0.5).alias("lon"))
    feed = (table(spark, sf_dir, "customer")
            .select(F.struct(F.array(station).alias("stations")).alias("data"), F.lit(1_704_067_200).alias("last_updated"))
            .select(F.explode("data.stations").alias("s"), "last_updated").select("s.*", "last_updated"))
    earlier = feed.withColumn("last_updated", F.col("last_updated") - 3600).withColumn("capacity", F.lit(0))
    return apply_changes(earlier.unionByName(feed), ["station_id"], "last_updated", except_columns=["last_updated"])


def raw_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    wind = F.when(F.col("k") < 50, "calm").otherwise("breezy")
    kind = F.array(F.struct(F.col("event_type").alias("main"), F.col("event_type").alias("description")),
                   F.struct(F.lit("Wind").alias("main"), wind.alias("description")))
    return table(spark, sf_dir, "events").withColumn("k", F.expr(K)).select(
        "event_id", F.concat(F.lit("weather_info_1_station_"), "user_id", F.lit(".json")).alias("json_file_name"),
        kind.alias("weather"), F.struct((F.col("value") / 10 + 260).alias("temp")).alias("main"),
        F.struct((F.col("k") / 10).alias("speed")).alias("wind"), F.unix_seconds("ts").alias("dt"))


def clean_weather(raw: DataFrame) -> DataFrame:
    taken = F.timestamp_seconds("dt")
    flat = raw.select("event_id", F.col("weather.main").alias("weather_main"),
                      F.col("weather.description").alias("weather_description"),
                      clean.key_in_file_name("json_file_name").try_cast("bigint").alias("station_id"),
                      F.col("main.temp").alias("main_temp"), F.col("wind.speed").alias("wind_speed"), "dt",
                      taken.alias("dt_ts"), F.to_date(taken).alias("dt_date"), clean.hour_epoch(taken).alias("dt_hr"))
    return quality.expect(flat, [quality.Rule("valid_station_id", "station_id IS NOT NULL", "drop")])


def _tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (clean_status(raw_status(spark, sf_dir)), station_information(spark, sf_dir),
            clean_weather(raw_weather(spark, sf_dir)))


def utc_hour(at: str, zone: str = ZONE) -> Column:
    """Epoch seconds of the UTC hour that holds the local date-time."""
    return clean.hour_epoch(F.to_utc_timestamp(F.lit(at).cast("timestamp"), zone))


def chosen(info: DataFrame, names: list[str]) -> DataFrame:
    return info if ALL in names else info.where(F.col("name").isin(names))


# --- cleaning -----------------------------------------------------------------------------

@query(f"WITH {_STATUS_SQL} SELECT event_id AS report_id, station_id, poll AS last_updated, secs_since_last_reported FROM status")
def staleness_secs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_status(raw_status(spark, sf_dir)).select("report_id", "station_id", "last_updated", "secs_since_last_reported")


@query(f"""WITH {_WEATHER_SQL} SELECT event_id, station_id, array_to_string(weather_description, ',') AS weather_description,
             main_temp, wind_speed, dt, dt_hr FROM weather""")
def flatten_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_weather(raw_weather(spark, sf_dir)).select(
        "event_id", "station_id", F.concat_ws(",", "weather_description").alias("weather_description"),
        "main_temp", "wind_speed", "dt", "dt_hr")


@query(f"WITH {_INFO_SQL} SELECT * FROM info")
def station_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return station_information(spark, sf_dir)


# --- dashboards ---------------------------------------------------------------------------

@query(f"WITH {_INFO_SQL} SELECT DISTINCT name FROM info UNION ALL SELECT '{ALL}' ORDER BY name")
def picker_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.with_sentinel(station_information(spark, sf_dir), "name", ALL).orderBy("name")


def weather_headline(weather: DataFrame, info: DataFrame, at: str, names: list[str]) -> DataFrame:
    newest = timeseries.latest_per_key(weather, ["station_id"], "dt", F.col("dt_hr") == utc_hour(at))
    return newest.join(chosen(info, names), "station_id").agg(
        clean.fahrenheit(F.avg("main_temp")).alias("avg_temp_f"), F.avg("wind_speed").alias("avg_wind_speed"))


@query(f"""WITH {_WEATHER_SQL}, {_INFO_SQL} SELECT round((avg(main_temp) - 273.15) * 9 / 5 + 32, 6) AS avg_temp_f,
             round(avg(wind_speed), 6) AS avg_wind_speed FROM weather w, info i
           WHERE (w.dt, w.station_id) IN (SELECT (max(dt), station_id) FROM weather WHERE dt_hr = {_HOUR} GROUP BY station_id)
             AND w.station_id = i.station_id""")
def dash_unit_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, info, weather = _tables(spark, sf_dir)
    found = weather_headline(weather, info, AT, [ALL])
    return found.select(*[F.round(c, 6).alias(c) for c in found.columns])


@query(f"""WITH {_WEATHER_SQL} SELECT event_id, station_id, dt FROM weather
           WHERE (dt, station_id) IN (SELECT (max(dt), station_id) FROM weather GROUP BY station_id)""")
def latest_per_key_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    weather = clean_weather(raw_weather(spark, sf_dir)).select("event_id", "station_id", "dt")
    return timeseries.latest_per_key(weather, ["station_id"], "dt")


_SOME = ["Customer#000000003", "Customer#000000005", "Customer#000000008", "Customer#000000013"]
_SOME_SQL = ", ".join(f"'{n}'" for n in _SOME)


def status_headline(status: DataFrame, info: DataFrame, at: str, names: list[str]) -> DataFrame:
    newest = status.where(F.col("last_updated_hr") == utc_hour(at)).agg(F.max("last_updated").alias("m"))
    return (status.where(F.col("last_updated") == newest.scalar()).join(chosen(info, names), "station_id")
            .agg(F.sum("num_bikes_available").alias("bikes"), F.sum("num_docks_available").alias("docks")))


_NEWEST_SQL = f"(SELECT max(poll) FROM status WHERE last_updated_hr = {_HOUR})"


@query(f"""WITH {_STATUS_SQL}, {_INFO_SQL} SELECT CAST(sum(bikes) AS BIGINT) AS bikes, CAST(sum(docks) AS BIGINT) AS docks
           FROM status s, info i WHERE s.poll = {_NEWEST_SQL} AND s.station_id = i.station_id""")
def dash_latest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    status, info, _ = _tables(spark, sf_dir)
    return status_headline(status, info, AT, [ALL])


@query(f"""WITH {_STATUS_SQL}, {_INFO_SQL} SELECT name, CAST(sum(bikes) AS BIGINT) AS bikes, COUNT(*) AS reports
           FROM status s, info i WHERE s.station_id = i.station_id AND name IN ({_SOME_SQL}) GROUP BY name""")
def dash_comma_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations picked by a list parameter bound to the SQL text."""
    status, info, _ = _tables(spark, sf_dir)
    return spark.sql("""SELECT name, sum(num_bikes_available) AS bikes, count(*) AS reports FROM {s} s, {i} i
                        WHERE s.station_id = i.station_id
                          AND (array_contains(:stations, name) OR array_contains(:stations, '-- ALL STATIONS --'))
                        GROUP BY name""", args={"stations": F.array(*[F.lit(n) for n in _SOME])}, s=status, i=info)


def availability_24h(status: DataFrame, info: DataFrame, at: str, names: list[str], zone: str = ZONE) -> DataFrame:
    hour = utc_hour(at, zone)
    recent = timeseries.last_span(status, "last_updated", 86_400, F.col("last_updated_hr") == hour)
    return (recent.where(F.col("last_updated_hr") <= hour).join(chosen(info, names), "station_id")
            .groupBy("last_updated_ts")
            .agg(F.sum("num_bikes_available").alias("bikes"), F.sum("num_docks_available").alias("docks"))
            .orderBy("last_updated_ts")
            .select("bikes", "docks", F.from_utc_timestamp("last_updated_ts", zone).alias("local_time")))


@query(f"""WITH {_STATUS_SQL}, {_INFO_SQL} SELECT CAST(sum(bikes) AS BIGINT) AS bikes, CAST(sum(docks) AS BIGINT) AS docks,
             poll - 21600 AS local_epoch FROM status s, info i
           WHERE poll >= (SELECT max(poll) - 86400 FROM status WHERE last_updated_hr = {_HOUR}) AND last_updated_hr <= {_HOUR}
             AND s.station_id = i.station_id GROUP BY poll""")
def last_24h(spark: SparkSession, sf_dir: str) -> DataFrame:
    status, info, _ = _tables(spark, sf_dir)
    return availability_24h(status, info, AT, [ALL]).select("bikes", "docks", F.unix_seconds("local_time").alias("local_epoch"))


def weather_24h(weather: DataFrame, info: DataFrame, at: str, names: list[str], zone: str = ZONE) -> DataFrame:
    hour = utc_hour(at, zone)
    recent = timeseries.last_span(weather, "dt", 86_400, F.col("dt_hr") == hour).where(F.col("dt_hr") <= hour)
    local_hour = F.hour(F.from_utc_timestamp("dt_ts", zone)).cast("string")
    return (recent.join(chosen(info, names), "station_id").groupBy(local_hour.alias("local_hour"))
            .agg(clean.fahrenheit(F.avg("main_temp")).alias("avg_temp_f"), F.avg("wind_speed").alias("avg_wind_speed"),
                 F.max("dt").alias("max_dt")).orderBy("max_dt"))


@query(f"""WITH {_WEATHER_SQL}, {_INFO_SQL} SELECT round((avg(main_temp) - 273.15) * 9 / 5 + 32, 6) AS avg_temp_f,
             round(avg(wind_speed), 6) AS avg_wind_speed, max(dt) AS max_dt, CAST((dt - 21600) // 3600 % 24 AS VARCHAR) AS local_hour
           FROM weather w, info i WHERE dt >= (SELECT max(dt) - 86400 FROM weather WHERE dt_hr = {_HOUR}) AND dt_hr <= {_HOUR}
             AND w.station_id = i.station_id GROUP BY 4""")
def dash_weather_24h(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, info, weather = _tables(spark, sf_dir)
    return weather_24h(weather, info, AT, [ALL]).withColumns(
        {c: F.round(c, 6) for c in ("avg_temp_f", "avg_wind_speed")})


def status_and_weather(status: DataFrame, info: DataFrame, weather: DataFrame, at: str, names: list[str]) -> DataFrame:
    """Station status of the hour before, with the weather of the same hour where there is one."""
    newest = status.where(F.col("last_updated_hr") == utc_hour(at) - 3600).agg(F.max("last_updated").alias("m"))
    now = status.where(F.col("last_updated") == newest.scalar()).join(chosen(info, names), "station_id")
    hourly = weather.select("station_id", F.col("dt_hr").alias("last_updated_hr"), "main_temp",
                            F.concat_ws(", ", "weather_description").alias("weather_desc"))
    return (now.join(hourly, ["station_id", "last_updated_hr"], "left")
            .select("name", "station_id", "station_type", "capacity", F.col("num_bikes_available").alias("bikes"),
                    F.col("num_docks_available").alias("docks"), "weather_desc",
                    clean.fahrenheit(F.col("main_temp")).alias("temp_f"), "secs_since_last_reported")
            .orderBy(F.desc("bikes")))


@query(f"""WITH {_STATUS_SQL}, {_INFO_SQL}, {_WEATHER_SQL}
           SELECT name, s.station_id, station_type, capacity, bikes, docks, array_to_string(weather_description, ', ') AS weather_desc,
             round((main_temp - 273.15) * 9 / 5 + 32, 6) AS temp_f, secs_since_last_reported
           FROM info i JOIN status s ON i.station_id = s.station_id
             AND s.poll = (SELECT max(poll) FROM status WHERE last_updated_hr = {_HOUR} - 3600)
           LEFT JOIN weather w ON i.station_id = w.station_id AND s.last_updated_hr = w.dt_hr""")
def dash_status_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    status, info, weather = _tables(spark, sf_dir)
    return status_and_weather(status, info, weather, AT, [ALL]).withColumn("temp_f", F.round("temp_f", 6))


def zero_availability(status: DataFrame, info: DataFrame, at: str) -> DataFrame:
    """Stations without bikes or without docks in the newest poll of the hour, as distinct rows."""
    newest = status.where(F.col("last_updated_hr") == utc_hour(at)).agg(F.max("last_updated").alias("m"))
    now = status.where(F.col("last_updated") == newest.scalar()).join(info, "station_id")

    # Both labels from one pass over the stations.
    labels = F.array_compact(F.array(F.when(F.col("num_bikes_available") == 0, F.lit("No Bikes Available")),
                                     F.when(F.col("num_docks_available") == 0, F.lit("No Docks Available"))))
    return now.select("name", "station_type", "capacity", "lat", "lon", F.col("num_bikes_available").alias("bikes"),
                      F.col("num_docks_available").alias("docks"), "secs_since_last_reported",
                      F.explode(labels).alias("availability")).distinct()


@query(f"""WITH {_STATUS_SQL}, {_INFO_SQL}, now AS (SELECT i.name, station_type, capacity, lat, lon, bikes, docks, secs_since_last_reported
             FROM info i JOIN status s ON i.station_id = s.station_id AND poll = {_NEWEST_SQL})
           SELECT *, 'No Bikes Available' AS availability FROM now WHERE bikes = 0
           UNION SELECT *, 'No Docks Available' FROM now WHERE docks = 0""")
def union_distinct_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    status, info, _ = _tables(spark, sf_dir)
    return zero_availability(status, info, AT)


def description_counts(weather: DataFrame) -> DataFrame:
    """Two levels: reports per description list first, then per single description."""
    lists = weather.groupBy("weather_description").agg(F.count(F.lit(1)).alias("n"))
    return (lists.select(F.explode("weather_description").alias("weather_description"), "n")
            .groupBy("weather_description").agg(F.sum("n").alias("num_stations")))


@query(f"""WITH {_WEATHER_SQL}, newest AS (SELECT * FROM weather WHERE (dt, station_id) IN
             (SELECT (max(dt), station_id) FROM weather GROUP BY station_id))
           SELECT d AS weather_description, COUNT(*) AS num_stations
           FROM (SELECT unnest(weather_description) AS d FROM newest) GROUP BY d""")
def two_level_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    weather = clean_weather(raw_weather(spark, sf_dir))
    return description_counts(timeseries.latest_per_key(weather, ["station_id"], "dt"))


@query(f"""WITH {_WEATHER_SQL} SELECT d AS weather_description, COUNT(*) AS num_stations
           FROM (SELECT unnest(weather_description) AS d FROM weather) GROUP BY d""")
def explode_word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (clean_weather(raw_weather(spark, sf_dir)).select(F.explode("weather_description").alias("weather_description"))
            .groupBy("weather_description").agg(F.count(F.lit(1)).alias("num_stations")))
