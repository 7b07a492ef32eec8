"""Change feeds and snapshots: the event table as a feed per user, orders as yearly snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import workspace
from strata.functions import clean
from strata.operators import cdc, quality, ranking, snapshots
from strata.operators.snapshot_store import SnapshotStore
from strata.plans.registry import query
from strata.sources import files, messages, onboarding, snapshot_stream
from strata.streaming import runner
from strata.streaming.changes import ChangeTable
from strata.tables import table, table_stream

KEYS, SEQUENCE, DELETES = ["user_id"], "ts", "operation = 'error'"
CLEAN = [quality.Rule("valid_id", "user_id IS NOT NULL", "drop"), quality.Rule("valid_value", "value > 10.0"),
         quality.Rule("valid_operation", "operation IS NOT NULL", "drop")]

_HISTORY_SQL = """feed AS (SELECT user_id, ts, event_type, event_type = 'error' AS del FROM events),
  seen AS (SELECT *, lag(del) OVER w AS pdel, lag(event_type) OVER w AS ptype FROM feed
           WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
  turns AS (SELECT * FROM seen WHERE (NOT del AND (pdel IS NULL OR pdel OR ptype <> event_type))
            OR (del AND pdel IS NOT NULL AND NOT pdel)),
  ended AS (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS end_ts FROM turns),
  history AS (SELECT user_id, event_type, ts AS start_ts, end_ts FROM ended WHERE NOT del)"""
_HISTORY_OUT = "SELECT user_id, event_type, epoch_us(start_ts) AS start_us, epoch_us(end_ts) AS end_us FROM history"
_LATEST_SQL = """SELECT user_id, event_type AS operation, value, epoch_us(ts) AS ts_us FROM
  (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS r FROM events)
  WHERE r = 1 AND event_type <> 'error'"""


def feed(events: DataFrame) -> DataFrame:
    return events.select("user_id", F.col("event_type").alias("operation"), "value", "ts")


def history(events: DataFrame, **options) -> DataFrame:
    """Type 2 history of each user's event type; an error deletes the user."""
    changes = events.select("user_id", "event_type", "ts")
    return cdc.apply_changes(changes, ["user_id"], "ts", "event_type = 'error'", scd_type=2, **options)


def micros(rows: DataFrame) -> DataFrame:
    """Validity as epoch microseconds."""
    others = [c for c in rows.columns if c not in (cdc.START, cdc.END)]
    return rows.select(*others, F.unix_micros(cdc.START).alias("start_us"), F.unix_micros(cdc.END).alias("end_us"))


def _latest(rows: DataFrame) -> DataFrame:
    return rows.select("user_id", "operation", "value", F.unix_micros("ts").alias("ts_us"))


@query(_LATEST_SQL)
def cdc_scd1(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = quality.expect(feed(table(spark, sf_dir, "events")), CLEAN)
    return _latest(cdc.apply_changes(changes, KEYS, SEQUENCE, DELETES))


def _folded(spark: SparkSession, sf_dir: str, columns: list[str], **options) -> DataFrame:
    changes = feed(table_stream(spark, sf_dir, "events")).select(*columns)
    base = workspace.new_dir(spark, "change-table")
    target = ChangeTable(spark, f"{base}/table", changes.schema, KEYS, SEQUENCE, DELETES, **options)
    runner.finish(target.run(quality.expect(changes, [CLEAN[0], CLEAN[2]]), f"{base}/checkpoint"))
    return target.read()


@query(_LATEST_SQL)
def stream_cdc_scd1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _latest(_folded(spark, sf_dir, ["user_id", "operation", "value", "ts"]))


@query(f"WITH {_HISTORY_SQL} {_HISTORY_OUT}")
def cdc_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return micros(history(table(spark, sf_dir, "events")))


@query(f"WITH {_HISTORY_SQL} {_HISTORY_OUT}")
def stream_cdc_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _folded(spark, sf_dir, ["user_id", "operation", "ts"], scd_type=2)
    return micros(rows).withColumnRenamed("operation", "event_type")


@query(f"WITH {_HISTORY_SQL} {_HISTORY_OUT} WHERE end_ts IS NULL")
def scd2_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return micros(cdc.current(history(table(spark, sf_dir, "events"))))


_MULTI_SQL = """SELECT 'users' AS source, user_id AS id, COUNT(*) AS versions, COUNT(*) FILTER (end_ts IS NULL) AS open_versions
                FROM history GROUP BY user_id
                UNION ALL SELECT 'stores', s_suppkey, 1, 1 FROM supplier
                UNION ALL SELECT 'customers', c_custkey, 1, 1 FROM customer"""


@query(f"WITH {_HISTORY_SQL} {_MULTI_SQL}")
def scd2_multi_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bronze-to-history flow for several replicated tables; full loads come without an ``Op``."""
    def template(name: str, options: dict) -> DataFrame:
        bronze = files.ensure_columns(options["rows"], "Op STRING")
        versions = cdc.apply_changes(bronze, [options["id"]], "replicated_at", "Op = 'D'", ["Op"], 2)
        return (versions.groupBy(F.col(options["id"]).alias("id"))
                .agg(F.count(F.lit(1)).alias("versions"), F.count_if(F.col(cdc.END).isNull()).alias("open_versions"))
                .select(F.lit(name).alias("source"), "id", "versions", "open_versions"))

    loaded = F.lit("2024-01-01").cast("timestamp").alias("replicated_at")
    events = table(spark, sf_dir, "events")
    op = F.when(F.col("event_type") == "error", "D").otherwise("U").alias("Op")
    built = onboarding.per_table(template, {
        "users": {"id": "user_id", "rows": events.select("user_id", "event_type", op, F.col("ts").alias("replicated_at"))},
        "stores": {"id": "s_suppkey", "rows": table(spark, sf_dir, "supplier").select("*", loaded)},
        "customers": {"id": "c_custkey", "rows": table(spark, sf_dir, "customer").select("*", loaded)},
    })
    return files.union_evolved(list(built.values()))


_ENVELOPE = ("payload STRUCT<before: STRUCT<user_id: BIGINT, value: DOUBLE, updated: BIGINT>, "
             "after: STRUCT<user_id: BIGINT, value: DOUBLE, updated: BIGINT>, op: STRING>")


@query("""SELECT user_id, value, epoch_us(ts) // 1000 AS updated,
                 CASE event_type WHEN 'error' THEN 'd' WHEN 'signup' THEN 'c' ELSE 'u' END AS op FROM events""")
def debezium_unwrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    image = F.struct("user_id", "value", F.unix_millis("ts").alias("updated"))
    gone = F.col("event_type") == "error"
    op = F.when(gone, "d").when(F.col("event_type") == "signup", "c").otherwise("u")
    payload = F.struct(F.when(gone, image).alias("before"), F.when(~gone, image).alias("after"), op.alias("op"))
    sent = messages.encode(table(spark, sf_dir, "events").withColumn("payload", payload), "user_id", ["payload"])
    return messages.unwrap_envelope(messages.decode(sent, _ENVELOPE, keep=["key"]))


@query("""SELECT user_id, last AS max_time, first AS min_time, round((last - first) / 86400000.0) AS customer_lifetime
          FROM (SELECT user_id, max(epoch_us(ts) // 1000) AS last, min(epoch_us(ts) // 1000) AS first
                FROM events GROUP BY user_id)""")
def customer_lifetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    ms = F.unix_millis("ts")
    return (table(spark, sf_dir, "events").groupBy("user_id")
            .agg(F.max(ms).alias("max_time"), F.min(ms).alias("min_time"))
            .withColumn("customer_lifetime", clean.lifetime_days(F.col("min_time"), F.col("max_time"))))


@query("""SELECT user_id, n, CASE WHEN n <= 2 THEN 'LOW' WHEN n <= 10 THEN 'MEDIUM' ELSE 'HIGH' END AS engagement FROM
          (SELECT user_id, CASE WHEN n < 15 THEN n END AS n FROM
            (SELECT user_id, COUNT(*) FILTER (event_type = 'purchase') AS n FROM events GROUP BY user_id))""")
def engagement_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "purchase").alias("n"))
    known = counts.withColumn("n", F.when(F.col("n") < 15, F.col("n")))
    return known.withColumn("engagement", clean.engagement("n"))


# Yearly snapshots: open for a year, then settled; fulfilled orders leave after three years.
DATES = ["1998-01-01", "1999-01-01", "2000-01-01"]


def snapshot(spark: SparkSession, sf_dir: str, day: str) -> DataFrame:
    age = F.datediff(F.lit(day).cast("date"), F.to_date("o_orderdate"))
    return (table(spark, sf_dir, "orders").where((age >= 0) & ~((F.col("o_orderstatus") == "F") & (age > 1095)))
            .select("o_orderkey", F.when(age < 365, "open").otherwise(F.col("o_orderstatus")).alias("status"),
                    (F.col("o_totalprice") + int(day[:4])).alias("price")))


def _snapshot_sql(i: int) -> str:
    age = f"date_diff('day', CAST(o_orderdate AS DATE), DATE '{DATES[i]}')"
    return f"""SELECT o_orderkey, CASE WHEN {age} < 365 THEN 'open' ELSE o_orderstatus END AS status,
                      o_totalprice + {DATES[i][:4]} AS price, {i} AS n
               FROM orders WHERE {age} >= 0 AND NOT (o_orderstatus = 'F' AND {age} > 1095)"""


_SERIES_SQL = "snaps AS (" + " UNION ALL ".join(_snapshot_sql(i) for i in range(3)) + ")"
_SNAPSHOT_HISTORY_SQL = f"""{_SERIES_SQL},
  marked AS (SELECT *, CASE WHEN lag(n) OVER w IS DISTINCT FROM n - 1 OR lag(status) OVER w IS DISTINCT FROM status
                            THEN 1 ELSE 0 END AS opens FROM snaps WINDOW w AS (PARTITION BY o_orderkey ORDER BY n)),
  runs AS (SELECT *, SUM(opens) OVER (PARTITION BY o_orderkey ORDER BY n) AS run FROM marked),
  history AS (SELECT o_orderkey, arg_max(status, n) AS status, arg_max(price, n) AS price,
                     {DATES}[min(n) + 1] AS __START_AT, {DATES}[max(n) + 2] AS __END_AT
              FROM runs GROUP BY o_orderkey, run)"""


def _series(spark: SparkSession, sf_dir: str) -> list[tuple[DataFrame, str]]:
    return [(snapshot(spark, sf_dir, day), day) for day in DATES]


def _stored(spark: SparkSession, sf_dir: str) -> SnapshotStore:
    """The series in a store with bucket digests."""
    series = _series(spark, sf_dir)
    store = SnapshotStore(spark, workspace.new_dir(spark, "snapshots"), series[0][0].schema, ["o_orderkey"], buckets=16)
    for frame, day in series:
        store.write(frame, day)
    return store


@query(f"WITH {_SERIES_SQL} SELECT o_orderkey, status, price FROM snaps WHERE n = 2")
def snapshot_scd1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first stored snapshot brought up to date by applying the change sets of the later ones, bucket by bucket."""
    return _stored(spark, sf_dir).current(DATES)


@query(f"""WITH {_SERIES_SQL}, a AS (SELECT * FROM snaps WHERE n = 1), b AS (SELECT * FROM snaps WHERE n = 2)
           SELECT COALESCE(b.o_orderkey, a.o_orderkey) AS o_orderkey, COALESCE(b.status, a.status) AS status,
             COALESCE(b.price, a.price) AS price,
             CASE WHEN a.n IS NULL THEN 'insert' WHEN b.n IS NULL THEN 'delete' ELSE 'update' END AS _change
           FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey
           WHERE a.n IS NULL OR b.n IS NULL OR a.status <> b.status OR a.price <> b.price""")
def snapshot_change_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    (_, _), (older, _), (newer, _) = _series(spark, sf_dir)
    return snapshots.change_set(older, newer, ["o_orderkey"])


# Orders below this key get another price in the second snapshot.
_LATE = 100


@query(f"""SELECT o_orderkey, o_orderstatus AS status, o_totalprice + CASE WHEN o_orderkey < {_LATE} THEN 1 ELSE 0 END AS price,
                  CASE WHEN o_orderkey < {_LATE} THEN 'update' ELSE 'same' END AS change FROM orders""")
def snapshot_small_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots that differ in a few rows: only the buckets of those are read and joined."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))
    later = orders.withColumn("price", F.col("price") + F.when(F.col("o_orderkey") < _LATE, 1).otherwise(0))
    store = SnapshotStore(spark, workspace.new_dir(spark, "snapshots"), orders.schema, ["o_orderkey"], buckets=64)
    store.write(orders, 1)
    store.write(later, 2)
    changes = store.change_set(1, 2).select("o_orderkey", F.col("_change").alias("change"))
    return store.read(2).join(changes, "o_orderkey", "left").withColumn("change", F.coalesce("change", F.lit("same")))


@query(f"WITH {_SNAPSHOT_HISTORY_SQL} SELECT * FROM history")
def snapshot_scd2_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same history from stored snapshots, joining the changed buckets of each only."""
    return _stored(spark, sf_dir).history(DATES, ["status"])


@query(f"WITH {_SNAPSHOT_HISTORY_SQL} SELECT * FROM history")
def snapshot_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.history(_series(spark, sf_dir), ["o_orderkey"], ["status"])


@query(f"WITH {_SNAPSHOT_HISTORY_SQL} SELECT * FROM history")
def snapshot_scd2_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same history, folding in one snapshot at a time."""
    first, *later = _series(spark, sf_dir)
    return snapshots.fold_history(first, later, ["o_orderkey"], ["status"])


@query(f"WITH {_SNAPSHOT_HISTORY_SQL} SELECT status AS order_status, COUNT(*) AS orders_count FROM history GROUP BY 1")
def order_status_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (snapshot_scd2(spark, sf_dir).groupBy(F.col("status").alias("order_status"))
            .agg(F.count("o_orderkey").alias("orders_count")))


@query(f"""WITH {_SERIES_SQL}, hours(n, version) AS (VALUES (0, '2024-01-01 22'), (1, '2024-01-01 23'), (2, '2024-01-02 00'))
           SELECT version, o_orderkey, status, price FROM snaps JOIN hours USING (n)""")
def stream_snapshot_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly snapshot folders as a stream; the last one arrives late and is waited for, though a later one is there."""
    base = workspace.new_dir(spark, "hourly")
    frames = [frame for frame, _ in _series(spark, sf_dir)]
    schema = frames[0].schema

    def run() -> None:
        feed = snapshot_stream.stream(spark, f"{base}/in", schema.toDDL())
        runner.finish(runner.append(feed, f"{base}/out", f"{base}/checkpoint"))

    for frame, hour in zip([*frames[:2], frames[0]], ["2024-01-01 22", "2024-01-01 23", "2024-01-02 01"]):
        frame.write.parquet(f"{base}/in/{hour}")
    run()
    frames[2].write.parquet(f"{base}/in/2024-01-02 00")
    workspace.remove(spark, f"{base}/in/2024-01-02 01")
    run()
    return spark.read.schema(f"{schema.toDDL()}, version STRING").parquet(f"{base}/out").select("version", "o_orderkey", "status", "price")


def _status_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Order status codes spelled out.
    words = F.when(F.col("o_orderstatus") == "P", "pending").when(F.col("o_orderstatus") == "F", "returned").otherwise("delivered")
    return table(spark, sf_dir, "orders").select("o_orderkey", words.alias("status"), "o_orderdate")


@query("""SELECT o_orderkey FROM orders
          ORDER BY CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate END NULLS FIRST, o_orderkey
          LIMIT (SELECT COUNT(*) * 3 // 10 FROM orders)""")
def oldest_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderdate")).alias("at"))
    return ranking.first_n(orders, ["at", "o_orderkey"], orders.count() * 3 // 10).select("o_orderkey")


@query("""SELECT o_orderkey, event_id FROM
            (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS r FROM orders) a
            JOIN (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS r FROM events) b USING (r)""")
def zip_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.zip_rows(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"],
        table(spark, sf_dir, "events").select("event_id", "ts"), ["ts", "event_id"]).select("o_orderkey", "event_id")


@query("SELECT event_id, user_id, event_type, value FROM events")
def stream_incremental_equals_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two triggered runs over a growing folder: the second one reads only what the first has not."""
    columns = ["event_id", "user_id", "event_type", "value"]
    events = table(spark, sf_dir, "events")
    middle = F.lit("2024-01-15").cast("timestamp")
    base = workspace.new_dir(spark, "growing")
    schema = events.select(*columns).schema
    for part in (events.where(F.col("ts") < middle), events.where(F.col("ts") >= middle)):
        part.select(*columns).write.mode("append").parquet(f"{base}/in")
        runner.finish(runner.append(files.stream(spark, f"{base}/in", "parquet", schema), f"{base}/out", f"{base}/checkpoint"))
    return spark.read.schema(schema).parquet(f"{base}/out")
