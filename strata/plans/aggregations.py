"""Data-quality counters, grouped and global aggregates, incremental refresh."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import workspace
from strata.functions import clean
from strata.operators import aggregates, quality, timeseries
from strata.operators.stored_stats import StoredStats
from strata.plans.registry import query
from strata.streaming import changes, rules, runner
from strata.tables import table, table_stream

RULES = [quality.Rule("low_discount", "l_discount < 0.05"), quality.Rule("big_enough", "l_quantity > 2", "drop"),
         quality.Rule("not_returned_early", "l_returnflag <> 'R' OR l_linestatus = 'F'", "drop")]
_DROPPED = "l_quantity > 2 AND (l_returnflag <> 'R' OR l_linestatus = 'F')"
_RULES_SQL = """rules AS (SELECT 'low_discount' AS name, l_discount < 0.05 AS ok FROM lineitem
   UNION ALL SELECT 'big_enough', l_quantity > 2 FROM lineitem
   UNION ALL SELECT 'not_returned_early', l_returnflag <> 'R' OR l_linestatus = 'F' FROM lineitem)"""


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


@query(f"""WITH {_RULES_SQL} SELECT name, 'lineitem' AS dataset, COUNT(*) FILTER (ok) AS passed_records,
             COUNT(*) FILTER (NOT ok) AS failed_records FROM rules WHERE name = 'low_discount' GROUP BY name""")
def expect_warn_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.metrics(_lines(spark, sf_dir), RULES[:1], "lineitem")


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 2")
def expect_or_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.expect(_lines(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_quantity"), [RULES[1]])


@query(f"""SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_returnflag, l_linestatus FROM lineitem
           WHERE {_DROPPED}""")
def expect_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _lines(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag", "l_linestatus")
    return quality.expect(rows, RULES)


@query("""SELECT l_orderkey, l_linenumber, concat_ws(',', CASE WHEN NOT l_discount < 0.05 THEN 'low_discount' END,
             CASE WHEN NOT l_quantity > 2 THEN 'big_enough' END,
             CASE WHEN NOT (l_returnflag <> 'R' OR l_linestatus = 'F') THEN 'not_returned_early' END) AS failed_rules
          FROM lineitem WHERE NOT (l_discount < 0.05 AND l_quantity > 2 AND (l_returnflag <> 'R' OR l_linestatus = 'F'))""")
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quarantine(_lines(spark, sf_dir), RULES).select(
        "l_orderkey", "l_linenumber", F.concat_ws(",", "failed_rules").alias("failed_rules"))


@query(f"""WITH {_RULES_SQL} SELECT name, 'lineitem' AS dataset, COUNT(*) FILTER (ok) AS passed_records,
             COUNT(*) FILTER (NOT ok) AS failed_records FROM rules GROUP BY name""")
def expectation_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.metrics(_lines(spark, sf_dir), RULES, "lineitem")


@query(f"""WITH {_RULES_SQL}, counts AS (SELECT name, 'lineitem' AS dataset, COUNT(*) FILTER (ok) AS passed_records,
             COUNT(*) FILTER (NOT ok) AS failed_records FROM rules GROUP BY name)
           SELECT *, (SELECT COUNT(*) FROM lineitem WHERE {_DROPPED}) AS written FROM counts""")
def stream_rule_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts that come with the batches of a stream, beside the rows that it has written."""
    base = workspace.new_dir(spark, "rule-counts")
    lines = table_stream(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_discount", "l_returnflag", "l_linestatus")
    listener = rules.RuleCounts(spark, f"{base}/counts", {"lineitem": RULES})
    spark.streams.addListener(listener)
    try:
        listener.finish(runner.append(rules.counted(lines, RULES, "lineitem"), f"{base}/table", f"{base}/checkpoint"))
    finally:
        spark.streams.removeListener(listener)
    written = spark.read.schema(lines.schema).parquet(f"{base}/table").agg(F.count("*").alias("written"))
    return rules.totals(rules.read_counts(spark, f"{base}/counts")).crossJoin(F.broadcast(written))


@query(f"""WITH {_RULES_SQL}, counts AS (SELECT name, 'lineitem' AS dataset, COUNT(*) FILTER (ok) AS passed_records,
             COUNT(*) FILTER (NOT ok) AS failed_records FROM rules GROUP BY name)
           SELECT *, CASE name WHEN 'low_discount' THEN 'warn' ELSE 'drop' END AS action,
             (SELECT COUNT(*) FROM lineitem WHERE {_DROPPED} AND l_returnflag = 'A') AS published_returns FROM counts""")
def publish_rule_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts recorded by the write of a partitioned table, which then appears as a whole."""
    path = workspace.new_dir(spark, "published")
    lines = _lines(spark, sf_dir).select("l_orderkey", "l_quantity", "l_discount", "l_linestatus", "l_returnflag")
    counts = quality.publish(lines, RULES, path, "lineitem", partition_by=["l_returnflag"])
    returns = spark.read.schema(lines.schema).parquet(path).where("l_returnflag = 'A'").agg(F.count("*").alias("published_returns"))
    return spark.createDataFrame([vars(c) for c in counts], "name STRING, dataset STRING, action STRING, passed_records BIGINT, "
                                 "failed_records BIGINT").crossJoin(F.broadcast(returns))


@query(f"""SELECT 'lineitem' AS dataset, COUNT(*) FILTER ({_DROPPED}) AS num_output_rows,
             COUNT(*) FILTER (NOT ({_DROPPED})) AS dropped_records FROM lineitem""")
def flow_progress_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.flow_metrics(_lines(spark, sf_dir), RULES, "lineitem")


_MONEY = "CAST(value AS DECIMAL(18,2))"
_AGG_SQL = f"""SELECT user_id AS customer_id, CAST(MIN({_MONEY}) AS DOUBLE) AS min_amount, CAST(MAX({_MONEY}) AS DOUBLE) AS max_amount,
   CAST(SUM({_MONEY}) AS DOUBLE) AS total_amount, CAST(SUM({_MONEY}) AS DOUBLE) / COUNT(value) AS avg_amount
   FROM events GROUP BY 1"""


def _payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("customer_id"), F.col("value").cast("decimal(18,2)").alias("amount"), "ts")


@query(_AGG_SQL)
def customer_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = aggregates.partial_stats(_payments(spark, sf_dir), ["customer_id"], "amount")
    return aggregates.finish_stats(stats, ["customer_id"])


@query(_AGG_SQL)
def incremental_agg_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of an older base, refreshed with three later appends, each aggregated on its own."""
    payments = _payments(spark, sf_dir)
    cuts = [F.lit(d).cast("timestamp") for d in ("2024-01-22", "2024-01-25", "2024-01-28")]
    stats = aggregates.partial_stats(payments.where(F.col("ts") < cuts[0]), ["customer_id"], "amount")
    for start, end in zip(cuts, [*cuts[1:], None]):
        appended = payments.where(F.col("ts") >= start)
        delta = appended if end is None else appended.where(F.col("ts") < end)
        stats = aggregates.merge_stats(stats, aggregates.partial_stats(delta, ["customer_id"], "amount"), ["customer_id"])
    return aggregates.finish_stats(stats, ["customer_id"])


@query(_AGG_SQL)
def stored_agg_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics stored in hash buckets; small appends replace the buckets of their keys only."""
    payments = _payments(spark, sf_dir)
    schema = payments.select("customer_id", "amount").schema
    stats = StoredStats(spark, workspace.new_dir(spark, "stats"), schema, ["customer_id"], "amount", buckets=64)
    cuts = [F.lit(d).cast("timestamp") for d in ("0001-01-01", "2024-01-28", "2024-01-29", "9999-01-01")]
    for i, (start, end) in enumerate(zip(cuts, cuts[1:])):
        stats.append(payments.where((F.col("ts") >= start) & (F.col("ts") < end)), i)
    return stats.read()


_STAT_SQL = """SELECT COUNT(value) AS events, MAX(value) AS max, MIN(value) AS min, round(AVG(value), 6) AS average,
                      round(stddev_samp(value), 6) AS stddev FROM events"""


def _rounded(stats: DataFrame) -> DataFrame:
    return stats.withColumns({"average": F.round("average", 6), "stddev": F.round("stddev", 6)})


@query(_STAT_SQL)
def global_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(table(spark, sf_dir, "events").agg(*aggregates.global_stats("value")))


@query(_STAT_SQL)
def stream_global_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = table_stream(spark, sf_dir, "events").groupBy().agg(*aggregates.global_stats("value"))
    return _rounded(runner.completed(stats, "global-stat"))


@query("SELECT user_id AS device, MAX(value) AS max_magn FROM events GROUP BY 1")
def max_per_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("device")).agg(F.max("value").alias("max_magn"))


@query("SELECT user_id AS device, MAX(value) AS max_magn FROM events GROUP BY 1")
def stream_max_per_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table_stream(spark, sf_dir, "events")
    return changes.upserted(rows.groupBy(F.col("user_id").alias("device")).agg(F.max("value").alias("max_magn")), ["device"], "max")


@query("SELECT COUNT(*) AS n FROM lineitem")
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT lang, COUNT(*) AS n FROM documents GROUP BY lang ORDER BY n, lang")
def count_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("n", "lang")


@query("""SELECT min(epoch_us(ts)) AS first_us, max(epoch_us(ts)) AS last_us, COUNT(DISTINCT user_id) AS n_keys FROM events""")
def time_range_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = timeseries.time_range(table(spark, sf_dir, "events"), "ts", "user_id")
    return found.select(F.unix_micros("first_time").alias("first_us"), F.unix_micros("last_time").alias("last_us"), "n_keys")


@query("SELECT o_orderkey, o_totalprice, (SELECT MAX(p_retailprice) FROM part) AS initial_balance FROM orders")
def cross_one_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row joined to a one-row relation, as a scalar subquery: more than one row is an error."""
    one = table(spark, sf_dir, "part").agg(F.max("p_retailprice").alias("initial_balance"))
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", one.scalar().alias("initial_balance"))


@query("""SELECT user_id, event_type, MIN(event_id) AS event_id, arg_min(value, event_id) AS value
          FROM events GROUP BY user_id, event_type""")
def dedup_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    return aggregates.dedup(rows, ["user_id", "event_type"], ["event_id"])


@query("""SELECT event_id, epoch_us(ts) // 1000000 AS epoch, epoch_us(date_trunc('hour', ts)) // 1000000 AS hour_epoch,
             strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%d %H:%M:%S') AS text FROM events""")
def epoch_hour_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    epoch = F.unix_seconds("ts")
    return table(spark, sf_dir, "events").select(
        "event_id", epoch.alias("epoch"), clean.hour_epoch(F.timestamp_seconds(epoch)).alias("hour_epoch"),
        F.to_date(F.timestamp_seconds(epoch)).cast("string").alias("day"), F.from_unixtime(epoch).alias("text"))


@query("""SELECT vec_id, round(sqrt(CAST(embedding[1] AS DOUBLE) * 100 * embedding[1] * 100 + CAST(embedding[2] AS DOUBLE) * 100
             * embedding[2] * 100 + CAST(embedding[3] AS DOUBLE) * 100 * embedding[3] * 100)) AS magnitude FROM embeddings""")
def magnitude(spark: SparkSession, sf_dir: str) -> DataFrame:
    axes = [F.get("embedding", F.lit(i)).cast("double") * 100 for i in range(3)]
    return table(spark, sf_dir, "embeddings").select("vec_id", clean.magnitude(*axes).alias("magnitude"))


@query("SELECT quality AS label, COUNT(*) AS n, COUNT(*) / SUM(COUNT(*)) OVER () AS share FROM labels GROUP BY quality")
def label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.shares(table(spark, sf_dir, "labels").select(F.col("quality").alias("label")), "label")
