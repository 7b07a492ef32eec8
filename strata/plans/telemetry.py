"""Event-log queries over a log derived from the event table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import telemetry
from strata.plans.ingest import K, SQL_K
from strata.plans.registry import query
from strata.tables import table


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases and clicks report progress, views define flows, errors measure the cluster, signups start updates."""
    k = F.col("k")
    rule = F.struct(F.concat(F.lit("rule_"), k % 4).alias("name"), F.concat(F.lit("table_"), k % 7).alias("dataset"),
                    k.cast("bigint").alias("passed_records"), (k % 9).cast("bigint").alias("failed_records"))
    second = F.struct(F.lit("id_present").alias("name"), F.concat(F.lit("table_"), k % 7).alias("dataset"),
                      (k + 1).cast("bigint").alias("passed_records"), F.lit(0).cast("bigint").alias("failed_records"))
    completed = F.col("event_type") == "purchase"
    progress = F.struct(
        F.when(completed, "COMPLETED").otherwise("RUNNING").alias("status"),
        F.struct((k * 10).alias("num_output_rows"), F.col("value").alias("backlog_bytes")).alias("metrics"),
        F.when(completed, F.struct((k % 5).alias("dropped_records"), F.array(rule, second).alias("expectations"))).alias("data_quality"))
    definition = F.struct(F.concat(F.lit("table_"), k % 7).alias("output_dataset"),
                          F.array(F.concat(F.lit("source_"), F.col("user_id") % 5)).alias("input_datasets"),
                          F.when(k % 2 == 0, "APPEND").otherwise("COMPLETE").alias("flow_type"),
                          F.lit("id BIGINT").alias("schema"), F.lit("== Physical Plan ==").alias("explain_text"))
    usage = F.struct((k % 8).alias("num_executors"), (k % 4 + 1).alias("avg_num_task_slots"),
                     (k / 100).alias("avg_task_slot_utilization"), (k % 3).alias("avg_num_queued_tasks"))
    update = F.struct(F.struct(F.concat(F.lit("15."), k % 5).alias("dbr_version")).alias("runtime_version"))
    kind = (F.when(F.col("event_type").isin("purchase", "click"), "flow_progress").when(F.col("event_type") == "view", "flow_definition")
            .when(F.col("event_type") == "error", "cluster_utilization").otherwise("create_update"))
    details = F.to_json(F.struct(
        F.when(kind == "flow_progress", progress).alias("flow_progress"),
        F.when(kind == "flow_definition", definition).alias("flow_definition"),
        F.when(kind == "cluster_utilization", usage).alias("cluster_utilization"),
        F.when(kind == "create_update", update).alias("create_update")))
    origin = F.struct(F.lit("orders").alias("pipeline_name"),
                      F.concat(F.lit("cluster_"), F.dayofmonth("ts")).alias("cluster_id"),
                      F.when(F.dayofmonth("ts") == 30, "m1").alias("maintenance_id"),
                      F.concat(F.lit("update_"), F.dayofmonth("ts")).alias("update_id"))
    return table(spark, sf_dir, "events").withColumn("k", F.expr(K)).select(
        F.col("event_id").alias("id"), F.col("ts").alias("timestamp"), kind.alias("event_type"), origin.alias("origin"),
        F.concat(F.lit("event "), "event_type").alias("message"), F.lit("INFO").alias("level"), details.alias("details"))


_KIND_SQL = """CASE WHEN event_type IN ('purchase', 'click') THEN 'flow_progress' WHEN event_type = 'view' THEN 'flow_definition'
   WHEN event_type = 'error' THEN 'cluster_utilization' ELSE 'create_update' END"""
_RULES_SQL = f"""found AS (SELECT event_id, ts, {SQL_K} AS k, r FROM events, (VALUES (0), (1)) v(r) WHERE event_type = 'purchase'),
   rules AS (SELECT event_id AS id, epoch_us(ts) AS time_us, CAST(k * 10 AS BIGINT) AS output_records, CAST(k % 5 AS BIGINT) AS dropped_records,
     'COMPLETED' AS status_update, CASE r WHEN 0 THEN 'rule_' || k % 4 ELSE 'id_present' END AS name, 'table_' || k % 7 AS dataset,
     CAST(CASE r WHEN 0 THEN k ELSE k + 1 END AS BIGINT) AS passed_records,
     CAST(CASE r WHEN 0 THEN k % 9 ELSE 0 END AS BIGINT) AS failed_records FROM found)"""


def _timed(rows: DataFrame, column: str = "timestamp") -> DataFrame:
    return rows.withColumn("time_us", F.unix_micros(column)).drop(column)


@query(f"""SELECT event_id AS id, epoch_us(ts) AS time_us, {_KIND_SQL} AS event_type, 'event ' || event_type AS message, 'INFO' AS level,
             (SELECT '15.' || {SQL_K} % 5 FROM events WHERE event_type = 'signup' ORDER BY ts LIMIT 1) AS runtime_version FROM events""")
def eventlog_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = event_log(spark, sf_dir)
    rows = telemetry.raw_events(log).drop("details")
    return _timed(rows.withColumn("runtime_version", telemetry.runtime_version(log).scalar()))


@query(f"WITH {_RULES_SQL} SELECT * FROM rules")
def eventlog_expectations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _timed(telemetry.expectations(event_log(spark, sf_dir)))


@query(f"""WITH {_RULES_SQL} SELECT name, CAST(SUM(passed_records) AS BIGINT) AS passed_records,
             CAST(SUM(failed_records) AS BIGINT) AS failed_records FROM rules GROUP BY name""")
def expectation_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry.rule_totals(telemetry.expectations(event_log(spark, sf_dir)))


@query(f"""SELECT 'table_' || {SQL_K} % 7 AS output_dataset, max(epoch_us(ts)) AS time_us,
             arg_max('source_' || user_id % 5, ts) AS inputs, arg_max(CASE WHEN {SQL_K} % 2 = 0 THEN 'APPEND' ELSE 'COMPLETE' END, ts)
             AS flow_type, 'id BIGINT' AS "schema", '== Physical Plan ==' AS explain_text
           FROM events WHERE event_type = 'view' GROUP BY 1""")
def lineage_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _timed(telemetry.lineage(event_log(spark, sf_dir)), "max_timestamp")
    return rows.withColumn("inputs", F.concat_ws(",", "input_datasets")).drop("input_datasets")


@query(f"""SELECT epoch_us(ts) AS time_us, CASE WHEN u THEN ({SQL_K} % 8)::DOUBLE END AS num_executors,
             CASE WHEN u THEN ({SQL_K} % 4 + 1)::DOUBLE END AS avg_num_task_slots,
             CASE WHEN u THEN {SQL_K} / 100.0::DOUBLE END AS avg_task_slot_utilization,
             CASE WHEN u THEN ({SQL_K} % 3)::DOUBLE END AS queue_size, CASE WHEN NOT u THEN value END AS backlog
           FROM (SELECT *, event_type = 'error' AS u FROM events)
           WHERE event_type IN ('error', 'purchase', 'click') AND day(ts) = 15""")
def eventlog_utilization(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _timed(telemetry.utilization(event_log(spark, sf_dir), "update_15"))


@query(f"""WITH newest AS (SELECT arg_max(day(ts), ts) AS d FROM events WHERE day(ts) <> 30)
           SELECT event_id AS id, epoch_us(ts) AS time_us, {_KIND_SQL} AS event_type FROM events, newest WHERE day(ts) = d""")
def eventlog_latest_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _timed(telemetry.of_latest_cluster(event_log(spark, sf_dir), "orders").select("id", "timestamp", "event_type"))
