"""Audit-log pipeline: raw JSON with hinted types, cleaned and deduplicated, one table per service.

Events play audit records; their types are the services. Purchases are delivered twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import workspace
from strata.operators import quality
from strata.plans.ingest import K, SQL_K
from strata.plans.registry import query
from strata.sources import files, sinks
from strata.streaming import runner, windows
from strata.tables import table

SINCE = "2024-01-10"
BRONZE = [quality.Rule("action_name", "action_name IS NOT NULL", "drop")]
SILVER = [quality.Rule("date", f"date > DATE '{SINCE}'", "drop")]


def landed(spark: SparkSession, sf_dir: str) -> str:
    """Raw audit files: nested identity, free-form parameters, epoch milliseconds."""
    events = table(spark, sf_dir, "events")
    repeated = events.unionAll(events.where("event_type = 'purchase'"))
    records = repeated.withColumn("k", F.expr(K)).select(
        "event_id", F.unix_millis("ts").alias("timestamp"), F.col("event_type").alias("service_name"),
        F.when(F.col("k") >= 10, F.concat(F.lit("action_"), F.col("k") % 3)).alias("action_name"),
        F.struct("k").alias("request_params"),
        F.struct(F.concat("user_id", F.lit("@example.com")).alias("email")).alias("user_identity"))
    return sinks.write(records, workspace.new_dir(spark, "audit-landing"), fmt="json")


def silver(bronze: DataFrame) -> DataFrame:
    """Typed times and e-mail, without the nested identity, each record once."""
    rows = quality.expect(bronze, BRONZE)
    timed = rows.withColumns({"email": F.col("user_identity.email"), "date_time": F.timestamp_millis("timestamp")}) \
                .withColumn("date", F.to_date("date_time")).drop("user_identity", "timestamp")
    return windows.dedup(quality.expect(timed, SILVER), "date_time", "1 day")


_SQL = f"""SELECT event_id, event_type AS service_name, 'action_' || {SQL_K} % 3 AS action_name, '{{"k":' || {SQL_K} || '}}' AS request_params,
             user_id || '@example.com' AS email, epoch_us(ts) // 1000 AS date_ms, strftime(ts, '%Y-%m-%d') AS date
           FROM events WHERE {SQL_K} >= 10 AND CAST(ts AS DATE) > DATE '{SINCE}'"""


def _shown(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"date_ms": F.unix_millis("date_time"), "date": F.col("date").cast("string")}).drop("date_time")


def _silver_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = landed(spark, sf_dir)
    schema = files.sample_schema(spark, path, "json", hints="request_params STRING, action_name STRING")
    return runner.appended(silver(files.stream(spark, path, "json", schema)), "audit-silver", partition_by=["date"])


@query(_SQL)
def audit_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_silver_table(spark, sf_dir))


@query(f"SELECT service_name, date, COUNT(*) AS records FROM ({_SQL}) GROUP BY service_name, date")
def audit_gold_by_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All service tables written in one pass over silver, then counted per service and day."""
    rows = _silver_table(spark, sf_dir)
    path = sinks.write(rows, workspace.new_dir(spark, "audit-gold"), partition_by=["service_name", "date"])
    return (spark.read.schema(rows.schema).parquet(path).groupBy("service_name", F.col("date").cast("string").alias("date"))
            .agg(F.count(F.lit(1)).alias("records")))
