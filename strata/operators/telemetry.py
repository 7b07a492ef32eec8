"""Queries over a pipeline event log: rows with origin, event_type and JSON ``details``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Layout of the details document.
PROGRESS = ("flow_progress STRUCT<status: STRING, metrics: STRUCT<num_output_rows: BIGINT, backlog_bytes: DOUBLE>, "
            "data_quality: STRUCT<dropped_records: BIGINT, expectations: ARRAY<STRUCT<name: STRING, dataset: STRING, "
            "passed_records: BIGINT, failed_records: BIGINT>>>>")
DEFINITION = ("flow_definition STRUCT<output_dataset: STRING, input_datasets: ARRAY<STRING>, flow_type: STRING, "
              "`schema`: STRING, explain_text: STRING>")


def raw_events(log: DataFrame) -> DataFrame:
    return log.select("id", "timestamp", "event_type", "message", "level", "details").orderBy("timestamp")


def expectations(log: DataFrame, completed_only: bool = True) -> DataFrame:
    """One row per rule result.

    The event type filter comes first, so other documents are never parsed. The status is
    tested inside the generator: as a filter it would be pushed down and parse them twice.
    """
    parsed = (log.where("event_type = 'flow_progress'")
              .select("id", "timestamp", F.from_json("details", PROGRESS)["flow_progress"].alias("p")))
    results = F.col("p.data_quality.expectations")
    if completed_only:
        results = F.when(F.col("p.status") == "COMPLETED", results)
    return parsed.select("id", "timestamp", F.col("p.metrics.num_output_rows").alias("output_records"),
                         F.col("p.data_quality.dropped_records").alias("dropped_records"),
                         F.col("p.status").alias("status_update"), F.inline(results))


def rule_totals(found: DataFrame) -> DataFrame:
    return found.groupBy("name").agg(F.sum("passed_records").alias("passed_records"),
                                     F.sum("failed_records").alias("failed_records"))


def lineage(log: DataFrame) -> DataFrame:
    """The newest definition of every output dataset.

    One aggregation instead of joining the log back to its own maxima; of definitions with
    equal times, one is kept.
    """
    defined = (log.where("event_type = 'flow_definition'")
               .select("timestamp", F.from_json("details", DEFINITION)["flow_definition"].alias("d"))
               .where("d.output_dataset IS NOT NULL"))
    newest = F.max(F.struct("timestamp", "d")).alias("_newest")
    return (defined.groupBy(F.col("d.output_dataset").alias("output_dataset")).agg(newest)
            .select("output_dataset", F.col("_newest.timestamp").alias("max_timestamp"), "_newest.d.input_datasets",
                    "_newest.d.flow_type", "_newest.d.schema", "_newest.d.explain_text"))


def runtime_version(log: DataFrame) -> DataFrame:
    """Version recorded by the first update."""
    version = F.get_json_object("details", "$.create_update.runtime_version.dbr_version")
    return log.where("event_type = 'create_update'").orderBy("timestamp").limit(1).select(version.alias("runtime_version"))


def utilization(log: DataFrame, update_id: str) -> DataFrame:
    """Cluster and backlog measurements of one update over time."""
    def number(path: str) -> Column:
        return F.get_json_object("details", path).try_cast("double")

    # Measurement paths.
    paths = {"num_executors": "$.cluster_utilization.num_executors",
             "avg_num_task_slots": "$.cluster_utilization.avg_num_task_slots",
             "avg_task_slot_utilization": "$.cluster_utilization.avg_task_slot_utilization",
             "queue_size": "$.cluster_utilization.avg_num_queued_tasks",
             "backlog": "$.flow_progress.metrics.backlog_bytes"}
    return (log.where(F.col("event_type").isin("cluster_utilization", "flow_progress") & (F.col("origin.update_id") == update_id))
            .select("timestamp", *[number(p).alias(n) for n, p in paths.items()]).orderBy("timestamp"))


def of_latest_cluster(log: DataFrame, pipeline: str) -> DataFrame:
    """Events of the cluster that ran the pipeline last, maintenance runs aside."""
    runs = log.where((F.col("origin.pipeline_name") == pipeline) & F.col("origin.maintenance_id").isNull())
    newest = runs.agg(F.max_by("origin.cluster_id", "timestamp").alias("cluster_id"))
    return log.where(F.col("origin.cluster_id") == newest.scalar())
