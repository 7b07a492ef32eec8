"""Counts of row rules, recorded by the very writes of a stream.

`counted` attaches the counts to a stream as an observed aggregate, so they cost no scan of their own. A `RuleCounts` listener takes them
from each finished batch and stores them, one small file a batch, from where `read_counts` reads them as a table. A batch that runs
again after a failure replaces its counts.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from strata import workspace
from strata.operators import quality
from strata.operators.quality import Rule
from strata.streaming import runner

COUNTS = "dataset STRING, batch BIGINT, input_rows BIGINT, name STRING, action STRING, passed_records BIGINT, failed_records BIGINT"


def counted(stream: DataFrame, rules: list[Rule], dataset: str) -> DataFrame:
    """Rows that may pass on, as `quality.expect` has it; all rows are counted under the name `dataset`."""
    return quality.expect(quality.observed(stream, rules, dataset), rules)


class RuleCounts(StreamingQueryListener):
    """Stores the counts of the datasets in `rules` below the folder `path`; other queries of the session are left alone."""

    def __init__(self, spark: SparkSession, path: str, rules: dict[str, list[Rule]]):
        self.spark, self.path, self.rules = spark, path, rules
        self.ended: set[str] = set()
        self.changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        for dataset, seen in progress.observedMetrics.items():
            if dataset in self.rules:
                values = seen.asDict()
                lines = [json.dumps({"batch": progress.batchId, "input_rows": values["input_rows"], **vars(c)})
                         for c in quality.counts_of(values, self.rules[dataset], dataset)]
                workspace.write_text(self.spark, f"{self.path}/{progress.id}-{progress.batchId:012d}-{dataset}.json", "\n".join(lines), replace=True)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def finish(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Wait for a run over available data until its last counts have arrived; an error in the stream is raised here."""
        runner.finish(query)
        with self.changed:
            if not self.changed.wait_for(lambda: str(query.runId) in self.ended, seconds):
                raise TimeoutError("the counts of the last batches have not arrived")


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """One row per batch and rule; batches without rows have none."""
    if not workspace.exists(spark, path):
        return spark.createDataFrame([], COUNTS)
    return spark.read.schema(COUNTS).json(path)


def totals(counts: DataFrame) -> DataFrame:
    """name, dataset, passed_records and failed_records over all batches."""
    return counts.groupBy("name", "dataset").agg(F.sum("passed_records").alias("passed_records"), F.sum("failed_records").alias("failed_records"))
