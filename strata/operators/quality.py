"""Declarative row rules: warn, drop, fail and quarantine."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from strata import workspace


@dataclass(frozen=True)
class Rule:
    """A named SQL predicate; `action` is ``warn``, ``drop`` or ``fail``."""

    name: str
    predicate: str
    action: str = "warn"

    def holds(self) -> Column:
        """True or false per row; a predicate that evaluates to null has failed."""
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def _all(rules: list[Rule]) -> Column:
    return reduce(lambda a, b: a & b, [r.holds() for r in rules], F.lit(True))


def expect(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows that may pass on: drop rules filter, fail rules abort the job that writes them.

    Fail rules see every row of `df`, whatever is filtered afterwards, partitions included.
    """
    kept = df
    for rule in (r for r in rules if r.action == "fail"):
        message = F.lit(f"expectation '{rule.name}' failed: {rule.predicate}")
        holds = F.when(rule.holds(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
        # The optimizer moves no later filter below a condition that is not deterministic.
        kept = kept.where((F.spark_partition_id() >= 0) & holds)
    return _dropped(kept, rules)


def _dropped(df: DataFrame, rules: list[Rule]) -> DataFrame:
    # A filter drops rows whose predicate is null by itself; the bare predicates reach the scan.
    for rule in (r for r in rules if r.action == "drop"):
        df = df.where(rule.predicate)
    return df


def observed(df: DataFrame, rules: list[Rule], name: str | Observation) -> DataFrame:
    """`df` with pass and fail counts attached as an observation, for streams and one-pass writes."""
    counters = [c for i, r in enumerate(rules) for c in (
        F.count_if(r.holds()).alias(f"passed_{i}"), F.count_if(~r.holds()).alias(f"failed_{i}"))]
    return df.observe(name, F.count(F.lit(1)).alias("input_rows"), *counters)


@dataclass(frozen=True)
class Count:
    """What a write has seen of one rule."""

    dataset: str
    name: str
    action: str
    passed_records: int
    failed_records: int


def counts_of(seen: dict, rules: list[Rule], dataset: str) -> list[Count]:
    """The values of an observation made by `observed`, by rule."""
    return [Count(dataset, r.name, r.action, seen[f"passed_{i}"], seen[f"failed_{i}"]) for i, r in enumerate(rules)]


class RuleBroken(Exception):
    """A fail rule was broken; `counts` has what the write has seen of all rules."""

    def __init__(self, counts: list[Count]):
        self.counts = counts
        super().__init__(", ".join(f"expectation '{c.name}' failed for {c.failed_records} rows of {c.dataset}"
                                   for c in counts if c.action == "fail" and c.failed_records))


def publish(df: DataFrame, rules: list[Rule], path: str, dataset: str, partition_by: list[str] = ()) -> list[Count]:
    """Write the rows that pass the drop rules as the new folder `path`, count all rules in the same pass.

    The folder appears as a whole, once the counts of the write show that no fail rule was broken; otherwise nothing is left and
    `RuleBroken` has the counts. Rows are counted by the tasks that write them, after any shuffle, so a lost executor does not count twice.
    """
    spark = df.sparkSession
    if workspace.exists(spark, path):
        raise FileExistsError(path)
    seen, staged = Observation(f"rules of {dataset}"), f"{path}.staged-{uuid.uuid4().hex}"
    shaped = df.hint("rebalance", *partition_by) if partition_by else df
    writer = _dropped(observed(shaped, rules, seen), rules).write
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(staged)
    counts = counts_of(seen.get, rules, dataset)
    if any(c.action == "fail" and c.failed_records for c in counts):
        workspace.remove(spark, staged)
        raise RuleBroken(counts)
    workspace.rename(spark, staged, path)
    return counts


def metrics(df: DataFrame, rules: list[Rule], dataset: str) -> DataFrame:
    """One row per rule: name, dataset, passed_records, failed_records; a single aggregation pass."""
    totals = df.agg(*[F.count_if(r.holds()).alias(f"p{i}") for i, r in enumerate(rules)],
                    *[F.count_if(~r.holds()).alias(f"f{i}") for i, r in enumerate(rules)])
    entries = F.array(*[F.struct(F.lit(r.name).alias("name"), F.lit(dataset).alias("dataset"),
                                 F.col(f"p{i}").alias("passed_records"), F.col(f"f{i}").alias("failed_records"))
                        for i, r in enumerate(rules)])
    return totals.select(F.inline(entries))


def flow_metrics(df: DataFrame, rules: list[Rule], dataset: str) -> DataFrame:
    """One row per dataset: rows written and rows dropped under the drop rules."""
    kept = _all([r for r in rules if r.action == "drop"])
    return df.agg(F.count_if(kept).alias("num_output_rows"), F.count_if(~kept).alias("dropped_records")) \
             .withColumn("dataset", F.lit(dataset))


def quarantine(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows that break any rule, with the names of the broken rules in ``failed_rules``."""
    broken = F.array_compact(F.array(*[F.when(~r.holds(), F.lit(r.name)) for r in rules]))
    return df.where(~_all(rules)).withColumn("failed_rules", broken)


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their row counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def orphans(df: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Distinct references without a parent row, with the number of rows that carry them.

    References are counted before the join, so the join sees each value once.
    """
    references = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    return references.join(parent.select(F.col(parent_key).alias(column)), column, "left_anti")
