"""The plans the design relies on: number of shuffles, map-side combining, filters in the scan."""

import pytest
from pyspark.sql import functions as F

from strata import workspace
from strata.plans import QUERIES
from strata.tables import table


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name, shuffles", [
    ("cdc_scd1", 1), ("cdc_scd2", 1), ("snapshot_scd2", 1), ("time_weighted_average", 1), ("c360_join_as_of", 1),
    ("customer_agg", 1), ("lineage_latest", 1), ("dedup_subset", 1), ("expectation_metrics", 1), ("quarantine", 0),
    ("loan_clean", 0), ("unpack_posexplode", 0), ("eventlog_expectations", 0)])
def test_shuffles(spark, sf_dir, name, shuffles):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert plan.count(" Exchange ") == shuffles, plan


@pytest.mark.parametrize("name", ["cdc_scd1", "customer_agg", "top_pages", "word_freq", "daily_sales_snapshot"])
def test_aggregates_combine_before_the_shuffle(spark, sf_dir, name):
    assert "partial_" in plan_of(QUERIES[name](spark, sf_dir))


def test_the_calendar_join_does_not_shuffle_sales_by_day(spark, sf_dir):
    plan = plan_of(QUERIES["daily_sales_snapshot"](spark, sf_dir))
    assert "RightOuter" not in plan
    keys = [line for line in plan.splitlines() if "hashpartitioning(receipt_date_key" in line]
    assert keys and all("customer_key" in line and "part_key" in line for line in keys)


def test_top_k_does_not_sort_everything(spark, sf_dir):
    for name in ("top_pages", "top_referrers", "top_scored", "word_freq"):
        assert "TakeOrderedAndProject" in plan_of(QUERIES[name](spark, sf_dir))


def test_the_newest_value_reaches_the_scan(spark, sf_dir):
    plan = plan_of(QUERIES["eventlog_latest_cluster"](spark, sf_dir))
    assert "Subquery" in plan and "Join" not in plan


def test_materialized_tables_have_no_lineage(spark):
    stored = workspace.materialize(spark.range(10).withColumn("x", F.col("id") * 2), "lineage")
    assert "Range" not in plan_of(stored) and stored.count() == 10
