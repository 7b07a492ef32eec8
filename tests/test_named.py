import uuid

import oracle
import pytest
from pyspark.sql import functions as F

from strata import workspace
from strata.plans import ORACLE, tables
from strata.sources import named
from strata.sources.named import Layout


@pytest.fixture
def name(spark):
    made = f"t_{uuid.uuid4().hex}"
    yield made
    spark.sql(f"DROP TABLE IF EXISTS {made}")


def test_create_append_and_replace_partitions(spark, name, rows):
    first = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id INT, v STRING, p STRING")
    named.create(first, name, workspace.new_dir(spark, "named"), Layout(partition_by=("p",)))
    assert named.layout_of(spark, name) == Layout(partition_by=("p",))
    named.append(spark.createDataFrame([("x", 3)], "p STRING, id LONG"), name)
    assert rows(spark.table(name)) == [(1, "a", "x"), (2, "b", "y"), (3, None, "x")]
    named.replace_partitions(spark.createDataFrame([(9, "n", "x"), (8, "m", "z")], "id INT, v STRING, p STRING"), name)
    assert rows(spark.table(name)) == [(2, "b", "y"), (8, "m", "z"), (9, "n", "x")]
    with pytest.raises(ValueError, match="no columns"):
        named.append(first.withColumn("other", F.lit(1)), name)
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        named.create(first, name)
    assert rows(named.create(first.limit(1), name, workspace.new_dir(spark, "named"), replace=True)) == [(1, "a", "x")]
    with pytest.raises(ValueError, match="no partitions"):
        named.replace_partitions(first, name)


def test_buckets_are_kept_by_appends(spark, name):
    layout = Layout(buckets=4, bucket_by=("id",), sort_by=("id",))
    path = workspace.new_dir(spark, "named")
    named.create(spark.range(100).withColumn("v", F.col("id") * 2), name, path, layout)
    assert named.layout_of(spark, name) == layout
    named.append(spark.range(100, 150).withColumn("v", F.lit(0)), name)
    assert spark.table(name).count() == 150
    assert len(workspace.some_files(spark, path, 99)) == 8  # a file a bucket and write
    assert "Exchange" not in spark.table(name).groupBy("id").count()._jdf.queryExecution().executedPlan().toString()


def test_a_join_by_bucket_needs_no_shuffle(spark, sf_dir):
    plan = tables.bucketed_join(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_buckets_follow_the_rows(spark, sf_dir, monkeypatch):
    """More rows mean more buckets of the same size, on both sides of the join, which still needs no shuffle."""
    assert [named.buckets_for(n) for n in (0, 600_000, 36_000_000, 216_000_000)] == [8, 8, 72, 432]
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    sized = named.buckets_for
    monkeypatch.setattr(named, "buckets_for", lambda rows: sized(rows, each=lines // 20))
    joined = tables.bucketed_join(spark, sf_dir)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    wanted = sized(lines, each=lines // 20)
    assert wanted >= 20 and plan.count(f"SelectedBucketsCount: {wanted} out of {wanted}") == 2 and "Exchange" not in plan
    assert oracle.compare(joined, oracle.connect(sf_dir), ORACLE["bucketed_join"]) is None
