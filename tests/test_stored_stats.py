import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import workspace
from strata.operators import aggregates
from strata.operators.stored_stats import BUCKET, StoredStats

SCHEMA = "k BIGINT, t STRING, v DECIMAL(18,2)"


@pytest.fixture
def stats(spark):
    return StoredStats(spark, workspace.new_dir(spark, "stats"), T.StructType.fromDDL(SCHEMA), ["k", "t"], "v", buckets=64)


def _rows(spark, since, until):
    return spark.range(since, until).selectExpr("CASE WHEN id % 7 = 0 THEN NULL ELSE id % 50 END AS k", "CAST(id % 2 AS STRING) AS t",
                                                "CASE WHEN id % 11 = 0 THEN NULL ELSE CAST(id AS DECIMAL(18,2)) END AS v", "id AS other")


def _expected(df):
    return aggregates.finish_stats(aggregates.partial_stats(df, ["k", "t"], "v"), ["k", "t"])


def test_appends_add_up(spark, stats, rows):
    assert stats.read().collect() == []
    cuts = [0, 900, 903, 1000]
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        stats.append(_rows(spark, a, b), i)
        assert rows(stats.read()) == rows(_expected(_rows(spark, 0, b)))
    assert stats.append(_rows(spark, 5, 5), 9) == []


def test_an_append_reads_and_replaces_its_own_buckets_only(spark, stats, rows):
    stats.append(_rows(spark, 0, 1000), 0)
    few = _rows(spark, 1001, 1003)
    probe = StoredStats(spark, workspace.new_dir(spark, "probe"), stats.schema, stats.keys, stats.value, stats.buckets)
    some = probe.append(few, 0)
    assert 1 <= len(some) <= 2
    for name in workspace.child_dirs(spark, stats.path):  # other buckets are not even there
        if name.startswith(BUCKET) and int(name.split("=")[1]) not in some:
            workspace.remove(spark, f"{stats.path}/{name}")
    left = rows(stats.read())
    assert stats.append(few, 1) == some
    assert len(rows(stats.read())) == len({r[:2] for r in left} | {(r["k"], r["t"]) for r in few.collect()})
    plan = stats.buckets_of(some)._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [{BUCKET}" in plan


def test_an_append_that_was_cut_off_is_given_again(spark, stats, rows, monkeypatch):
    stats.append(_rows(spark, 0, 500), 0)
    more = _rows(spark, 500, 600)
    some = stats.append(more, 1)
    assert len(some) > 10 and stats.append(more, 1) == []
    # As if the last bucket had not been replaced before the job died.
    half = StoredStats(spark, workspace.new_dir(spark, "half"), stats.schema, stats.keys, stats.value, stats.buckets)
    half.append(_rows(spark, 0, 500), 0)
    left = half.buckets_of([some[-1]]).collect()
    half.append(more, 1)
    old = spark.createDataFrame(left, half.stored)
    old.write.mode("overwrite").partitionBy(BUCKET).option("partitionOverwriteMode", "dynamic").parquet(half.path)
    assert half.append(more, 1) == [some[-1]]
    assert rows(half.read()) == rows(stats.read()) == rows(_expected(_rows(spark, 0, 600)))


def test_reading_needs_no_shuffle(spark, stats):
    stats.append(_rows(spark, 0, 100).withColumn("k", F.col("k") * 3), 0)
    assert "Exchange" not in stats.read()._jdf.queryExecution().executedPlan().toString()
