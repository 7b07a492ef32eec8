import pytest
from pyspark.errors import PySparkException

from strata import workspace
from strata.operators import quality
from strata.operators.quality import Rule
from strata.streaming import rules as stream_rules
from strata.streaming import runner


@pytest.fixture
def data(spark):
    return spark.createDataFrame([(1, "a"), (None, "b"), (-3, None), (4, "d")], "n INT, s STRING")


def test_a_null_predicate_fails(data, rows):
    assert rows(quality.expect(data, [Rule("positive", "n > 0", "drop")])) == [(1, "a"), (4, "d")]
    assert rows(quality.expect(data, [Rule("positive", "n > 0")])) == rows(data)


def test_metrics_and_quarantine(data, rows):
    rules = [Rule("positive", "n > 0", "drop"), Rule("named", "s IS NOT NULL", "drop")]
    assert rows(quality.metrics(data, rules, "t")) == [("named", "t", 3, 1), ("positive", "t", 2, 2)]
    assert rows(quality.flow_metrics(data, rules, "t")) == [(2, 2, "t")]
    assert rows(quality.quarantine(data, rules)) == sorted(
        [(None, "b", ["positive"]), (-3, None, ["positive", "named"])], key=str)


def test_a_failing_rule_aborts_the_write(spark, data):
    path = workspace.new_dir(spark, "failing")
    with pytest.raises(PySparkException, match="expectation 'positive' failed"):
        quality.expect(data, [Rule("positive", "n > 0", "fail")]).write.parquet(path)
    assert not workspace.committed(spark, path)
    assert not workspace.some_files(spark, path, 1)


def test_no_later_filter_comes_before_a_fail_rule(spark):
    """Not even one on the partition column, which would leave files unread."""
    path = workspace.new_dir(spark, "parts")
    spark.range(10).selectExpr("id", "id % 2 AS p").write.partitionBy("p").parquet(path)
    kept = quality.expect(spark.read.schema("id BIGINT, p BIGINT").parquet(path), [Rule("odd", "id % 2 = 1", "fail"), Rule("some", "id > 3", "drop")])
    for later in ("p = 1", "id = 5", "p = 1 AND id = 5"):
        with pytest.raises(PySparkException, match="expectation 'odd' failed"):
            kept.where(later).select("p").write.format("noop").mode("overwrite").save()
    joined = kept.join(spark.createDataFrame([(1,)], "p BIGINT"), "p")
    with pytest.raises(PySparkException, match="expectation 'odd' failed"):
        joined.write.format("noop").mode("overwrite").save()


def test_publish_counts_in_the_write(spark, data, rows):
    path = workspace.new_dir(spark, "published")
    rules = [Rule("positive", "n > 0", "drop"), Rule("named", "s IS NOT NULL"), Rule("small", "coalesce(n, 0) < 100", "fail")]
    counts = quality.publish(data, rules, path, "t", partition_by=["s"])
    assert [(c.name, c.passed_records, c.failed_records) for c in counts] == [("positive", 2, 2), ("named", 3, 1), ("small", 4, 0)]
    assert rows(spark.read.schema("n INT, s STRING").parquet(path)) == [(1, "a"), (4, "d")]
    with pytest.raises(FileExistsError):
        quality.publish(data, rules, path, "t")


def test_nothing_is_published_when_a_fail_rule_broke(spark, data):
    folder = workspace.new_dir(spark, "broken")
    with pytest.raises(quality.RuleBroken, match="expectation 'positive' failed for 2 rows of t") as broken:
        quality.publish(data, [Rule("positive", "n > 0", "fail"), Rule("named", "s IS NOT NULL", "drop")], f"{folder}/table", "t")
    assert [(c.passed_records, c.failed_records) for c in broken.value.counts] == [(2, 2), (3, 1)]
    assert workspace.child_dirs(spark, folder) == []
    empty = data.where("n > 100")
    assert [c.passed_records for c in quality.publish(empty, [Rule("r", "n > 0", "fail")], f"{folder}/table", "t")] == [0]


def test_a_stream_records_the_counts_of_its_batches(spark, tmp_path):
    source, base = str(tmp_path / "in"), str(tmp_path / "out")
    rules = [Rule("positive", "n > 0", "drop"), Rule("named", "s IS NOT NULL")]
    listener = stream_rules.RuleCounts(spark, f"{base}/counts", {"t": rules})
    assert stream_rules.read_counts(spark, f"{base}/counts").collect() == []
    spark.streams.addListener(listener)
    try:
        for part in ([(1, "a"), (-1, None)], [(2, None)], []):
            spark.createDataFrame(part, "n INT, s STRING").coalesce(1).write.mode("append").parquet(source)
            feed = spark.readStream.schema("n INT, s STRING").parquet(source)
            listener.finish(runner.append(stream_rules.counted(feed, rules, "t"), f"{base}/table", f"{base}/check"))
    finally:
        spark.streams.removeListener(listener)
    counts = stream_rules.read_counts(spark, f"{base}/counts")
    got = sorted((r.batch, r.input_rows, r.name, r.passed_records, r.failed_records) for r in counts.collect() if r.input_rows)
    assert got == [(0, 2, "named", 1, 1), (0, 2, "positive", 1, 1), (1, 1, "named", 0, 1), (1, 1, "positive", 1, 0)]
    assert sorted((r.name, r.passed_records, r.failed_records) for r in stream_rules.totals(counts).collect()) == [("named", 1, 2), ("positive", 2, 1)]
    assert spark.read.parquet(f"{base}/table").count() == 2


def test_a_broken_fail_rule_stops_a_stream_before_its_batch_is_seen(spark, tmp_path):
    source, base = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(1, "a"), (-1, None)], "n INT, s STRING").write.parquet(source)
    feed = stream_rules.counted(spark.readStream.schema("n INT, s STRING").parquet(source), [Rule("positive", "n > 0", "fail")], "t")
    with pytest.raises(PySparkException, match="expectation 'positive' failed"):
        runner.finish(runner.append(feed, f"{base}/table", f"{base}/check"))
    assert spark.read.schema("n INT").parquet(f"{base}/table").count() == 0


def test_observed_counts_come_with_the_write(spark, data):
    from pyspark.sql import Observation

    seen = Observation("rules")
    rules = [Rule("positive", "n > 0"), Rule("named", "s IS NOT NULL")]
    quality.observed(data, rules, seen).write.format("noop").mode("overwrite").save()
    assert seen.get == {"input_rows": 4, "passed_0": 2, "failed_0": 2, "passed_1": 3, "failed_1": 1}


def test_constraints(spark, rows):
    child = spark.createDataFrame([(1, 7), (1, 8), (2, None), (3, 8)], "k INT, p INT")
    parent = spark.createDataFrame([(7,)], "id INT")
    assert rows(quality.key_violations(child, ["k"])) == [(1, 2)]
    assert rows(quality.orphans(child, "p", parent, "id")) == [(8, 2)]
