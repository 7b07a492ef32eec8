import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from strata import workspace
from strata.operators import snapshots
from strata.operators.snapshot_store import SnapshotStore
from strata.sources import snapshot_stream
from strata.sources import snapshots as folders
from strata.streaming import runner

SCHEMA = "id INT, status STRING, note STRING"
STEPS = [[(1, "new", "a"), (2, "new", "b"), (3, "new", "c")],
         [(1, "new", "a2"), (2, "paid", "b"), (4, "new", "d")],
         [(1, "paid", "a3"), (2, "paid", "b"), (3, "new", "c"), (4, "new", "d")],
         [(1, "paid", "a3"), (3, "new", "c"), (4, None, "d")]]
EXPECTED = [(1, "new", "a2", 10, 12), (1, "paid", "a3", 12, None), (2, "new", "b", 10, 11), (2, "paid", "b", 11, 13),
            (3, "new", "c", 10, 11), (3, "new", "c", 12, None), (4, "new", "d", 11, 13), (4, None, "d", 13, None)]


@pytest.fixture
def series(spark):
    return [(spark.createDataFrame(rows, SCHEMA), 10 + i) for i, rows in enumerate(STEPS)]


def test_history_with_tracked_column(series, rows):
    assert rows(snapshots.history(series, ["id"], ["status"])) == sorted(EXPECTED, key=str)


def test_folding_one_at_a_time_gives_the_same(series, rows):
    first, *later = series
    assert rows(snapshots.fold_history(first, later, ["id"], ["status"])) == sorted(EXPECTED, key=str)


def test_all_columns_are_tracked_by_default(series, rows):
    versions = snapshots.history(series[:2], ["id"]).where("id = 1")
    assert rows(versions) == sorted([(1, "new", "a", 10, 11), (1, "new", "a2", 11, None)], key=str)


def test_change_sets_lead_from_one_snapshot_to_the_next(series, rows):
    for (before, _), (after, _) in zip(series, series[1:]):
        changes = snapshots.change_set(before, after, ["id"])
        assert rows(snapshots.apply_change_set(before, changes, ["id"])) == rows(after)
    assert rows(snapshots.change_set(series[0][0], series[0][0], ["id"])) == []


def test_folders_by_hour(spark, rows):
    root = workspace.new_dir(spark, "hours")
    for i, hour in enumerate(["2024-01-01 22", "2024-01-01 23", "2024-01-02 00", "2024-01-02 02"]):
        spark.range(i + 1).write.parquet(f"{root}/{hour}")
    assert folders.latest(spark, root).endswith("/2024-01-02 02")
    frame, version = folders.next_snapshot(spark, root)
    assert version == "2024-01-01 22" and frame.count() == 1
    assert folders.next_snapshot(spark, root, "2024-01-01 23")[1] == "2024-01-02 00"
    assert folders.next_snapshot(spark, root, "2024-01-02 00") is None
    assert folders.next_snapshot(spark, root, "2024-01-02 00", skip_gaps=True)[1] == "2024-01-02 02"
    assert [v for _, v in folders.series(spark, root)] == ["2024-01-01 22", "2024-01-01 23", "2024-01-02 00"]
    assert folders.latest(spark, workspace.new_dir(spark, "none")) is None


@pytest.fixture
def store(spark):
    nulls = [[(None, "null", f"n{i // 2}")] for i in range(4)]
    made = SnapshotStore(spark, workspace.new_dir(spark, "store"), spark.createDataFrame([], SCHEMA).schema, ["id"], buckets=32)
    for i, steps in enumerate(STEPS):
        frame = spark.createDataFrame(steps + nulls[i] + [(n, "same", None) for n in range(100, 300)], SCHEMA)
        made.write(frame.withColumn("more", F.lit(1)), 10 + i)
    return made


NULL_KEY = [(None, "null", "n1", 10, None)]
SAME = [(n, "same", None, 10, None) for n in range(100, 300)]


def test_stored_snapshots_differ_in_few_buckets(spark, store, rows):
    assert store.versions() == ["10", "11", "12", "13"]
    expected = {v: rows(snapshots.change_set(store.read(v), store.read(v + 1), ["id"])) for v in (10, 11, 12)}
    for before in (12, 11, 10):
        some = store.changed(before, before + 1)
        assert 1 <= len(some) <= 5
        plan = store.change_set(before, before + 1)._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"PartitionFilters: \[_bucket#\d+ IN|PartitionFilters: \[isnotnull\(_bucket|PartitionFilters: \[\(_bucket", plan)) == 2
    some = store.changed(12, 13)
    for bucket in set(range(32)) - set(some):  # the rest is not even there
        workspace.remove(spark, f"{store._rows(12)}/_bucket={bucket}")
        workspace.remove(spark, f"{store._rows(13)}/_bucket={bucket}")
    assert rows(store.change_set(12, 13)) == expected[12]
    assert rows(store.change_set(10, 11)) == expected[10]
    assert store.changed(12, 12) == [] and store.change_set(12, 12).collect() == []


def test_histories_from_stored_snapshots(store, rows):
    assert rows(store.history([10, 11, 12, 13], ["status"])) == sorted(EXPECTED + NULL_KEY + SAME, key=str)
    assert rows(store.current([10, 11, 12, 13])) == rows(store.read(13))


def test_null_keys_stay_open(spark, rows):
    """A row with a null key that does not change is neither closed nor opened again."""
    series = [(spark.createDataFrame([(None, "a", "x"), (1, "b", "y")], SCHEMA), v) for v in (1, 2, 3)]
    first, *later = series
    expected = [(1, "b", "y", 1, None), (None, "a", "x", 1, None)]
    assert rows(snapshots.fold_history(first, later, ["id"])) == rows(snapshots.history(series, ["id"])) == expected


def test_digests_notice_what_cancels_out(spark):
    """Swapped nulls, doubled rows and exchanged values: equal counts, and equal xors of hashes."""
    made = SnapshotStore(spark, workspace.new_dir(spark, "digests"), spark.createDataFrame([], SCHEMA).schema, ["id"], buckets=1)
    for version, steps in enumerate([[(1, "a", None)], [(1, None, "a")], [(1, "a", None), (1, "a", None)], [(1, "b", None), (1, "b", None)], []]):
        made.write(spark.createDataFrame(steps, SCHEMA), version)
    assert all(made.changed(a, b) == [0] for a in range(5) for b in range(a))


def test_an_unfinished_snapshot_does_not_count(spark, store):
    store.read(10).withColumn("_bucket", F.lit(0)).write.partitionBy("_bucket").parquet(store._rows(14))
    assert store.versions()[-1] == "13"


def _hour(spark, root, hour, *rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{root}/{hour}")


def _run(spark, root, base, **options):
    """Run the stream over what is there; all rows so far, and the versions handed over in order."""
    handed = []
    feed = snapshot_stream.stream(spark, root, "id INT, status STRING, note STRING, later INT", **options)

    def fold(rows, version):
        handed.append(version)
        rows.withColumn("version", F.lit(version)).write.mode("overwrite").parquet(f"{base}/rows/{version}")

    query = feed.writeStream.option("checkpointLocation", f"{base}/check").foreachBatch(snapshot_stream.in_order(fold)).trigger(availableNow=True).start()
    runner.finish(query)
    return handed


def test_snapshot_stream_waits_at_gaps_and_goes_on(spark, rows):
    root, base = workspace.new_dir(spark, "hourly"), workspace.new_dir(spark, "read")
    _hour(spark, root, "2024-01-01 23", (1, "new", "a"), (2, "new", None))
    _hour(spark, root, "2024-01-02 00", (1, "paid", "a"))
    _hour(spark, root, "2024-01-02 02", (1, "late", "a"))
    workspace.write_text(spark, f"{root}/2024-01-02 01/part-0.parquet", "not complete")
    workspace.write_text(spark, f"{root}/notes/readme", "no hour")
    assert _run(spark, root, base) == ["2024-01-01 23", "2024-01-02 00"]
    assert _run(spark, root, base) == []
    workspace.remove(spark, f"{root}/2024-01-02 01")
    assert _run(spark, root, base) == []
    _hour(spark, root, "2024-01-02 01", (3, "new", "c"))
    assert _run(spark, root, base) == ["2024-01-02 01", "2024-01-02 02"]
    # Folders that were read may go, if the query is told where it was.
    workspace.remove(spark, f"{root}/2024-01-01 23")
    _hour(spark, root, "2024-01-02 03", (4, "new", "d"))
    assert _run(spark, root, base, after="2024-01-02 02") == ["2024-01-02 03"]
    got = spark.read.parquet(f"{base}/rows/*").select("version", "id", "status", "note", "later")
    assert rows(got) == sorted([("2024-01-01 23", 1, "new", "a", None), ("2024-01-01 23", 2, "new", None, None), ("2024-01-02 00", 1, "paid", "a", None),
                                ("2024-01-02 01", 3, "new", "c", None), ("2024-01-02 02", 1, "late", "a", None), ("2024-01-02 03", 4, "new", "d", None)], key=str)


def test_reachable_hours():
    hours = [datetime(2024, 1, 1, h) for h in (3, 4, 6, 7)]
    yes = lambda h: True
    assert snapshot_stream.reachable(hours, None, yes, False) == hours[1]
    assert snapshot_stream.reachable(hours, hours[1], yes, False) == hours[1]
    assert snapshot_stream.reachable(hours, hours[1], yes, True) == hours[3]
    assert snapshot_stream.reachable(hours, None, lambda h: h != hours[2], True) == hours[1]
    assert snapshot_stream.reachable([], None, yes, False) is None
