import numpy as np
import oracle
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from strata import session, workspace
from strata.operators import cdc, quality
from strata.plans import ORACLE, sensors
from strata.sources import files
from strata.streaming import changes, integral, runner, timers, windows
from strata.streaming.changes import ChangeTable

READING = "location_id STRING, sensor STRING, timestamp TIMESTAMP, value FLOAT"


def at(clock):
    return f"2024-01-01 {clock}:00"


# The worked example of readings and the averages it must give.
RUNBOOK = [
    [("L1", "Wind_Speed", "12:11", 10.0), ("L1", "Wind_Speed", "12:12", 20.0)],
    [("L1", "Wind_Speed", "12:14", 40.0), ("L1", "Wind_Speed", "12:19", 30.0), ("L1", "Wind_Speed", "12:40", 1.0)],
    [("L1", "Wind_Speed", "12:18", 35.0), ("L1", "Wind_Speed", "12:41", 6.0), ("L2", "Oil_Temp", "12:48", 110.0),
     ("L2", "Oil_Temp", "12:41", 100.0), ("L2", "Oil_Temp", "12:45", 95.0), ("L3", "Humidity", "12:50", 32.5),
     ("L3", "Wind_Speed", "13:30", 50.0)],
]
CLOSED = [[], [("L1", "Wind_Speed", "12:20", 29.0, 4)],
          [("L1", "Wind_Speed", "12:20", 29.0, 4), ("L1", "Wind_Speed", "12:50", 5.5, 2), ("L2", "Oil_Temp", "12:50", 100.5, 3),
           ("L3", "Humidity", "13:00", 32.5, 1)]]
LATE = [[("k", "s", "12:11", 1.0)], [("x", "s", "12:25", 1.0)], [("k", "s", "12:15", 1.0)], [("x", "s", "12:35", 1.0)],
        [("x", "s", "13:30", 1.0)]]


def feed_batches(spark, batches, average):
    """Append each batch of readings, run the stream over what is new, and list what it has emitted."""
    base, emitted = workspace.new_dir(spark, "integral"), []
    for batch in batches:
        (spark.createDataFrame([(a, b, at(t), v) for a, b, t, v in batch], "l STRING, s STRING, t STRING, v DOUBLE")
         .select(F.col("l").alias("location_id"), F.col("s").alias("sensor"), F.col("t").cast("timestamp").alias("timestamp"),
                 F.col("v").cast("float").alias("value")).coalesce(1).write.mode("append").parquet(f"{base}/in"))
        source = files.stream(spark, f"{base}/in", "parquet", READING)
        runner.finish(runner.append(average(source), f"{base}/out", f"{base}/checkpoint"))
        out = spark.read.schema(integral.OUTPUT).parquet(f"{base}/out")
        emitted.append(sorted(tuple(r) for r in out.withColumn("timestamp", F.date_format("timestamp", "HH:mm")).collect()))
    return emitted


@pytest.mark.parametrize("average", [integral.time_weighted_average, integral.strict_time_weighted_average, timers.timed_average])
def test_runbook(spark, average):
    assert feed_batches(spark, RUNBOOK, average) == CLOSED


@pytest.mark.parametrize("average, rows, early", [(integral.time_weighted_average, 2, 0), (integral.strict_time_weighted_average, 1, 1), (timers.timed_average, 1, 0)])
def test_lateness(spark, average, rows, early):
    """The strict forms refuse the late row; the aggregate emits as soon as the watermark is at the interval's end, the timer once it is past."""
    emitted = feed_batches(spark, LATE, average)
    assert emitted[2] == emitted[3][:early]
    assert emitted[3][:1] == [("k", "s", "12:20", 1.0, rows)]
    assert emitted[4][:3] == [("k", "s", "12:20", 1.0, rows), ("x", "s", "12:30", 1.0, 1), ("x", "s", "12:40", 1.0, 1)]


def test_timers_in_a_session_without_the_recommended_settings(spark):
    """A session's default state store refuses timers; the stream brings its own setting and leaves the session's alone."""
    key = "spark.sql.streaming.stateStore.providerClass"
    default = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    with session.settings(spark, {key: default}):
        out = sensors.stream_timer_average(spark, SF_DIR)
        assert spark.conf.get(key) == default
    assert oracle.compare(out, oracle.connect(SF_DIR), ORACLE["stream_timer_average"]) is None


def test_area_over_pieces_equals_the_area_of_all():
    points = np.array([(90_000_000, 2.0), (150_000_000, 5.0), (200_000_000, 1.0), (420_000_000, 4.0)], timers.POINT)
    whole = timers.area_until_last(points, 0, None)
    assert whole == 2.0 * 1 + 2.0 * 1 + 5.0 * 0 + 1.0 * 3
    first, rest = points[:2], points[2:]
    assert timers.area_until_last(first, 0, None) + timers.area_until_last(rest, int(first["t"][-1]), float(first["v"][-1])) == whole


def test_packed_readings_of_a_slot_of_sensors():
    """Appended packs give each sensor's sorted points, also of sensors without a name; a value may be no number."""
    first = pd.DataFrame({"location_id": ["b", None, "b"], "sensor": ["s", "s", None], "at": [70, 10, 20], "value": [1.0, float("nan"), 3.0]})
    second = pd.DataFrame({"location_id": ["b", "a"], "sensor": ["s", "s"], "at": [65, 5], "value": [4.0, 5.0]})
    pieces = [dict(timers.packed(part, 60)) for part in (first, second)]
    assert [sorted(p) for p in pieces] == [[0, 60], [0, 60]]
    whole = {since: {k: [tuple(x) for x in p.tolist()] for k, p in timers.by_sensor(pieces[0][since] + pieces[1][since])} for since in (0, 60)}
    assert whole[60] == {("b", "s"): [(65, 4.0), (70, 1.0)]}
    assert repr(whole[0].pop((None, "s"))) == "[(10, nan)]" and whole[0] == {("b", None): [(20, 3.0)], ("a", "s"): [(5, 5.0)]}


def test_sensors_share_a_slot(spark):
    """One timer closes an interval for all sensors of a slot, with the same averages; the state is called once a slot, not once a sensor."""
    def average(readings):
        return timers.timed_average(readings, slots=1)

    assert feed_batches(spark, RUNBOOK, average) == CLOSED


CHANGE = "id INT, seq INT, op STRING, v STRING"
BATCHES = [[(1, 1, "U", "a"), (2, 1, "U", "b"), (1, 4, "U", "d")], [(2, 3, "D", "b"), (1, 2, "U", "z"), (3, 1, "U", "c")],
           [(2, 2, "U", "late"), (3, 5, "D", None)], [(3, 6, "U", "again"), (1, 3, "U", "y")]]


@pytest.mark.parametrize("scd_type", [1, 2])
def test_change_table(spark, rows, scd_type):
    """Out-of-order batches, a repeated batch and compaction all leave the batch result."""
    target = ChangeTable(spark, workspace.new_dir(spark, "changes"), spark.createDataFrame([], CHANGE).schema, ["id"], "seq",
                         "op = 'D'", ["op"], scd_type)
    assert rows(target.read()) == []
    seen = []
    for i, batch in enumerate(BATCHES):
        seen += batch
        frame = spark.createDataFrame(batch, CHANGE)
        target.fold(frame, i)
        target.fold(frame, i)
        if i == 2:
            target.compact()
            target.compact()
        expected = cdc.apply_changes(spark.createDataFrame(seen, CHANGE), ["id"], "seq", "op = 'D'", ["op"], scd_type)
        assert rows(target.read().select(*expected.columns)) == rows(expected)
    assert target._base() == 2
    target.compact()
    assert target._base() == 3
    assert rows(target.read().select(*expected.columns)) == rows(expected)


def test_a_batch_that_was_not_finished_is_not_seen(spark, rows):
    target = ChangeTable(spark, workspace.new_dir(spark, "changes"), spark.createDataFrame([], CHANGE).schema, ["id"], "seq")
    target.fold(spark.createDataFrame(BATCHES[0], CHANGE), 0)
    before = rows(target.read())
    # What a job leaves that died while it wrote the next batch.
    cut = spark.createDataFrame(BATCHES[1], CHANGE).withColumn("_deleted", F.lit(False))
    cut.write.parquet(f"{target.path}/staged/cut-off")
    assert rows(target.read()) == before
    target.fold(spark.createDataFrame(BATCHES[1], CHANGE), 1)
    assert rows(target.read()) == rows(cdc.apply_changes(spark.createDataFrame(BATCHES[0] + BATCHES[1], CHANGE), ["id"], "seq"))


def test_change_table_as_a_stream_over_growing_files(spark, rows):
    base = workspace.new_dir(spark, "feed")
    schema = spark.createDataFrame([], CHANGE).schema
    target = ChangeTable(spark, f"{base}/table", schema, ["id"], "seq", "op = 'D'", ["op"])
    for batch in BATCHES:
        spark.createDataFrame(batch, CHANGE).write.mode("append").json(f"{base}/in")
        runner.finish(target.run(files.stream(spark, f"{base}/in", "json", schema), f"{base}/checkpoint"))
    assert rows(target.read().select("id", "v")) == [(1, "d"), (3, "again")]


def test_each_file_is_read_once(spark):
    base = workspace.new_dir(spark, "once")
    for n in (3, 4):
        spark.range(n).write.mode("append").parquet(f"{base}/in")
        source = files.stream(spark, f"{base}/in", "parquet", "id BIGINT")
        runner.finish(runner.append(source, f"{base}/out", f"{base}/checkpoint"))
    source = files.stream(spark, f"{base}/in", "parquet", "id BIGINT")
    runner.finish(runner.append(source, f"{base}/out", f"{base}/checkpoint"))
    assert spark.read.parquet(f"{base}/out").count() == 7
    # A refresh is a new checkpoint and a new target.
    runner.finish(runner.append(source, f"{base}/out2", f"{base}/checkpoint2"))
    assert spark.read.parquet(f"{base}/out2").count() == 7


def test_upserted_groups_hold_their_newest_state(spark, rows):
    base = workspace.new_dir(spark, "upsert")
    schema = "k STRING, v INT"
    for batch in ([("a", 1), ("b", 2)], [("a", 5)], [("c", 1), ("b", 1)]):
        spark.createDataFrame(batch, schema).write.mode("append").parquet(f"{base}/in")
        best = files.stream(spark, f"{base}/in", "parquet", schema).groupBy("k").agg(F.max("v").alias("best"))
        runner.finish(changes.upsert(best, ["k"], f"{base}/table", f"{base}/checkpoint", compact_every=2))
    table = changes.aggregate_table(best, ["k"], f"{base}/table")
    assert rows(table.read()) == [("a", 5), ("b", 2), ("c", 1)]
    assert table._base() == 1


def test_complete_mode_publishes_sorted_newest_windows(spark, rows):
    base = workspace.new_dir(spark, "complete")
    schema = "ts TIMESTAMP, v INT"
    for clocks in (["12:00", "12:01"], ["12:05", "12:00"]):
        (spark.createDataFrame([(at(c),) for c in clocks], "t STRING").select(F.col("t").cast("timestamp").alias("ts"), F.lit(1).alias("v"))
         .write.mode("append").parquet(f"{base}/in"))
        counted = windows.tumbling(files.stream(spark, f"{base}/in", "parquet", schema), "ts", "1 minute", [F.sum("v").alias("n")])
        runner.finish(runner.replace(windows.newest_windows(counted, 2), f"{base}/out", f"{base}/checkpoint"))
    newest = runner.latest_version(spark, f"{base}/out").select(F.date_format("window.start", "HH:mm"), "n")
    assert rows(newest) == [("12:01", 1), ("12:05", 1)]


def test_failing_rule_stops_the_stream(spark):
    base = workspace.new_dir(spark, "failing-stream")
    spark.createDataFrame([(1,), (-1,)], "n INT").write.parquet(f"{base}/in")
    source = quality.expect(files.stream(spark, f"{base}/in", "parquet", "n INT"), [quality.Rule("positive", "n > 0", "fail")])
    with pytest.raises(Exception, match="positive"):
        runner.finish(runner.append(source, f"{base}/out", f"{base}/checkpoint"))
    assert not [f for f in workspace.some_files(spark, base, 99) if "/out/" in f and f.endswith(".parquet") and "_spark" in f]


def test_rule_counts_of_a_stream(spark):
    base = workspace.new_dir(spark, "observed")
    spark.createDataFrame([(1,), (-1,), (None,)], "n INT").write.parquet(f"{base}/in")
    source = quality.observed(files.stream(spark, f"{base}/in", "parquet", "n INT"), [quality.Rule("positive", "n > 0")], "rules")
    query = runner.append(source, f"{base}/out", f"{base}/checkpoint")
    runner.finish(query)
    counts = [p.observedMetrics["rules"] for p in query.recentProgress if "rules" in p.observedMetrics]
    assert sum(c["passed_0"] for c in counts) == 1 and sum(c["failed_0"] for c in counts) == 2


def test_dedup_over_batches(spark):
    base = workspace.new_dir(spark, "dedup")
    schema = "k INT, ts TIMESTAMP"
    for keys in ([1, 2, 2], [2, 3]):
        (spark.createDataFrame([(k, at("12:00")) for k in keys], "k INT, t STRING")
         .select("k", F.col("t").cast("timestamp").alias("ts")).write.mode("append").parquet(f"{base}/in"))
        source = windows.dedup(files.stream(spark, f"{base}/in", "parquet", schema), "ts", "1 day")
        runner.finish(runner.append(source, f"{base}/out", f"{base}/checkpoint"))
    assert sorted(r.k for r in spark.read.parquet(f"{base}/out").collect()) == [1, 2, 3]
