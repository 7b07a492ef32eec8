import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strata.operators import timeseries


def sensor(spark, points):
    return (spark.createDataFrame([("L1", f"2024-01-01 {t}", v) for t, v in points], "k STRING, t STRING, v DOUBLE")
            .select("k", F.col("t").cast("timestamp").alias("ts"), "v"))


@pytest.mark.parametrize("heavy_rows", [10**6, 1])
def test_worked_example(spark, heavy_rows):
    points = [("12:14:00", 40.0), ("12:11:00", 10.0), ("12:19:00", 30.0), ("12:12:00", 20.0)]
    found = timeseries.time_weighted_average(sensor(spark, points), ["k"], "ts", "v", 10, heavy_rows=heavy_rows).collect()
    assert [(r.value, r.count_rows, str(r.timestamp)) for r in found] == [(29.0, 4, "2024-01-01 12:20:00")]


def test_whole_minutes_unless_exact(spark):
    points = [("12:00:30", 10.0), ("12:05:15", 20.0)]
    whole = timeseries.time_weighted_average(sensor(spark, points), ["k"], "ts", "v", 10).first()
    exact = timeseries.time_weighted_average(sensor(spark, points), ["k"], "ts", "v", 10, exact=True).first()
    assert whole.value == pytest.approx((10 * 0 + 10 * 4 + 20 * 4) / 10)
    assert exact.value == pytest.approx((10 * 5.25 + 20 * 4.75) / 10)


@pytest.mark.parametrize("step", [2, 10])
def test_resample_equals_pandas(spark, step):
    rng = np.random.default_rng(5)
    start = pd.Timestamp("2024-01-01 23:58:00")
    frame = pd.DataFrame({"k": rng.choice(["a", "b"], 60), "v": rng.integers(1, 50, 60).astype(float),
                          "ts": [start + pd.Timedelta(seconds=float(s)) for s in rng.uniform(0, 300, 60)]})
    data = spark.createDataFrame(frame)
    expected = frame.set_index("ts").groupby("k").resample(f"{step}s")["v"].max().fillna(0)
    expected = {(k, int(t.timestamp())): v for (k, t), v in expected.items()}
    assert {(r.k, r.bin): r.value for r in timeseries.resample_max(data, "k", "ts", "v", step).collect()} == expected


def test_pivot_keeps_the_newest_bins(spark, rows):
    bins = spark.createDataFrame([("a", 0, 1.0), ("a", 2, 2.0), ("b", 2, 3.0), ("b", 4, 4.0)], "k STRING, bin INT, value DOUBLE")
    assert rows(timeseries.pivot_latest(bins, "k", 2)) == sorted([("a", 2.0, None), ("b", 3.0, 4.0)], key=str)


def test_latest_per_key_keeps_ties(spark, rows):
    data = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("a", 2, 3), ("b", 9, 4)], "k STRING, s INT, n INT")
    assert rows(timeseries.latest_per_key(data, ["k"], "s").select("n")) == [(2,), (3,), (4,)]
    assert rows(timeseries.latest_per_key(data, ["k"], "s", F.col("s") < 2).select("n")) == [(1,)]


@pytest.mark.parametrize("step", [1, 7, 21_600, 100_000])
def test_resample_at_any_step(spark, step):
    start = 1_700_000_123
    at = [start + i * step // 2 for i in (0, 1, 2, 9, 10, 30)]
    readings = spark.createDataFrame([("k", s, float(i + 1)) for i, s in enumerate(at)], "k STRING, s BIGINT, v DOUBLE")
    readings = readings.withColumn("ts", F.timestamp_seconds("s"))
    expected = {b: 0.0 for b in range(at[0] // step * step, at[-1] + 1, step)}
    for i, s in enumerate(at):
        expected[s // step * step] = max(expected[s // step * step], i + 1.0)
    assert {r.bin: r.value for r in timeseries.resample_max(readings, "k", "ts", "v", step).collect()} == expected
