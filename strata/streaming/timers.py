"""Time-weighted averages with explicit state: a map entry per piece of an interval, and an event-time timer that closes it.

Unlike the aggregates of `integral`, rows are refused by the rule itself as they arrive, and an interval of a sensor that
has gone silent is closed by a timer. A call to the state store (RocksDB) costs far more than a reading, so the sensors are dealt
to slots, and a slot shares state and timer of an interval. Its open readings lie in a map entry for each piece, read one after the
other when the timer fires.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from strata import session
from strata.streaming.integral import KEYS, OUTPUT

#: Settings under which such a stream has to be started: Spark keeps maps and timers in RocksDB only, its default store refuses them.
SETTINGS = {key: value for key, value in session.RECOMMENDED.items() if ".stateStore." in key}
_MINUTE, _SECOND, _MILLI = 60_000_000, 1_000_000, 1000


def area_until_last(points: np.ndarray, since: int, value: float | None) -> float:
    """Area from `since`, at which `value` holds, to the last of some sorted (time, value) points.

    Whole minutes per step; without `value`, the first one also holds before its time. Times are microseconds.
    """
    times = np.r_[since, points["t"]]
    values = np.r_[points["v"][0] if value is None else value, points["v"][:-1]]
    return float((values * ((times[1:] - times[:-1]) // _MINUTE)).sum())


POINT = np.dtype([("t", "<i8"), ("v", "<f8")])


_READINGS = pa.schema([("location_id", pa.string()), ("sensor", pa.string()), ("at", pa.int64()), ("value", pa.float64())])


def packed(readings: pd.DataFrame, piece: int) -> Iterator[tuple[int, bytes]]:
    """The start of each piece of so many microseconds, and its readings as bytes that may be appended to others."""
    at = readings["at"].to_numpy()
    since = at // piece * piece
    order = np.argsort(since, kind="stable")
    since = since[order]
    keys = [pa.array(readings[c], pa.string()) for c in KEYS]
    batch = pa.record_batch([*keys, pa.array(at), pa.array(readings["value"].to_numpy())], schema=_READINGS).take(pa.array(order))
    cuts = np.r_[0, np.flatnonzero(np.diff(since)) + 1, len(since)]
    for start, end in zip(cuts[:-1], cuts[1:]):
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, _READINGS) as writer:
            writer.write_batch(batch.slice(start, end - start))
        yield int(since[start]), out.getvalue().to_pybytes()


def by_sensor(data: bytes) -> Iterator[tuple[tuple[str | None, str | None], np.ndarray]]:
    """Each location and sensor of packed readings with its sorted points."""
    source, batches = pa.BufferReader(data), []
    while source.tell() < len(data):
        batches += pa.ipc.open_stream(source)
    found = pa.Table.from_batches(batches).combine_chunks()
    points = np.empty(len(found), POINT)
    points["t"], points["v"] = found["at"].to_numpy(), found["value"].to_numpy()
    codes, names = [], []
    for name in KEYS:
        coded = found[name].combine_chunks().dictionary_encode(null_encoding="encode")
        codes.append(coded.indices.to_numpy().astype(np.int64))
        names.append(coded.dictionary.to_pylist())
    key = codes[0] * len(names[1]) + codes[1]
    order = np.lexsort((points["v"], points["t"], key))
    key, points = key[order], points[order]
    cuts = np.r_[0, np.flatnonzero(np.diff(key)) + 1, len(key)]
    for start, end in zip(cuts[:-1], cuts[1:]):
        location, sensor = divmod(int(key[start]), len(names[1]))
        yield (names[0][location], names[1][sensor]), points[start:end]


class IntervalAverage(StatefulProcessor):
    """For a slot of sensors and an interval: one row per sensor, once the watermark has passed its end; later rows are refused."""

    def __init__(self, interval_minutes: int, piece_seconds: int):
        self.width, self.piece = interval_minutes * _MINUTE, piece_seconds * _SECOND

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # Pieces by their start: the readings of all sensors of the slot.
        self.pieces = handle.getMapState("pieces", "since BIGINT", "readings BINARY")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        until = int(key[0])
        if until > timerValues.getCurrentWatermarkInMs() * _MILLI:
            if not self.pieces.exists():
                self.handle.registerTimer(until // _MILLI)
            for part in rows:
                for since, readings in packed(part, self.piece):
                    old = self.pieces.getValue((since,))
                    self.pieces.updateValue((since,), ((bytes(old[0]) if old else b"") + readings,))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        until = expiredTimerInfo.getExpiryTimeInMs() * _MILLI
        start = until - self.width
        # Area, time and value of the last point and number of rows of each sensor.
        sums: dict[tuple, tuple[float, int, float | None, int]] = {}
        for since in range(start, until, self.piece):
            if not (found := self.pieces.getValue((since,))):
                continue
            for sensor, points in by_sensor(bytes(found[0])):
                area, at, value, n = sums.get(sensor, (0.0, start, None, 0))
                sums[sensor] = (area + area_until_last(points, at, value), int(points["t"][-1]), float(points["v"][-1]), n + len(points))
        self.pieces.clear()
        areas = np.array([area + value * ((until - at) // _MINUTE) for area, at, value, _ in sums.values()])
        yield pd.DataFrame({"location_id": [location for location, _ in sums], "sensor": [sensor for _, sensor in sums],
                            "timestamp": pd.Timestamp(until, unit="us"), "value": (areas / (self.width / _MINUTE)).astype(np.float32),
                            "count_rows": np.array([n for *_, n in sums.values()], np.int32)})

    def close(self) -> None:
        pass


def timed_average(readings: DataFrame, interval_minutes: int = 10, delay: str = "10 minutes", piece_seconds: int = 60,
                  slots: int = 64) -> DataFrame:
    """Rows (location_id, sensor, timestamp, value) to one average per closed interval, as `integral.strict_time_weighted_average`.

    A row whose interval's end is at or before the watermark is refused. Start it with `SETTINGS`
    (`runner.append(..., conf=SETTINGS)`), which the library's sessions have. Pieces must divide an interval. The sensors of an interval
    are dealt to `slots` groups, which tasks share; a stream keeps the number it was started with. Null values and times are left out.
    Session time zone UTC.
    """
    if interval_minutes * 60 % piece_seconds:
        raise ValueError("pieces must divide the interval")
    known = readings.where("timestamp IS NOT NULL AND value IS NOT NULL").withWatermark("timestamp", delay)
    at, width = F.unix_micros("timestamp"), F.lit(interval_minutes * _MINUTE)
    until = at - F.pmod(at, width) + width
    rows = known.select(*KEYS, "timestamp", at.alias("at"), F.col("value").cast("double").alias("value"), until.alias("until"),
                        F.pmod(F.xxhash64(*KEYS), F.lit(slots)).alias("slot"))
    return rows.groupBy("until", "slot").transformWithStateInPandas(IntervalAverage(interval_minutes, piece_seconds), OUTPUT, "Append", "EventTime")
