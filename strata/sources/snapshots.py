"""Snapshot folders named by hour, ``<root>/yyyy-MM-dd HH``."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from strata import workspace

HOUR_FORMAT = "%Y-%m-%d %H"  # fixed value: the folder name pattern


def _hours(spark: SparkSession, root: str) -> list[str]:
    return sorted(workspace.child_dirs(spark, root), key=lambda name: datetime.strptime(name, HOUR_FORMAT))


def latest(spark: SparkSession, root: str) -> str | None:
    """Path of the newest snapshot."""
    hours = _hours(spark, root)
    return f"{root}/{hours[-1]}" if hours else None


def next_snapshot(spark: SparkSession, root: str, last: str | None = None,
                  skip_gaps: bool = False) -> tuple[DataFrame, str] | None:
    """The snapshot after version `last` (the earliest when None), or None when there is none yet.

    A missing hour stops the series, so a late snapshot is waited for; with `skip_gaps`
    the next one present is taken.
    """
    hours = _hours(spark, root)
    if last is None:
        candidates = hours[:1]
    elif skip_gaps:
        candidates = [h for h in hours if h > last][:1]
    else:
        due = (datetime.strptime(last, HOUR_FORMAT) + timedelta(hours=1)).strftime(HOUR_FORMAT)
        candidates = [h for h in hours if h == due]
    if not candidates:
        return None
    return spark.read.parquet(f"{root}/{candidates[0]}"), candidates[0]


def series(spark: SparkSession, root: str, last: str | None = None, skip_gaps: bool = False):
    """All snapshots after `last`, in order."""
    while (step := next_snapshot(spark, root, last, skip_gaps)) is not None:
        yield step
        last = step[1]
