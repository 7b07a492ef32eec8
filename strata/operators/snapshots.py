"""Change tracking from full snapshots of a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata import workspace
from strata.operators.cdc import END, START


def _differs(columns: list[str], left: str, right: str) -> Column:
    tests = [~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def change_set(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that turn `before` into `after`, with ``_change`` insert, update or delete. Null keys equal each other."""
    values = [c for c in after.columns if c not in keys]
    old = before.select(*keys, F.struct(*values).alias("old"))
    new = after.select(*keys, F.struct(*values).alias("new"))
    change = (F.when(F.col("old").isNull(), "insert")
               .when(F.col("new").isNull(), "delete")
               .when(_differs(values, "old", "new"), "update"))
    old, new = old.select(F.struct(*keys).alias("old_key"), "old"), new.select(F.struct(*keys).alias("new_key"), "new")
    return (old.join(new, F.col("old_key").eqNullSafe(F.col("new_key")), "full")
            .withColumn("_change", change)
            .where("_change IS NOT NULL")
            .select(F.coalesce("new_key", "old_key").alias("key"), F.coalesce("new", "old").alias("row"), "_change")
            .select("key.*", "row.*", "_change"))


def apply_change_set(target: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """`target` after inserting, updating and deleting by key."""
    same = reduce(lambda a, b: a & b, [target[k].eqNullSafe(F.col(f"_changed.{k}")) for k in keys])
    untouched = target.join(changes.select(F.struct(*keys).alias("_changed")), same, "left_anti")
    return untouched.unionByName(changes.where("_change <> 'delete'").drop("_change"))


def history(snapshots: list[tuple[DataFrame, object]], keys: list[str],
            track: list[str] | None = None) -> DataFrame:
    """Type 2 history of an ordered series of (snapshot, version) pairs.

    Only a change in a `track` column (default: all) opens a version; other columns are
    updated in place on the open version. A key missing from a snapshot closes its
    version there, and opens a new one when it comes back. A key has at most one row per
    snapshot, so the per-key windows stay as short as the series.
    """
    values = [c for c in snapshots[0][0].columns if c not in keys]
    track = track or values
    versions = [F.lit(version) for _, version in snapshots]
    tagged = reduce(DataFrame.unionByName,
                    [df.select(*keys, *values).withColumn("_nth", F.lit(i)) for i, (df, _) in enumerate(snapshots)])
    by_key = Window.partitionBy(*keys).orderBy("_nth")
    gap = ~F.lag("_nth").over(by_key).eqNullSafe(F.col("_nth") - 1)
    changed = reduce(lambda a, b: a | b,
                     [~F.lag(c).over(by_key).eqNullSafe(F.col(c)) for c in track], gap)
    runs = tagged.withColumn("_run", F.sum(changed.cast("int")).over(by_key))
    newest = F.max_by(F.struct(*values), "_nth")
    folded = (runs.groupBy(*keys, "_run")
              .agg(F.min("_nth").alias("_from"), F.max("_nth").alias("_to"), newest.alias("_row")))
    named = F.array(*versions)
    return folded.select(*keys, "_row.*",
                         F.get(named, F.col("_from")).alias(START),
                         F.get(named, F.col("_to") + 1).alias(END))


def advance_history(open_rows: DataFrame, snapshot: DataFrame, version, keys: list[str],
                    track: list[str] | None = None) -> DataFrame:
    """Fold one more snapshot into the open versions of a history table.

    Returns the versions this snapshot closes (``__END_AT`` set) and the ones now open.
    Closed history is never read again, so the cost is one join of the open rows with
    the snapshot.
    """
    values = [c for c in snapshot.columns if c not in keys]
    track = track or values
    old = open_rows.select(*keys, F.struct(*values, START).alias("old"))
    new = snapshot.select(*keys, F.struct(*values).alias("new"))
    gone, fresh = F.col("new").isNull(), F.col("old").isNull()
    turned = ~gone & ~fresh & _differs(track, "old", "new")
    at = F.lit(version)

    def row(source: str, start: Column, end: Column) -> Column:
        return F.struct(*[F.col(f"{source}.{c}").alias(c) for c in values], start.alias(START), end.alias(END))

    never = F.when(F.lit(False), at)
    closing = F.when(gone | turned, row("old", F.col(f"old.{START}"), at))
    opening = F.when(~gone, row("new", F.when(fresh | turned, at).otherwise(F.col(f"old.{START}")), never))
    old = old.select(F.struct(*keys).alias("old_key"), "old")
    new = new.select(F.struct(*keys).alias("new_key"), "new")
    # Null keys equal each other.
    return (old.join(new, F.col("old_key").eqNullSafe(F.col("new_key")), "full")
            .withColumn("key", F.coalesce("new_key", "old_key")).select("key.*", "old", "new")
            .select(*keys, F.explode(F.filter(F.array(closing, opening), lambda r: r.isNotNull())).alias("r"))
            .select(*keys, "r.*"))


def fold_history(first: tuple[DataFrame, object], later: list[tuple[DataFrame, object]], keys: list[str],
                 track: list[str] | None = None) -> DataFrame:
    """Full history of a series, by advancing snapshot after snapshot.

    Every step is stored, so plans do not grow with the number of snapshots.
    """
    start, version = first
    at = F.lit(version)
    opened = start.withColumn(START, at).withColumn(END, F.when(F.lit(False), at))
    closed = []
    for snapshot, version in later:
        step = workspace.materialize(advance_history(opened, snapshot, version, keys, track), "history-step")
        closed.append(step.where(F.col(END).isNotNull()))
        opened = step.where(F.col(END).isNull())
    return reduce(DataFrame.unionByName, closed, opened)
