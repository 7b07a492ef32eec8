"""Applying change feeds to keyed tables, with and without history."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators import neighbors

START, END = "__START_AT", "__END_AT"


def flag_deletes(changes: DataFrame, deletes: str | Column | None) -> DataFrame:
    """Add ``_deleted``; a predicate that is null (full-load rows without an op) is no delete."""
    if deletes is None:
        return changes.withColumn("_deleted", F.lit(False))
    predicate = F.expr(deletes) if isinstance(deletes, str) else deletes
    return changes.withColumn("_deleted", F.coalesce(predicate, F.lit(False)))


def newest(flagged: DataFrame, keys: list[str], sequence_by: str) -> DataFrame:
    """The newest change of every key, deletes included.

    A single ``max`` over (sequence, deleted, rest of the row), so it combines on the
    map side and a key with very many changes costs no more than any other. Equal
    sequences resolve to the delete, then to the greatest row.
    """
    rest = [c for c in flagged.columns if c not in {*keys, sequence_by, "_deleted"}]
    change = F.max(F.struct(sequence_by, "_deleted", *rest)).alias("_newest")
    return flagged.groupBy(*keys).agg(change).select(*keys, "_newest.*").select(*flagged.columns)


def drop_deleted(latest: DataFrame, except_columns: list[str] = ()) -> DataFrame:
    return latest.where(~F.col("_deleted")).drop("_deleted", *except_columns)


def apply_changes(changes: DataFrame, keys: list[str], sequence_by: str,
                  deletes: str | Column | None = None, except_columns: list[str] = (),
                  scd_type: int = 1, heavy_rows: int = neighbors.HEAVY_ROWS) -> DataFrame:
    """The table a change feed describes: current rows (type 1) or full history (type 2).

    The result depends only on the set of changes, not on their order of arrival.
    """
    if scd_type == 1:
        return drop_deleted(newest(flag_deletes(changes, deletes), keys, sequence_by), except_columns)
    if scd_type != 2:
        raise ValueError(f"scd_type must be 1 or 2, not {scd_type}")
    return _history(changes, keys, sequence_by, deletes, list(except_columns), heavy_rows)


def _history(changes: DataFrame, keys: list[str], sequence_by: str, deletes, except_columns: list[str],
             heavy_rows: int) -> DataFrame:
    values = [c for c in changes.columns if c not in {*keys, sequence_by, *except_columns}]
    feed = (flag_deletes(changes, deletes)
            .withColumn(START, F.col(sequence_by))
            .select(*keys, START, "_deleted", *values))
    slices = neighbors.plan_slices(feed, keys, START, heavy_rows)
    order = [START, "_deleted", *values]

    # A change opens a version unless it repeats what the key already is; comparing with
    # the preceding change is enough, since repeated changes leave the state as it was.
    before = {f"_before_{c}": c for c in ["_deleted", *values]}
    seen = neighbors.previous_values(feed, slices, order, before)
    was_deleted = F.col("_before__deleted")
    same_values = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_before_{c}")) for c in values], F.lit(True))
    opens = ~F.col("_deleted") & (was_deleted.isNull() | was_deleted | ~same_values)
    closes = F.col("_deleted") & was_deleted.isNotNull() & ~was_deleted
    turns = seen.where(opens | closes).drop(*before)
    ended = neighbors.next_values(turns, slices, order, {END: START})
    return (ended.where(~F.col("_deleted") & (F.col(END).isNull() | (F.col(START) < F.col(END))))
            .select(*keys, *values, START, END))


def current(history: DataFrame) -> DataFrame:
    """Open versions of a history table."""
    return history.where(F.col(END).isNull())


def as_of_join(facts: DataFrame, history: DataFrame, fact_key: str, key: str, at: str,
               columns: list[str], heavy_rows: int = neighbors.HEAVY_ROWS) -> DataFrame:
    """Left join each fact to the version of its key that was valid at the fact's time.

    Facts and versions are merged into one time-ordered sequence per key, and the newest
    version is carried forward, so a busy key costs its rows and not facts x versions.
    Both sides are read twice, once to find busy keys, so `history` should be a stored table.
    """
    version = F.struct(F.col(END).alias("end"), *[F.col(c) for c in columns])
    events = (history.select(F.col(key).alias("_key"), F.col(START).alias("_at"), F.lit(0).alias("_kind"),
                             version.alias("_version"))
              .unionByName(facts.select(F.col(fact_key).alias("_key"), F.col(at).alias("_at"), F.lit(1).alias("_kind"),
                                        F.struct(*facts.columns).alias("_fact")), allowMissingColumns=True))
    slices = neighbors.plan_slices(events, ["_key"], "_at", heavy_rows)
    known = neighbors.carry_forward(events, slices, ["_at", "_kind"], F.col("_version"), "_seen").where("_kind = 1")
    valid = F.col("_seen.end").isNull() | (F.col("_at") < F.col("_seen.end"))
    return known.select("_fact.*", *[F.when(valid, F.col(f"_seen.{c}")).alias(c) for c in columns])
