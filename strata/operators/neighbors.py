"""Row-to-row lookups inside a key, safe when one key holds a huge share of rows.

A plain ``lead``/``lag`` window sends all rows of a key to one task. Here the keys
with more than `threshold` rows are found first (a count over a sample). Their rows are cut into consecutive slices along the sequence, the window runs per
(key, slice), and one edge row per slice carries the value across the cut. Cuts lie at quantiles, so
an outlier does not matter. Results do not depend on the slicing. Without heavy keys the plan is the plain window.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

HEAVY_ROWS = 2_000_000
# Heavy keys are found in a sample that holds about this many rows of a key at the threshold.
SAMPLED_ROWS = 10_000
# Heavy keys are listed on the driver only up to this many; beyond it they stay a
# distributed table and are joined like any other.
LISTED_KEYS = 50_000
# Edge rows, one per slice, are broadcast up to this many; the number is known from the list.
BROADCAST_EDGES = 100_000
SLICES_PER_THRESHOLD = 4

#: Cuts of a key at most (one less than a power of two, for the search), and of all listed keys together.
MOST_CUTS, LISTED_CUTS = 2047, 500_000
#: Values that the quantile sketch of a key keeps for each of its slices.
KEPT = 64

_SLICEABLE = (T.NumericType, T.TimestampType, T.TimestampNTZType, T.DateType, T.StringType, T.BinaryType)


def _place(cuts: Column, value: Column) -> Column:
    """How many of the sorted `cuts` are at most `value`, by binary search; 0 for a null value."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(MOST_CUTS.bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= F.size(cuts)) & (F.get(cuts, at + step - 1) <= value), at + step).otherwise(at))


@dataclass(frozen=True)
class Slices:
    """How the rows of heavy keys are cut along `along`; ``heavy`` is None when no key is.

    ``count`` bounds the number of slices, None when it is not known.
    """

    keys: list[str]
    along: str
    heavy: DataFrame | None
    count: int | None = None

    def mark(self, df: DataFrame) -> DataFrame:
        """Add ``_slice``: 0 for ordinary keys, the slice number for heavy ones."""
        if self.heavy is None:
            return df.withColumn("_slice", F.lit(0).cast("bigint"))
        cuts = self.heavy.select(*[F.col(k).alias(f"_h_{k}") for k in self.keys], "_cuts")
        same_key = [F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in self.keys]
        cut = F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(_place(F.col("_cuts"), F.col(self.along)) + 1)
        return (df.join(cuts, same_key, "left")
                  .withColumn("_slice", cut.cast("bigint"))
                  .drop(*cuts.columns))


def _sketch(sample: DataFrame, keys: list[str], along: str, pieces: DataFrame) -> DataFrame:
    """The cuts of each key in `pieces` (keys, _pieces): quantiles of a random sample of bounded size.

    A row falls into one of a key's slots, and each slot keeps the row with the smallest random number, so sketches
    of parts merge and a key never brings more than `KEPT` values a slice together, of whatever type.
    """
    wanted = pieces.select(*[F.col(k).alias(f"_h_{k}") for k in keys], "_pieces")
    rows = sample.join(wanted, [F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in keys]).where(F.col(along).isNotNull())
    slot = F.floor(F.rand(3) * F.col("_pieces") * KEPT)
    kept = (rows.select(*keys, "_pieces", F.col(along).alias("_value"), slot.alias("_slot"), F.rand(4).alias("_draw"))
            .groupBy(*keys, "_pieces", "_slot").agg(F.min_by("_value", "_draw").alias("_value"))
            .groupBy(*keys, "_pieces").agg(F.sort_array(F.collect_list("_value")).alias("_values")))
    at = F.transform(F.sequence(F.lit(1), F.col("_pieces") - 1),
                     lambda i: F.get("_values", F.floor(i * F.size("_values") / F.col("_pieces")).cast("int")))
    return kept.select(*keys, F.array_distinct(at).alias("_cuts"))


def plan_slices(df: DataFrame, keys: list[str], along: str, threshold: int = HEAVY_ROWS) -> Slices:
    """Find heavy keys of `df` and cut them at quantiles of `along`: numbers, times, dates, texts or bytes.

    Rows with equal `along` stay together. The samples only decide how work is cut, never what the result is.
    """
    if not isinstance(df.schema[along].dataType, _SLICEABLE):
        return Slices(keys, along, None)
    fraction = min(1.0, SAMPLED_ROWS / threshold)
    sample = df.select(*dict.fromkeys([*keys, along]))
    sample = sample.sample(fraction, seed=17) if fraction < 1 else sample
    wanted = F.ceil(F.col("_n") * SLICES_PER_THRESHOLD / F.lit(threshold * fraction)).cast("int")
    pieces = (sample.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > threshold * fraction)
              .withColumn("_pieces", F.least(wanted, F.lit(MOST_CUTS + 1))).drop("_n"))
    listed = pieces.limit(LISTED_KEYS + 1).collect()
    if not listed:
        return Slices(keys, along, None)
    if len(listed) > LISTED_KEYS or sum(row["_pieces"] for row in listed) > LISTED_CUTS:
        return Slices(keys, along, _sketch(sample, keys, along, pieces))
    few = F.broadcast(df.sparkSession.createDataFrame(listed, pieces.schema))
    sketch = _sketch(sample, keys, along, few)
    cuts = sketch.collect()
    # A key whose sampled values were all null has no cuts.
    heavy = F.broadcast(df.sparkSession.createDataFrame(cuts, sketch.schema)) if cuts else None
    return Slices(keys, along, heavy, sum(len(row["_cuts"]) + 1 for row in cuts))


def _order_struct(order: list[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def _across(df: DataFrame, slices: Slices, edges: DataFrame) -> DataFrame:
    """Attach one edge row per (key, slice); null keys match each other.

    Broadcast edges leave the rows where they are, so a second lookup needs no new shuffle.
    """
    keys = slices.keys
    if slices.count is not None and slices.count <= BROADCAST_EDGES:
        edges = F.broadcast(edges)
    renamed = edges.select(*[F.col(c).alias(f"_e_{c}") for c in [*keys, "_slice"]], "_edge")
    on = [F.col(c).eqNullSafe(F.col(f"_e_{c}")) for c in [*keys, "_slice"]]
    return df.join(renamed, on, "left").drop(*[f"_e_{c}" for c in [*keys, "_slice"]])


def _adjacent(df: DataFrame, slices: Slices, order: list[str], take: dict[str, str], ahead: bool) -> DataFrame:
    keys = slices.keys
    shift = F.lead if ahead else F.lag
    if slices.heavy is None:
        # Plain columns: nothing but the row itself goes through the shuffle.
        local = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumns({name: shift(column).over(local) for name, column in take.items()})
    if "_slice" not in df.columns:
        df = slices.mark(df)
    local = Window.partitionBy(*keys, "_slice").orderBy(*order)
    # Values travel in a struct, so that "no neighbour" and "null value" differ.
    row = F.struct(*[F.col(column).alias(name) for name, column in take.items()])
    pick = F.min_by if ahead else F.max_by
    edges = (df.where("_slice > 0")
               .groupBy(*keys, "_slice")
               .agg(pick(row, _order_struct(order)).alias("_first"))
               .withColumn("_edge", shift("_first").over(Window.partitionBy(*keys).orderBy("_slice"))))
    found = _across(df.withColumn("_near", shift(row).over(local)), slices, edges) \
        .withColumn("_found", F.coalesce("_near", "_edge"))
    return found.withColumns({name: F.col(f"_found.{name}") for name in take}).drop("_near", "_edge", "_found")


def next_values(df: DataFrame, slices: Slices, order: list[str], take: dict[str, str]) -> DataFrame:
    """Add columns of the following row of the same key, null on the last one; `take` maps new name to column."""
    return _adjacent(df, slices, order, take, ahead=True)


def previous_values(df: DataFrame, slices: Slices, order: list[str], take: dict[str, str]) -> DataFrame:
    """Add columns of the preceding row of the same key, null on the first one; `take` maps new name to column."""
    return _adjacent(df, slices, order, take, ahead=False)


def carry_forward(df: DataFrame, slices: Slices, order: list[str], take: Column, name: str) -> DataFrame:
    """Add the newest non-null `take` at or before each row of the same key."""
    keys = slices.keys
    cut = [] if slices.heavy is None else ["_slice"]
    if cut and "_slice" not in df.columns:
        df = slices.mark(df)
    running = (Window.partitionBy(*keys, *cut).orderBy(*order)
                     .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    if slices.heavy is None:
        return df.withColumn(name, F.last(take, ignorenulls=True).over(running))
    df = df.withColumn("_take", take).withColumn("_near", F.last("_take", ignorenulls=True).over(running))
    earlier = (Window.partitionBy(*keys).orderBy("_slice")
                     .rowsBetween(Window.unboundedPreceding, -1))
    edges = (df.where("_slice > 0")
               .groupBy(*keys, "_slice")
               .agg(F.max_by("_take", F.when(F.col("_take").isNotNull(), _order_struct(order))).alias("_last"))
               .withColumn("_edge", F.last("_last", ignorenulls=True).over(earlier)))
    return (_across(df, slices, edges)
            .withColumn(name, F.coalesce("_near", "_edge"))
            .drop("_take", "_near", "_edge"))
