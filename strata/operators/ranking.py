"""Global row numbers and oldest-N selection without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata import workspace


def row_numbers(df: DataFrame, order: list[str], name: str = "row_num") -> DataFrame:
    """Add 1-based positions of the rows sorted by `order`.

    Rows are range-partitioned and sorted, which spreads even a single dominant value as
    long as `order` as a whole varies. The sorted rows are stored once, because sampled
    range bounds must not be drawn again; per-partition counts then give the offsets.
    """
    placed = (df.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("_id", F.monotonically_increasing_id()))
    stored = workspace.materialize(placed, "row-numbers")
    # Documented layout of the id: partition number above bit 33, position below.
    numbered = stored.withColumn("_part", F.shiftright("_id", 33)) \
                     .withColumn("_place", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
               .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    # One row per partition of the sort.
    return (numbered.join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("_before") + F.col("_place") + 1)
            .drop("_id", "_part", "_place", "_before"))


def first_n(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The `n` first rows in Spark's ascending order of `order` (nulls first, NaN last); `n` may grow with the table.

    Rows are numbered by a range sort, so no task sees them all. `order` should end with a unique column.
    """
    return row_numbers(df, order, "_row").where(F.col("_row") <= n).drop("_row")


def zip_rows(left: DataFrame, left_order: list[str], right: DataFrame, right_order: list[str]) -> DataFrame:
    """Pair the i-th row of `left` with the i-th row of `right`."""
    return (row_numbers(left, left_order, "_row")
            .join(row_numbers(right, right_order, "_row"), "_row")
            .drop("_row"))
