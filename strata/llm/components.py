"""Connected components of a link table by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.workspace import materialize


def label(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """node and component (the smallest reachable node) of every node in `links` (a, b), two BIGINT columns.

    Each round takes the smallest label among a node and its neighbours and then that label's own label; the driver
    sees the number of changed nodes only. Labels are stored in the shared folder after every round. With
    `rounds`, it stops early: equal labels then still mean "connected", unequal ones nothing.
    """
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).where("a <> b").distinct()
    both = materialize(both, "links")
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("b"))
                         .select(F.col("a").alias("node"), F.least("a", "b").alias("component")), "labels")
    done = 0
    while rounds is None or done < rounds:
        near = (both.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy("a").agg(F.min("component").alias("near")).withColumnRenamed("a", "node"))
        low = labels.join(near, "node").select("node", F.col("component").alias("old"),
                                               F.least("component", "near").alias("low"))
        own = labels.select(F.col("node").alias("low"), F.col("component").alias("of_low"))
        stepped = materialize(low.join(own, "low", "left").select(
            "node", "old", F.least("low", F.coalesce("of_low", "low")).alias("component")), "labels")
        labels, done = stepped.select("node", "component"), done + 1
        if stepped.where("component <> old").isEmpty():
            break
    return labels
