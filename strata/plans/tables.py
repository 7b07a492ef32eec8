"""Named tables: written, appended to, replaced by partition, found in the catalog and joined by bucket."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import workspace
from strata.plans.registry import query
from strata.sources import catalog, named
from strata.tables import table


def _name(label: str) -> str:
    """A table name that no other run of the query uses."""
    return f"strata_{label}_{uuid.uuid4().hex}"


@query("""SELECT o_orderkey, o_orderstatus, o_totalprice + CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS price,
                 CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS priority, 4 AS n_columns, TRUE AS listed FROM orders""")
def named_table_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partitioned table that is created, appended to with fewer columns, and of which one partition is replaced."""
    name, path = _name("orders"), workspace.new_dir(spark, "named")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("priority"),
                                                   "o_orderstatus")
    named.create(orders.where("o_orderkey % 2 = 1"), name, path, named.Layout(partition_by=("o_orderstatus",)))
    named.append(orders.where("o_orderkey % 2 = 0").drop("priority"), name)
    pending = workspace.materialize(spark.table(name).where("o_orderstatus = 'P'"), "pending")
    named.replace_partitions(pending.withColumn("price", F.col("price") + 1), name)
    listed = name in catalog.tables(spark, spark.catalog.currentDatabase())
    return spark.table(name).withColumns({"n_columns": F.lit(len(spark.table(name).columns)), "listed": F.lit(listed)})


def bucketed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders and line items in equally many buckets of the order key, the line items written twice."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    buckets = named.buckets_for(max(orders.count(), lines.count()))  # from the files' footers
    lay = {"orders": named.Layout(buckets=buckets, bucket_by=("o_orderkey",), sort_by=("o_orderkey",)),
           "lines": named.Layout(buckets=buckets, bucket_by=("l_orderkey",), sort_by=("l_orderkey",))}
    names = {label: _name(label) for label in lay}
    one = named.create(orders, names["orders"], workspace.new_dir(spark, "bucketed"), lay["orders"])
    named.create(lines.where("l_linenumber <= 3"), names["lines"], workspace.new_dir(spark, "bucketed"), lay["lines"])
    named.append(lines.where("l_linenumber > 3"), names["lines"])
    return one, spark.table(names["lines"])


@query("""SELECT o_orderkey, o_orderpriority, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total, COUNT(*) AS n
          FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2""")
def bucketed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Join and grouping by the bucket key: no shuffle."""
    orders, lines = bucketed(spark, sf_dir)
    return (orders.join(lines.hint("merge"), orders["o_orderkey"] == lines["l_orderkey"]).groupBy("o_orderkey", "o_orderpriority")
            .agg(F.sum("amount").cast("double").alias("total"), F.count("*").alias("n")))
