"""Customer 360: contact history joined to transactions.

Contacts are the event feed per user (type 2 history); transactions are orders, dated into
the same month by their key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import workspace
from strata.operators import cdc, quality
from strata.plans.changes import _HISTORY_SQL, history
from strata.plans.registry import query
from strata.tables import table

_TX_AT = "TIMESTAMP '2024-01-01 00:00:00' + make_dt_interval(CAST(o_orderkey % 30 AS INT), CAST(o_custkey % 24 AS INT))"
_TX_SQL = f"""{_HISTORY_SQL},
  tx AS (SELECT o_orderkey AS transaction_id, o_custkey AS customer_id, o_totalprice AS amount, o_orderpriority AS category,
           CAST(floor(o_totalprice / 50000) AS BIGINT) AS item_count, TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(o_orderkey % 30 AS INTEGER))
           + to_hours(CAST(o_custkey % 24 AS INTEGER)) AS tx_ts FROM orders WHERE floor(o_totalprice / 50000) > 0)"""
RULES = [quality.Rule("item_count should be positive value", "item_count > 0", "drop")]


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history(table(spark, sf_dir, "events"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("transaction_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("amount"), F.col("o_orderpriority").alias("category"),
        F.floor(F.col("o_totalprice") / 50_000).alias("item_count"), F.expr(_TX_AT).alias("tx_ts"))
    return quality.expect(rows, RULES)


def all_version_totals(tx: DataFrame, versions: DataFrame, attributes: list[str], measure: str,
                       by: list[str]) -> DataFrame:
    """Sum of `measure` over transactions joined to every version of their contact.

    The join itself would repeat each transaction once per version. Counting equal versions
    and summing transactions per customer first gives the same totals from a join that
    carries one row per customer and group.
    """
    counted = versions.groupBy(F.col("user_id").alias("customer_id"), *attributes).agg(F.count(F.lit(1)).alias("_versions"))
    summed = tx.groupBy("customer_id", *by).agg(F.sum(measure).alias("_sum"))
    joined = summed.join(counted, "customer_id", "left")
    return (joined.groupBy(*attributes, *by)
            .agg(F.sum(F.col("_sum") * F.coalesce("_versions", F.lit(1))).alias("total")))


@query(f"""WITH {_TX_SQL} SELECT event_type, strftime(tx_ts, '%Y-%m-%d') AS transaction_date, category,
             CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_expense
           FROM tx LEFT JOIN history ON user_id = customer_id GROUP BY 1, 2, 3""")
def categorized_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir).select(
        "customer_id", F.date_format("tx_ts", "yyyy-MM-dd").alias("transaction_date"), "category",
        F.col("amount").cast("decimal(18,2)").alias("amount"))
    totals = all_version_totals(tx, contacts(spark, sf_dir), ["event_type"], "amount", ["transaction_date", "category"])
    return totals.select("event_type", "transaction_date", "category", F.col("total").cast("double").alias("total_expense"))


@query(f"""WITH {_TX_SQL} SELECT transaction_id, customer_id, amount, category, COUNT(user_id) AS versions,
             CAST(GREATEST(COUNT(user_id), 1) * CAST(amount AS DECIMAL(18,2)) AS DOUBLE) AS joined_amount
           FROM tx LEFT JOIN history ON user_id = customer_id GROUP BY transaction_id, customer_id, amount, category""")
def c360_join_all_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What joining all versions does to each transaction: how often it appears and what it adds up to."""
    counted = contacts(spark, sf_dir).groupBy(F.col("user_id").alias("customer_id")).agg(F.count(F.lit(1)).alias("versions"))
    joined = transactions(spark, sf_dir).join(counted, "customer_id", "left")
    appears = F.coalesce("versions", F.lit(0))
    return joined.select("transaction_id", "customer_id", "amount", "category", appears.alias("versions"),
                         (F.greatest(appears, F.lit(1)) * F.col("amount").cast("decimal(18,2)")).cast("double")
                         .alias("joined_amount"))


def current_360(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with the contact as it is now."""
    current = cdc.current(contacts(spark, sf_dir)).select("user_id", "event_type")
    return transactions(spark, sf_dir).join(current, F.col("user_id") == F.col("customer_id"), "left")


@query(f"""WITH {_TX_SQL} SELECT transaction_id, customer_id, amount, category, event_type
           FROM tx LEFT JOIN history ON user_id = customer_id AND end_ts IS NULL""")
def c360_join_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_360(spark, sf_dir).select("transaction_id", "customer_id", "amount", "category", "event_type")


@query(f"""WITH {_TX_SQL} SELECT transaction_id, customer_id, amount, category, event_type
           FROM tx LEFT JOIN history ON user_id = customer_id AND tx_ts >= start_ts AND (tx_ts < end_ts OR end_ts IS NULL)""")
def c360_join_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver_contacts = workspace.materialize(contacts(spark, sf_dir), "silver-contacts")
    joined = cdc.as_of_join(transactions(spark, sf_dir), silver_contacts, "customer_id", "user_id", "tx_ts", ["event_type"])
    return joined.select("transaction_id", "customer_id", "amount", "category", "event_type")


@query(f"""WITH {_TX_SQL} SELECT event_type AS title, CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_amt_by_title
           FROM tx LEFT JOIN history ON user_id = customer_id AND end_ts IS NULL GROUP BY 1 ORDER BY 1""")
def amount_by_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (current_360(spark, sf_dir).groupBy(F.col("event_type").alias("title"))
            .agg(F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("total_amt_by_title"))
            .orderBy("title"))


@query(f"""WITH {_TX_SQL} SELECT event_type AS title, category, CAST(SUM(item_count) AS DOUBLE) / COUNT(*) AS avg_items
           FROM tx JOIN history ON user_id = customer_id AND end_ts IS NULL GROUP BY 1, 2""")
def items_by_title_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (current_360(spark, sf_dir).where("event_type IS NOT NULL AND category IS NOT NULL")
            .groupBy(F.col("event_type").alias("title"), "category").agg(F.avg("item_count").alias("avg_items")))
