"""Retail orders: stream-static enrichment, exploded products, sales per city."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import quality
from strata.plans.registry import query
from strata.streaming import runner
from strata.tables import table, table_stream

_PRODUCTS = """named_struct('curr', 'USD', 'price', CAST(o_totalprice AS DECIMAL(18,2)), 'qty', CAST(1 AS BIGINT), 'id', o_orderkey),
               named_struct('curr', 'EUR', 'price', CAST(o_totalprice AS DECIMAL(18,2)) * 2, 'qty', CAST(3 AS BIGINT), 'id', o_orderkey + 1)"""


def _orders(orders: DataFrame) -> DataFrame:
    """Sales orders with epoch time and nested products."""
    return orders.selectExpr(
        "o_custkey AS customer_id", "concat('Customer#', lpad(o_custkey, 9, '0')) AS customer_name",
        "unix_seconds(o_orderdate) AS order_epoch", "o_orderkey AS order_number", f"array({_PRODUCTS}) AS ordered_products")


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (table(spark, sf_dir, "customer").where("c_acctbal > 0")
            .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
                    F.col("n_name").alias("city"), F.col("c_mktsegment").alias("loyalty_segment")))


def clean_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with customer attributes; works on a stream of orders and a static customer table."""
    joined = orders.join(customers, ["customer_id", "customer_name"], "left")
    dated = joined.withColumn("order_datetime", F.timestamp_seconds("order_epoch")) \
                  .withColumn("order_date", F.to_date("order_datetime")).drop("order_epoch")
    return quality.expect(dated, [quality.Rule("valid order_number", "order_number IS NOT NULL", "drop")])


_JOIN_SQL = """SELECT o_custkey AS customer_id, 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS customer_name,
                 o_orderkey AS order_number, strftime(o_orderdate, '%Y-%m-%d') AS order_date, o_totalprice,
                 c.city, c.loyalty_segment
          FROM orders LEFT JOIN (SELECT c_custkey, c_name, n_name AS city, c_mktsegment AS loyalty_segment
                                 FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 0) c
            ON c.c_custkey = o_custkey"""


def _enriched(rows: DataFrame) -> DataFrame:
    return rows.select("customer_id", "customer_name", "order_number", F.col("order_date").cast("string").alias("order_date"),
                       "city", "loyalty_segment")


@query(f"SELECT * EXCLUDE (o_totalprice) FROM ({_JOIN_SQL})")
def join_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(clean_orders(_orders(table(spark, sf_dir, "orders")), _customers(spark, sf_dir)))


@query(f"SELECT * EXCLUDE (o_totalprice) FROM ({_JOIN_SQL})")
def stream_static_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(table_stream(spark, sf_dir, "orders"))
    return _enriched(runner.appended(clean_orders(orders, _customers(spark, sf_dir)), "orders-cleaned"))


@query("""SELECT o_orderkey AS order_number, CAST(pos AS BIGINT) AS pos, CASE pos WHEN 0 THEN 'USD' ELSE 'EUR' END AS curr,
                 CAST(CAST(o_totalprice AS DECIMAL(18,2)) * (1 + pos) AS DOUBLE) AS price,
                 CAST(CASE pos WHEN 0 THEN 1 ELSE 3 END AS BIGINT) AS qty, o_orderkey + pos AS id
          FROM orders, (VALUES (0), (1)) v(pos)""")
def explode_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (_orders(table(spark, sf_dir, "orders")).select("order_number", F.posexplode("ordered_products").alias("pos", "p"))
            .select("order_number", F.col("pos").cast("bigint").alias("pos"), "p.curr",
                    F.col("p.price").cast("double").alias("price"), "p.qty", "p.id"))


def sales_in(cleaned: DataFrame, *cities: str) -> DataFrame:
    """Sales, quantity and product count per day, city, customer and currency in some cities."""
    products = cleaned.where(F.col("city").isin(*cities)).select(
        "city", "order_date", "customer_id", "customer_name", F.explode("ordered_products").alias("p"))
    return (products.groupBy("order_date", "city", "customer_id", "customer_name", F.col("p.curr").alias("curr"))
            .agg(F.sum("p.price").alias("sales"), F.sum("p.qty").alias("quantity"), F.count("p.id").alias("product_count")))


@query(f"""SELECT order_date, city, customer_id, customer_name, curr,
             CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2)) * f) AS DOUBLE) AS sales,
             CAST(SUM(q) AS BIGINT) AS quantity, COUNT(*) AS product_count
           FROM ({_JOIN_SQL}), (VALUES ('USD', 1, 1), ('EUR', 2, 3)) v(curr, f, q)
           WHERE city IN ('NATION_3', 'NATION_7') GROUP BY 1, 2, 3, 4, 5""")
def sales_by_city_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = clean_orders(_orders(table(spark, sf_dir, "orders")), _customers(spark, sf_dir))
    both = sales_in(cleaned, "NATION_3", "NATION_7")
    return both.withColumn("sales", F.col("sales").cast("double")).withColumn("order_date", F.col("order_date").cast("string"))
