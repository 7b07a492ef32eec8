"""Star model over the sales tables: dimensions, facts, snapshots, and their constraints.

The tables have no commit or receipt date; the ship date stands in for both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import quality, star
from strata.plans.registry import query
from strata.tables import table

FIRST, LAST = "1995-01-01", "2001-12-31"

_CUSTOMERS = """SELECT c_custkey AS key, c_name AS name, n_name AS nation, r_name AS region
                FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
                UNION ALL SELECT -1, 'unknown name', 'unknown nation', 'unknown region'"""
_PARTS = """SELECT p_partkey AS key, p_name AS name, p_brand AS brand, p_type AS type, p_size AS size,
                   p_retailprice AS price FROM part
            UNION ALL SELECT -1, 'unknown part', 'unknown brand', 'unknown type', NULL, NULL"""
_DAYS = f"""days AS (SELECT CAST(d AS DATE) AS date FROM generate_series(DATE '{FIRST}', DATE '{LAST}', INTERVAL 1 DAY) t(d))"""
_DATES = f"""WITH {_DAYS} SELECT CAST(strftime(date, '%Y%m%d') AS BIGINT) AS key, CAST(date AS VARCHAR) AS date,
               dayname(date) AS day_of_week_name, CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week,
               CAST(day(date) AS INTEGER) AS day_of_month, CAST(dayofyear(date) AS INTEGER) AS day_of_year,
               CAST(weekofyear(date) AS INTEGER) AS week_of_year, monthname(date) AS month_name,
               CAST(month(date) AS INTEGER) AS month_number, CAST(quarter(date) AS INTEGER) AS quarter,
               CAST(year(date) AS INTEGER) AS year, dayofweek(date) IN (0, 6) AS is_weekend FROM days
             UNION ALL SELECT -1, NULL, 'unknown day of week', NULL, NULL, NULL, NULL, 'unknown month', NULL, NULL, NULL, NULL"""
_MONTHS = f"""SELECT CAST(strftime(d, '%Y%m') AS BIGINT) AS key, strftime(d, '%Y-%m-%d') AS date, monthname(d) AS month_name,
               CAST(month(d) AS INTEGER) AS month_number, CAST(quarter(d) AS INTEGER) AS quarter,
               CAST(year(d) AS INTEGER) AS year,
               CAST(date_diff('day', CAST(d AS DATE), CAST(d + INTERVAL 1 MONTH AS DATE)) AS INTEGER) AS num_days
              FROM generate_series(DATE '{FIRST}', DATE '{LAST}', INTERVAL 1 MONTH) t(d)
              UNION ALL SELECT -1, NULL, 'unknown month', NULL, NULL, NULL, NULL"""
_FACTS = """SELECT o_orderkey AS order_num, l_linenumber AS line_item_num, COALESCE(o_custkey, -1) AS customer_key,
               COALESCE(l_partkey, -1) AS part_key, CAST(l_quantity AS DECIMAL(18,2)) AS num_parts,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS gross_sales, CAST(l_discount AS DECIMAL(18,2)) AS discount,
               CAST(l_tax AS DECIMAL(18,2)) AS tax,
               CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(1 - CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(5,2))
                    * CAST(1 + CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(5,2))
                    * CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END AS DECIMAL(18,2)) AS net_sales,
               CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS is_fulfilled,
               CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_returned,
               CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS order_date_key,
               CAST(strftime(l_shipdate, '%Y%m%d') AS BIGINT) AS commit_date_key,
               CAST(strftime(l_shipdate, '%Y%m%d') AS BIGINT) AS receipt_date_key,
               CAST(strftime(l_shipdate, '%Y%m%d') AS BIGINT) AS ship_date_key
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
_DAILY = f"""facts AS ({_FACTS}), dates AS ({_DATES}),
             daily AS (SELECT COALESCE(customer_key, -1) AS customer_key, COALESCE(part_key, -1) AS part_key,
               COALESCE(SUM(num_parts), 0) AS num_parts, COALESCE(SUM(num_parts * is_returned), 0) AS num_parts_returned,
               COALESCE(SUM(gross_sales), 0) AS gross_sales, COALESCE(SUM(gross_sales * is_returned), 0) AS sales_returned,
               COALESCE(SUM(net_sales), 0) AS net_sales, dates.key AS receipt_date_key
             FROM facts RIGHT JOIN dates ON receipt_date_key = dates.key GROUP BY ALL)"""
_AS_DOUBLE = ", ".join(f"CAST({m} AS DOUBLE) AS {m}" for m in star._MEASURES)


def doubles(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


@query(_CUSTOMERS)
def customers_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.customers_dim(*(table(spark, sf_dir, t) for t in ("customer", "nation", "region")))


@query(_PARTS)
def parts_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(star.parts_dim(table(spark, sf_dir, "part")), ["price"])


@query(f"{_CUSTOMERS} UNION ALL SELECT p_partkey, p_name, p_brand, p_type FROM part "
       "UNION ALL SELECT -1, 'unknown part', 'unknown brand', 'unknown type'")
def union_unknown_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = star.parts_dim(table(spark, sf_dir, "part")).select("key", "name", "brand", "type")
    return customers_dim(spark, sf_dir).union(parts)


def _sold_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days on which something shipped, with their attributes, counted from the line items."""
    shipped = (table(spark, sf_dir, "lineitem").groupBy(F.to_date("l_shipdate").alias("date"))
               .agg(F.count(F.lit(1)).alias("lines")))
    return star.date_dim(spark, FIRST, LAST).join(shipped, "date", "left")


@query(f"""SELECT d.*, n AS lines FROM ({_DATES}) d LEFT JOIN (SELECT strftime(l_shipdate, '%Y-%m-%d') AS day, COUNT(*) AS n
           FROM lineitem GROUP BY 1) s ON d.date = s.day""")
def date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sold_dates(spark, sf_dir).withColumn("date", F.col("date").cast("string"))


@query(f"""SELECT m.*, n AS lines FROM ({_MONTHS}) m LEFT JOIN (SELECT strftime(l_shipdate, '%Y-%m-01') AS month, COUNT(*) AS n
           FROM lineitem GROUP BY 1) s ON m.date = s.month""")
def month_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = (table(spark, sf_dir, "lineitem").groupBy(F.trunc("l_shipdate", "MM").alias("date"))
               .agg(F.count(F.lit(1)).alias("lines")))
    return (star.month_dim(spark, FIRST, LAST).join(shipped, "date", "left")
            .withColumn("date", F.col("date").cast("string")))


_PARTS_OF_DATE = """CAST(strftime({d}, '%Y%m%d') AS BIGINT) AS key, dayname({d}) AS day_of_week_name,
   CAST(dayofweek({d}) + 1 AS INTEGER) AS day_of_week, CAST(dayofyear({d}) AS INTEGER) AS day_of_year,
   CAST(weekofyear({d}) AS INTEGER) AS week_of_year, monthname({d}) AS month_name, CAST(quarter({d}) AS INTEGER) AS quarter,
   CAST(date_diff('day', CAST({d} AS DATE), CAST({d} + INTERVAL 1 MONTH AS DATE)) AS INTEGER) AS days_to_next"""


@query(f"SELECT o_orderkey, {_PARTS_OF_DATE.format(d='o_orderdate')} FROM orders")
def scalar_date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    star.register_functions(spark)
    d = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.expr("date_key(CAST(o_orderdate AS DATE))").alias("key"),
        F.date_format(d, "EEEE").alias("day_of_week_name"), F.dayofweek(d).alias("day_of_week"),
        F.dayofyear(d).alias("day_of_year"), F.weekofyear(d).alias("week_of_year"),
        F.date_format(d, "MMMM").alias("month_name"), F.quarter(d).alias("quarter"),
        F.date_diff(F.add_months(d, 1), d).alias("days_to_next"))


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.sales_facts(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"), "l_shipdate", "l_shipdate")


_FACT_MONEY = ["num_parts", "gross_sales", "discount", "tax", "net_sales"]


@query(f"SELECT * REPLACE ({', '.join(f'CAST({m} AS DOUBLE) AS {m}' for m in _FACT_MONEY)}) FROM ({_FACTS})")
def sales_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(facts(spark, sf_dir), _FACT_MONEY)


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.daily_sales_snapshot(facts(spark, sf_dir), star.date_dim(spark, FIRST, LAST))


@query(f"WITH {_DAILY} SELECT * REPLACE ({_AS_DOUBLE}) FROM daily")
def daily_sales_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(daily(spark, sf_dir), star._MEASURES)


@query(f"""WITH {_DAILY}, monthly AS (SELECT customer_key, part_key,
             CASE WHEN receipt_date_key = -1 THEN -1 ELSE receipt_date_key // 100 END AS receipt_month_key,
             {', '.join(f'SUM({m}) AS {m}' for m in star._MEASURES)} FROM daily GROUP BY 1, 2, 3)
           SELECT * REPLACE ({_AS_DOUBLE}) FROM monthly""")
def monthly_sales_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(star.monthly_sales_snapshot(daily(spark, sf_dir)), star._MEASURES)


@query("""SELECT l_orderkey AS order_num, l_linenumber AS line_item_num, COUNT(*) AS row_count
          FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1""")
def pk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.key_violations(facts(spark, sf_dir), ["order_num", "line_item_num"])


@query(f"""WITH facts AS ({_FACTS}), known AS (SELECT c_custkey AS key FROM customer WHERE c_acctbal >= 0 UNION ALL SELECT -1)
           SELECT customer_key, COUNT(*) AS row_count FROM facts
           WHERE customer_key NOT IN (SELECT key FROM known) GROUP BY 1""")
def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").where("c_acctbal >= 0")
    dimension = star.customers_dim(customer, table(spark, sf_dir, "nation"), table(spark, sf_dir, "region"))
    return quality.orphans(facts(spark, sf_dir), "customer_key", dimension, "key")


@query("""SELECT o_orderkey, l_linenumber, o_custkey, l_extendedprice, o_orderstatus
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def join_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (table(spark, sf_dir, "lineitem")
            .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .select("o_orderkey", "l_linenumber", "o_custkey", "l_extendedprice", "o_orderstatus"))
