"""Dimensions and facts of a sales star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UNKNOWN = -1


def register_functions(spark: SparkSession) -> None:
    """SQL functions of the model. Catalyst inlines them, so they cost what their bodies cost.

    Fixed values: the yyyyMMdd key, and net sales as the price after discount, tax and return.
    """
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION date_key(day DATE) RETURNS BIGINT
                 RETURN CAST(year(day) * 10000 + month(day) * 100 + day(day) AS BIGINT)""")
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION net_sales(
                   price DECIMAL(18,2), discount DECIMAL(18,2), tax DECIMAL(18,2), is_returned INT)
                 RETURNS DECIMAL(18,2)
                 RETURN price * (1 - discount) * (1 + tax) * (1 - is_returned)""")


def with_unknown(dimension: DataFrame, **texts: str) -> DataFrame:
    """Add the unknown member: key -1, the given texts, null elsewhere."""
    def default(name: str) -> Column:
        if name == "key":
            return F.lit(UNKNOWN)
        return F.lit(texts.get(name))

    row = dimension.sparkSession.range(1).select(
        *[default(f.name).cast(f.dataType).alias(f.name) for f in dimension.schema])
    return dimension.unionAll(row)


def customers_dim(customer: DataFrame, nation: DataFrame, region: DataFrame, **extra: Column) -> DataFrame:
    """Customers with nation and region names; `extra` maps further attributes, such as address or phone."""
    places = nation.join(region, nation.n_regionkey == region.r_regionkey)
    named = customer.join(places, customer.c_nationkey == places.n_nationkey)
    dimension = named.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
                             *[c.alias(n) for n, c in extra.items()],
                             F.col("n_name").alias("nation"), F.col("r_name").alias("region"))
    # Texts of the unknown member.
    texts = {"name": "unknown name", "address": "unknown address", "nation": "unknown nation",
             "region": "unknown region", "phone": "unknown phone number"}
    return with_unknown(dimension, **texts)


def parts_dim(part: DataFrame, **extra: Column) -> DataFrame:
    """Parts under their dimension names; `extra` maps further attributes, such as manufacturer or container."""
    dimension = part.select(
        F.col("p_partkey").alias("key"), F.col("p_name").alias("name"), *[c.alias(n) for n, c in extra.items()],
        F.col("p_brand").alias("brand"), F.col("p_type").alias("type"), F.col("p_size").alias("size"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("price"))
    # Texts of the unknown member.
    texts = {"name": "unknown part", "manufacturer": "unknown manufacturer", "brand": "unknown brand",
             "type": "unknown type", "container": "unknown container"}
    return with_unknown(dimension, **texts)


def _calendar(spark: SparkSession, first: str, last: str, step: str) -> DataFrame:
    return spark.range(1).select(F.explode(F.sequence(
        F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr(f"INTERVAL 1 {step}"))).alias("date"))


def date_dim(spark: SparkSession, first: str = "1992-01-01", last: str = "1998-12-31") -> DataFrame:
    """One row per day plus the unknown member."""
    d = F.col("date")
    days = _calendar(spark, first, last, "DAY").select(
        (F.year(d) * 10000 + F.month(d) * 100 + F.day(d)).cast("bigint").alias("key"), d,
        F.date_format(d, "EEEE").alias("day_of_week_name"), F.dayofweek(d).alias("day_of_week"),
        F.day(d).alias("day_of_month"), F.dayofyear(d).alias("day_of_year"), F.weekofyear(d).alias("week_of_year"),
        F.date_format(d, "MMMM").alias("month_name"), F.month(d).alias("month_number"),
        F.quarter(d).alias("quarter"), F.year(d).alias("year"), (F.weekday(d) >= 5).alias("is_weekend"))
    return with_unknown(days, day_of_week_name="unknown day of week", month_name="unknown month")


def month_dim(spark: SparkSession, first: str = "1992-01-01", last: str = "1998-12-31") -> DataFrame:
    """One row per month plus the unknown member."""
    d = F.col("date")
    months = _calendar(spark, first, last, "MONTH").select(
        (F.year(d) * 100 + F.month(d)).cast("bigint").alias("key"), d, F.date_format(d, "MMMM").alias("month_name"),
        F.month(d).alias("month_number"), F.quarter(d).alias("quarter"), F.year(d).alias("year"),
        F.day(F.last_day(d)).alias("num_days"))
    return with_unknown(months, month_name="unknown month")


def sales_facts(lineitem: DataFrame, orders: DataFrame, commit_date: str = "l_commitdate",
                receipt_date: str = "l_receiptdate") -> DataFrame:
    """One row per order line with dimension keys, flags and net sales."""
    register_functions(lineitem.sparkSession)
    lines = (lineitem.where("l_linenumber IS NOT NULL")
             .join(orders.select("o_orderkey", "o_custkey", "o_orderdate"),
                   F.col("l_orderkey") == F.col("o_orderkey")))

    def money(name: str) -> Column:
        return F.col(name).cast("decimal(18,2)")

    def day_key(name: str) -> Column:
        return F.coalesce(F.expr(f"date_key(CAST({name} AS DATE))"), F.lit(UNKNOWN))

    facts = lines.select(
        F.col("o_orderkey").alias("order_num"), F.col("l_linenumber").alias("line_item_num"),
        F.coalesce("o_custkey", F.lit(UNKNOWN)).alias("customer_key"),
        F.coalesce("l_partkey", F.lit(UNKNOWN)).alias("part_key"),
        money("l_quantity").alias("num_parts"), money("l_extendedprice").alias("gross_sales"),
        money("l_discount").alias("discount"), money("l_tax").alias("tax"),
        (F.col("l_linestatus").eqNullSafe("F")).cast("int").alias("is_fulfilled"),
        (F.col("l_returnflag").eqNullSafe("R")).cast("int").alias("is_returned"),
        day_key("o_orderdate").alias("order_date_key"), day_key(commit_date).alias("commit_date_key"),
        day_key(receipt_date).alias("receipt_date_key"), day_key("l_shipdate").alias("ship_date_key"))
    names = facts.columns
    return (facts.withColumn("net_sales", F.expr("net_sales(gross_sales, discount, tax, is_returned)"))
            .select(*names[:8], "net_sales", *names[8:]))


_MEASURES = ["num_parts", "num_parts_returned", "gross_sales", "sales_returned", "net_sales"]


def daily_sales_snapshot(facts: DataFrame, dates: DataFrame) -> DataFrame:
    """Sales per customer, part and receipt day; days without sales appear with unknown keys and zeros.

    An outer join on the day would bring all sales of a day to one task. Instead the
    calendar's days enter the aggregation as empty rows, and a second grouping level tells
    which days sold nothing, so the sales are shuffled once, by the full grouping key.
    """
    day, who = "receipt_date_key", ["customer_key", "part_key"]

    # A conditional keeps the 18-digit type that sums fast; a product would widen it.
    def if_returned(measure: str) -> Column:
        return F.when(F.col("is_returned") == 1, F.col(measure)).otherwise(F.lit(0)).cast("decimal(18,2)")

    sold = facts.select(
        day, *[F.coalesce(k, F.lit(UNKNOWN)).alias(k) for k in who],
        "num_parts", if_returned("num_parts").alias("num_parts_returned"),
        "gross_sales", if_returned("gross_sales").alias("sales_returned"), "net_sales", F.lit(1).alias("_sold"))
    empty = dates.select(F.col("key").alias(day), *[F.lit(UNKNOWN).alias(k) for k in who],
                         *[F.lit(0).cast("decimal(18,2)").alias(m) for m in _MEASURES], F.lit(0).alias("_sold"))
    groups = (sold.unionByName(empty).groupingSets([[day, *who], [day]], day, *who)
              .agg(*[F.sum(m).alias(m) for m in _MEASURES], F.sum("_sold").alias("_sold"),
                   F.grouping("part_key").alias("_whole_day")))
    kept = groups.where("(_whole_day = 0 AND _sold > 0) OR (_whole_day = 1 AND _sold = 0)")
    # The calendar is bounded by its date range, whatever the size of the facts.
    return (kept.join(F.broadcast(dates.select(F.col("key").alias(day))), day)
            .select(*[F.coalesce(k, F.lit(UNKNOWN)).alias(k) for k in who],
                    *[F.coalesce(m, F.lit(0)).cast(f"decimal({38 if m.endswith('returned') else 28},2)").alias(m)
                      for m in _MEASURES], day))


def monthly_sales_snapshot(daily: DataFrame) -> DataFrame:
    """Daily sales rolled up to receipt months; the unknown day stays -1."""
    day = F.col("receipt_date_key")
    month = F.when(day == UNKNOWN, day).otherwise(F.floor(day / 100).cast("bigint"))
    return (daily.groupBy("customer_key", "part_key", month.alias("receipt_month_key"))
            .agg(*[F.coalesce(F.sum(m), F.lit(0)).cast("decimal(38,2)").alias(m) for m in _MEASURES]))
