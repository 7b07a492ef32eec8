import pandas as pd
import pytest
from pyspark.sql import functions as F

from strata.functions import clean
from strata.operators import scoring, star


def test_pipeline_learns_a_simple_rule_and_accepts_unseen_categories(spark):
    data = spark.range(400).select(
        F.when(F.col("id") % 2 == 0, "own").otherwise("rent").alias("home"), (F.col("id") % 50).cast("double").alias("dti"),
        (F.col("id") % 50 > 25).cast("string").alias("bad"))
    model = scoring.risk_pipeline(["home"], ["dti"], "bad", max_iter=2, max_depth=2).fit(data)
    fresh = spark.createDataFrame([("boat", 40.0, "true"), ("own", None, "false"), ("rent", 3.0, "false")], data.schema)
    predictions = [r.prediction for r in model.transform(fresh).collect()]
    assert predictions[0] == 1.0 and predictions[2] == 0.0


def test_registered_scorer_uses_the_shipped_model(spark, rows):
    scoring.register_scorer(spark, "weighted", lambda batch, weight: batch["x"] * weight, "double", model=2.5)
    spark.createDataFrame([(1.0,), (4.0,)], "x DOUBLE").createOrReplaceTempView("to_score")
    assert rows(spark.sql("SELECT weighted(named_struct('x', x)) AS y FROM to_score")) == [(10.0,), (2.5,)]


@pytest.mark.parametrize("given, expected", [("10+ years", 10.0), ("< 1 year", 0.0), ("1 year", 1.0), ("n/a", None), ("", None),
                                             ("7 years", 7.0), (None, None)])
def test_employment_years(spark, given, expected):
    assert spark.createDataFrame([(given,)], "e STRING").select(clean.employment_years("e")).first()[0] == expected


def test_star_functions(spark):
    star.register_functions(spark)
    row = spark.sql("SELECT date_key(DATE '1995-03-04'), net_sales(68423.46, 0.05, 0.03, 0), net_sales(10, 0, 0, 1)").first()
    assert [str(v) for v in row] == ["19950304", "66952.36", "0.00"]


def test_calendar(spark):
    days, months = star.date_dim(spark), star.month_dim(spark)
    assert (days.count(), months.count()) == (2557 + 1, 84 + 1)
    assert days.where("key = -1").first().day_of_week_name == "unknown day of week"
    assert months.where("key = 199602").first().num_days == 29
    assert days.where("is_weekend").count() == sum(d.dayofweek >= 5 for d in pd.date_range("1992-01-01", "1998-12-31"))


def test_days_without_sales_appear_once(spark, rows):
    facts = spark.createDataFrame([(20240101, 7, 3, 2.0, 10.0, 1, 0.0), (20240101, 7, 3, 1.0, 5.0, 0, 4.0), (20240103, -1, -1, 1.0, 1.0, 0, 1.0),
                                   (19000101, 1, 1, 1.0, 1.0, 0, 1.0)],
                                  "receipt_date_key BIGINT, customer_key BIGINT, part_key BIGINT, q DOUBLE, g DOUBLE, is_returned INT, n DOUBLE")
    facts = facts.select("receipt_date_key", "customer_key", "part_key", "is_returned",
                         *[F.col(a).cast("decimal(18,2)").alias(b) for a, b in (("q", "num_parts"), ("g", "gross_sales"), ("n", "net_sales"))])
    daily = star.daily_sales_snapshot(facts, star.date_dim(spark, "2024-01-01", "2024-01-03"))
    found = sorted((r.receipt_date_key, r.customer_key, float(r.num_parts), float(r.num_parts_returned), float(r.net_sales))
                   for r in daily.collect())
    assert found == [(-1, -1, 0, 0, 0), (20240101, 7, 3, 2, 4), (20240102, -1, 0, 0, 0), (20240103, -1, 1, 0, 1)]
    monthly = star.monthly_sales_snapshot(daily)
    assert sorted((r.receipt_month_key, r.customer_key, float(r.num_parts)) for r in monthly.collect()) == [
        (-1, -1, 0), (202401, -1, 1), (202401, 7, 3)]
