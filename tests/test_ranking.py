import pytest
from pyspark.sql import functions as F

from strata.operators import ranking


@pytest.fixture(scope="module")
def dated(spark):
    day = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise((F.col("id") * 37) % 50).cast("int")
    base = spark.range(600).select("id", F.date_add(F.lit("2024-01-01").cast("date"), day).alias("day"))
    return base.withColumn("at", F.col("day").cast("timestamp")).cache()


@pytest.mark.parametrize("column", ["day", "at"])
@pytest.mark.parametrize("n", [0, 1, 17, 250, 599, 600, 900])
def test_first_n(dated, column, n):
    expected = sorted((r[column], r.id) for r in dated.collect())[:n]
    assert sorted((r[column], r.id) for r in ranking.first_n(dated, [column, "id"], n).collect()) == expected


def test_row_numbers(dated):
    expected = sorted((r.day, r.id) for r in dated.collect())
    numbered = ranking.row_numbers(dated, ["day", "id"]).collect()
    assert [(r.day, r.id) for r in sorted(numbered, key=lambda r: r.row_num)] == expected
    assert sorted(r.row_num for r in numbered) == list(range(1, 601))


def test_zip_rows_stops_at_the_shorter_side(spark, rows):
    left = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "k INT, l STRING")
    right = spark.createDataFrame([(20, "y"), (10, "x")], "j INT, r STRING")
    assert rows(ranking.zip_rows(left, ["k"], right, ["j"]).select("l", "r")) == [("a", "x"), ("b", "y")]


@pytest.mark.parametrize("n", [0, 50, 100, 300, 1000])
def test_first_n_places_nulls_and_nan_as_spark_does(spark, n):
    values = spark.range(1000).select("id", F.when(F.col("id") % 10 == 0, None).when(F.col("id") % 10 == 1, float("nan"))
                                      .otherwise(F.col("id") * 9e14).alias("v"))
    expected = [r.id for r in values.orderBy("v", "id").collect()][:n]
    assert sorted(r.id for r in ranking.first_n(values, ["v", "id"], n).collect()) == sorted(expected)
