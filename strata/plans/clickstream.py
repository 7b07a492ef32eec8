"""Click-stream pipeline: raw text columns, cleaned clicks, top referrers and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import quality
from strata.plans.registry import query
from strata.tables import table

RULES = [
    quality.Rule("valid_current_page", "current_page_id IS NOT NULL AND current_page_title IS NOT NULL"),
    quality.Rule("valid_count", "click_count > 0", "fail"),
]

_SQL = """clicks AS (SELECT CAST(user_id AS INTEGER) AS current_page_id,
                 'page_' || json_extract_string(props, '$.k') AS current_page_title,
                 CAST(floor(value) AS INTEGER) + 1 AS click_count, CAST(event_id AS INTEGER) AS previous_page_id,
                 event_type || '_' || user_id AS previous_page_title FROM events)"""


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the shape of a click-stream export: every column is text."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("curr_id"),
        F.concat(F.lit("page_"), F.get_json_object("props", "$.k")).alias("curr_title"),
        (F.floor("value") + 1).cast("string").alias("n"), F.col("event_id").cast("string").alias("prev_id"),
        F.concat_ws("_", "event_type", "user_id").alias("prev_title"))


def clean_clicks(clicks: DataFrame) -> DataFrame:
    typed = clicks.select(
        F.col("curr_id").try_cast("int").alias("current_page_id"), F.col("curr_title").alias("current_page_title"),
        F.col("n").try_cast("int").alias("click_count"), F.col("prev_id").try_cast("int").alias("previous_page_id"),
        F.col("prev_title").alias("previous_page_title"))
    return quality.expect(typed, RULES)


@query(f"WITH {_SQL} SELECT * FROM clicks")
def expect_or_fail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_clicks(raw(spark, sf_dir))


@query(f"""WITH {_SQL} SELECT previous_page_title AS referrer, click_count FROM clicks
           WHERE current_page_title = 'page_42' ORDER BY click_count DESC, referrer LIMIT 10""")
def top_referrers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (clean_clicks(raw(spark, sf_dir)).where("current_page_title = 'page_42'")
            .select(F.col("previous_page_title").alias("referrer"), "click_count")
            .orderBy(F.desc("click_count"), "referrer").limit(10))


@query(f"""WITH {_SQL} SELECT current_page_title, CAST(SUM(click_count) AS BIGINT) AS total_clicks FROM clicks
           GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50""")
def top_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (clean_clicks(raw(spark, sf_dir)).groupBy("current_page_title")
            .agg(F.sum("click_count").alias("total_clicks"))
            .orderBy(F.desc("total_clicks"), "current_page_title").limit(50))
