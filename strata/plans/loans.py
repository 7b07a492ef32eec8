"""Loan-risk pipeline: cleaning, features, time split, model training and scoring.

Loan applications are derived from orders and customers in the textual shapes such
exports have ('12.5%', 'Jan-1998', '10+ years').
"""

from __future__ import annotations

import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import clean
from strata.operators import quality, scoring
from strata.plans.registry import query
from strata.tables import table

# The statuses that settle a loan, and the one that is good.
SETTLED, GOOD = ["Default", "Charged Off", "Fully Paid"], "Fully Paid"
# The columns that the model is trained on.
CATEGORICAL = ["term", "home_ownership", "purpose", "addr_state", "verification_status", "application_type"]
NUMERIC = ["loan_amnt", "emp_length", "annual_inc", "dti", "delinq_2yrs", "revol_util", "total_acc",
           "credit_length_in_years"]
FEATURES = [*CATEGORICAL, *NUMERIC, "bad_loan", "int_rate", "net", "issue_year"]
SPLIT_YEAR = 1999

# The same expressions are valid in Spark and in DuckDB, except for the date text.
_COLUMNS = """
 o_orderkey AS loan_id,
 CASE o_orderstatus WHEN 'F' THEN 'Fully Paid' WHEN 'O' THEN 'Charged Off'
      ELSE CASE WHEN o_totalprice > 250000 THEN 'Default' ELSE 'Current' END END AS loan_status,
 CONCAT(CAST(5 + o_orderkey % 20 AS VARCHAR(9)), '.', CAST(o_custkey % 10 AS VARCHAR(9)), '%') AS int_rate,
 CASE WHEN o_orderkey % 17 = 0 THEN '' ELSE CONCAT(CAST(o_custkey % 100 AS VARCHAR(9)), '%') END AS revol_util,
 CONCAT('Jan-', CAST(1960 + c_custkey % 30 AS VARCHAR(9))) AS earliest_cr_line,
 CASE WHEN o_orderkey % 13 = 0 THEN 'n/a' WHEN o_orderkey % 13 = 1 THEN '< 1 year'
      WHEN o_orderkey % 13 = 2 THEN '1 year' WHEN o_orderkey % 13 > 10 THEN '10+ years'
      ELSE CONCAT(CAST(o_orderkey % 13 - 1 AS VARCHAR(9)), ' years') END AS emp_length,
 CASE o_custkey % 3 WHEN 0 THEN 'Verified' WHEN 1 THEN 'Source Verified' ELSE 'Not Verified' END AS verification_status,
 o_totalprice AS total_pymnt, CAST(1000 + o_orderkey % 40000 AS DOUBLE) AS loan_amnt,
 c_acctbal AS avg_cur_bal, SUBSTR('ABCDEFG', CAST(1 + c_custkey % 7 AS INT), 1) AS grade,
 CAST(20000 + c_custkey % 90000 AS DOUBLE) AS annual_inc, CAST(o_custkey % 40 AS DOUBLE) AS dti,
 n_name AS addr_state, CASE WHEN o_orderkey % 2 = 0 THEN ' 36 months' ELSE ' 60 months' END AS term,
 CASE c_custkey % 3 WHEN 0 THEN 'RENT' WHEN 1 THEN 'OWN' ELSE 'MORTGAGE' END AS home_ownership,
 c_mktsegment AS purpose, o_orderpriority AS application_type,
 CAST(c_custkey % 4 AS DOUBLE) AS delinq_2yrs, CAST(1 + c_custkey % 50 AS DOUBLE) AS total_acc"""


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    joined = table(spark, sf_dir, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return spark.sql(f"SELECT {_COLUMNS}, date_format(o_orderdate, 'MMM-yyyy') AS issue_d FROM {{joined}}", joined=joined)


def clean_loans(loans: DataFrame) -> DataFrame:
    issue, earliest = clean.year_of_month_text("issue_d"), clean.year_of_month_text("earliest_cr_line")
    cleaned = loans.where(F.col("loan_status").isin(SETTLED)).withColumns({
        "bad_loan": (F.col("loan_status") != GOOD).cast("string"),
        "int_rate": clean.percent("int_rate"), "revol_util": clean.percent("revol_util"),
        "issue_year": issue, "earliest_year": earliest, "credit_length_in_years": issue - earliest,
        "emp_length": clean.employment_years("emp_length"),
        "verification_status": clean.verified_status("verification_status"),
        "net": F.round(F.col("total_pymnt") - F.col("loan_amnt"), 2)})
    return quality.expect(cleaned, [quality.Rule("avg_cur_bal", "avg_cur_bal >= 0", "drop")])


_RAW_SQL = f"""raw AS (SELECT {_COLUMNS}, strftime(o_orderdate, '%b-%Y') AS issue_d
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey),
 clean AS (SELECT * REPLACE (
    CAST(replace(int_rate, '%', '') AS FLOAT) AS int_rate,
    TRY_CAST(replace(revol_util, '%', '') AS FLOAT) AS revol_util,
    CASE WHEN emp_length LIKE '<%' THEN 0 ELSE TRY_CAST(regexp_extract(emp_length, '^([0-9]+)', 1) AS FLOAT) END AS emp_length,
    replace(verification_status, 'Source Verified', 'Verified') AS verification_status),
    CASE WHEN loan_status = 'Fully Paid' THEN 'false' ELSE 'true' END AS bad_loan,
    CAST(substr(issue_d, 5, 4) AS DOUBLE) AS issue_year, CAST(substr(earliest_cr_line, 5, 4) AS DOUBLE) AS earliest_year,
    CAST(substr(issue_d, 5, 4) AS DOUBLE) - CAST(substr(earliest_cr_line, 5, 4) AS DOUBLE) AS credit_length_in_years,
    CAST(CAST(total_pymnt AS DECIMAL(18,2)) - CAST(loan_amnt AS DECIMAL(18,2)) AS DOUBLE) AS net
  FROM raw WHERE loan_status IN ('Default', 'Charged Off', 'Fully Paid') AND avg_cur_bal >= 0)"""


@query(f"WITH {_RAW_SQL} SELECT * FROM clean")
def loan_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_loans(applications(spark, sf_dir))


@query(f"""WITH {_RAW_SQL} SELECT grade, loan_amnt, annual_inc, dti, credit_length_in_years, addr_state, bad_loan, net
           FROM clean WHERE addr_state IS NOT NULL""")
def loan_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = loan_clean(spark, sf_dir).select("grade", "loan_amnt", "annual_inc", "dti", "credit_length_in_years",
                                            "addr_state", "bad_loan", "net")
    return quality.expect(rows, [quality.Rule("valid addr_state", "addr_state IS NOT NULL", "drop")])


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loan_clean(spark, sf_dir).select("loan_id", *FEATURES)


_FEATURE_LIST = ", ".join(["loan_id", *FEATURES])


@query(f"WITH {_RAW_SQL} SELECT {_FEATURE_LIST} FROM clean WHERE issue_year <= {SPLIT_YEAR}")
def split_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features(spark, sf_dir).where(F.col("issue_year") <= SPLIT_YEAR)


@query(f"WITH {_RAW_SQL} SELECT {_FEATURE_LIST} FROM clean WHERE issue_year > {SPLIT_YEAR}")
def split_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features(spark, sf_dir).where(F.col("issue_year") > SPLIT_YEAR)


@query()
def gbt_train_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = scoring.risk_pipeline(CATEGORICAL, NUMERIC, "bad_loan").fit(split_train(spark, sf_dir))
    scored = model.transform(split_valid(spark, sf_dir))
    return scored.select("loan_id", "bad_loan", "prediction", vector_to_array("probability")[1].alias("risk"))


def _points(batch: pd.DataFrame) -> pd.Series:
    """A fixed scorecard, standing in for a fitted model."""
    score = batch["dti"] * 2 + batch["delinq_2yrs"] * 15 + batch["int_rate"].astype("float64").round() - batch["total_acc"]
    return (score > 40).astype("float64")


@query(f"""WITH {_RAW_SQL} SELECT loan_id, bad_loan,
             CASE WHEN dti * 2 + delinq_2yrs * 15 + round_even(CAST(int_rate AS DOUBLE), 0) - total_acc > 40
                  THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
           FROM clean WHERE issue_year > {SPLIT_YEAR}""")
def score_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    scoring.register_scorer(spark, "loan_risk_scoring", _points, "double")
    split_valid(spark, sf_dir).createOrReplaceTempView("valid_loans")
    return spark.sql("""SELECT loan_id, bad_loan, loan_risk_scoring(named_struct(
                          'dti', dti, 'delinq_2yrs', delinq_2yrs, 'int_rate', int_rate, 'total_acc', total_acc)) AS prediction
                        FROM valid_loans""")
