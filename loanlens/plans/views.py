"""Role views over the given tables.

The mapping of the tables to raw origination rows, performance events and scores is plain
SQL that Spark and other engines read alike.  Dirt (sentinels, padding, lower case, broken
dates) is put in by arithmetic on the keys, so cleaning has work to do on every table size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loanlens.session import split_wide_methods

LOAN_ID = """concat(
  CASE WHEN {k} % 251 = 0 THEN 'X' WHEN {k} % 2 = 0 THEN 'F' ELSE 'A' END,
  lpad(CAST({k} % 100 AS STRING), 2, '0'), 'Q', CAST(1 + {k} % 4 AS STRING),
  CASE WHEN {k} < 10000000 THEN lpad(CAST({k} AS STRING), 7, '0') ELSE CAST({k} AS STRING) END)"""


def loan_id(key: str) -> str:
    return LOAN_ID.replace("{k}", key)


def _yyyymm(index: str) -> str:
    return f"CAST(CAST(floor(({index}) / 12) AS BIGINT) * 100 + ({index}) % 12 + 1 AS STRING)"


_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'"

ORIGINATION = f"""
SELECT
  CASE WHEN k % 17 = 0 THEN '9999' WHEN k % 103 = 0 THEN 'n/a' WHEN k % 97 = 0 THEN '290'
       ELSE CAST(300 + (k * 7) % 551 AS STRING) END AS credit_score,
  CASE WHEN k % 113 = 0 THEN '200513'
       WHEN k % 127 = 0 THEN concat(' ', {_yyyymm("start")}, ' ')
       ELSE {_yyyymm("start")} END AS first_payment_date,
  CASE k % 5 WHEN 0 THEN '9' WHEN 1 THEN 'y' WHEN 2 THEN ' N ' ELSE 'N' END
    AS first_time_homebuyer_flag,
  {_yyyymm("start + term - 1 + CASE WHEN k % 29 = 0 THEN 2 WHEN k % 211 = 0 THEN -term - 5 ELSE 0 END")}
    AS maturity_date,
  CASE WHEN k % 6 = 0 THEN NULL ELSE CAST(10000 + cust % 400 AS STRING) END AS msa,
  CASE WHEN k % 13 = 0 THEN '999' WHEN k % 59 = 0 THEN '60' ELSE CAST(k % 56 AS STRING) END
    AS mi_percentage,
  CASE WHEN k % 19 = 0 THEN '99' ELSE CAST(1 + k % 4 AS STRING) END AS number_of_units,
  CASE WHEN k % 23 = 0 THEN '9' WHEN status = 'P' THEN 'p' WHEN status = 'F' THEN ' I '
       ELSE 'S' END AS occupancy_status,
  CASE WHEN k % 31 = 0 THEN '999' ELSE CAST(ltv + k % 20 AS STRING) END AS original_cltv,
  CASE WHEN k % 37 = 0 THEN '999' WHEN k % 89 = 0 THEN '0'
       ELSE CAST(1 + (k * 3) % 65 AS STRING) END AS original_dti,
  CASE WHEN k % 11 = 0 THEN concat(CAST(upb AS STRING), '.0') ELSE CAST(upb AS STRING) END
    AS original_upb,
  CASE WHEN k % 41 = 0 THEN '999' ELSE CAST(ltv AS STRING) END AS original_ltv,
  CASE WHEN k % 301 = 0 THEN '0'
       ELSE concat(CAST(3 + (k * 13) % 5 AS STRING), '.', lpad(CAST(k % 1000 AS STRING), 3, '0'))
       END AS original_interest_rate,
  CASE k % 7 WHEN 0 THEN '9' WHEN 1 THEN 'r' WHEN 2 THEN 'B' WHEN 3 THEN 'C' WHEN 4 THEN ' t'
       WHEN 5 THEN 'X' ELSE 'R' END AS channel,
  CASE WHEN k % 3 = 0 THEN 'Y' ELSE 'N' END AS prepayment_penalty_flag,
  CASE WHEN priority = '1-URGENT' THEN 'ARM' ELSE 'FRM' END AS amortization_type,
  CASE WHEN k % 47 = 0 THEN 'n1' WHEN k % 53 = 0 THEN NULL
       ELSE concat(substr({_LETTERS}, CAST(1 + cust % 5 AS INT), 1),
                   substr({_LETTERS}, CAST(1 + cust % 11 AS INT), 1)) END AS property_state,
  CASE WHEN k % 43 = 0 THEN '99' WHEN k % 5 = 0 THEN 'CO' WHEN k % 5 = 1 THEN 'PU'
       WHEN k % 5 = 2 THEN 'MH' WHEN k % 5 = 3 THEN 'SF' ELSE 'CP' END AS property_type,
  CAST(10000 + (cust * 37) % 90000 AS STRING) AS postal_code,
  {loan_id("k")} AS loan_sequence_number,
  CASE WHEN k % 29 = 0 THEN '9' WHEN k % 3 = 0 THEN 'P' WHEN k % 3 = 1 THEN 'C' ELSE 'N' END
    AS loan_purpose,
  CAST(term AS STRING) AS original_loan_term,
  CASE WHEN k % 61 = 0 THEN '99' ELSE CAST(1 + k % 2 AS STRING) END AS number_of_borrowers,
  priority AS seller_name,
  concat('servicer ', status) AS servicer_name,
  CAST(NULL AS STRING) AS super_conforming_flag,
  CAST(NULL AS STRING) AS pre_relief_refinance_loan_sequence_number,
  CASE WHEN k % 2 = 0 THEN '9' ELSE 'H' END AS special_eligibility_program,
  CAST(NULL AS STRING) AS relief_refinance_indicator,
  CASE WHEN k % 3 = 0 THEN '7' ELSE '2' END AS property_valuation_method,
  CASE WHEN k % 16 = 0 THEN 'Y' ELSE 'n' END AS interest_only_indicator,
  CASE WHEN k % 4 = 0 THEN '7' WHEN k % 4 = 1 THEN '9' ELSE 'N' END AS mi_cancellation_indicator,
  CAST(yr AS INT) AS year
FROM (
  SELECT o_orderkey AS k, o_custkey AS cust, o_orderstatus AS status,
         o_orderpriority AS priority,
         CAST(floor(o_totalprice) AS BIGINT) AS upb,
         6 + (o_orderkey * 11) % 100 AS ltv,
         CASE o_orderkey % 4 WHEN 0 THEN 180 WHEN 1 THEN 240 ELSE 360 END AS term,
         year(o_orderdate) AS yr,
         year(o_orderdate) * 12 + month(o_orderdate) - 1 AS start
  FROM {{orders}}
) AS o
"""

PERFORMANCE = f"""
SELECT
  {loan_id("l_orderkey")} AS loan_sequence_number,
  CAST(year(l_shipdate) * 100 + month(l_shipdate) AS STRING) AS monthly_reporting_period,
  l_extendedprice AS current_actual_upb,
  CASE WHEN l_linenumber = 7 THEN 'RA' ELSE CAST(l_linenumber AS STRING) END
    AS current_loan_delinquency_status,
  CASE WHEN l_returnflag = 'R' AND ((l_orderkey * 7) % 551 < 120 OR l_quantity >= 48)
         THEN CASE WHEN l_linenumber % 3 = 0 THEN '09' WHEN l_linenumber % 3 = 1 THEN ' 3 '
              ELSE '2.0' END
       WHEN l_returnflag = 'R' AND l_quantity < 3 THEN 'RA'
       WHEN l_returnflag = 'R' AND l_quantity < 6 THEN '103'
       WHEN l_returnflag = 'A' THEN '01'
       ELSE NULL END AS zero_balance_code
FROM {{lineitem}}
"""

# Model-free scores with ties, higher for the loans that default more often.
SCORES = f"""
SELECT {loan_id("o_orderkey")} AS loan_sequence_number,
       CAST(year(o_orderdate) AS INT) AS year,
       CAST((o_orderkey * 7919 + o_custkey * 31) % 8009
            + CASE WHEN (o_orderkey * 7) % 551 < 120 THEN 1500 ELSE 0 END AS DOUBLE) / 10007
         AS probability_default
FROM {{orders}}
"""

VIEWS = {"origination": ORIGINATION, "performance": PERFORMANCE, "scores": SCORES}
TABLES = ("orders", "lineitem", "customer", "nation", "documents", "labels", "events")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    split_wide_methods(spark)
    text = VIEWS[name]
    used = {t: table(spark, sf_dir, t) for t in TABLES if f"{{{t}}}" in text}
    return spark.sql(text, **used)


def view_sql(name: str) -> str:
    """The view over tables that are known by their own names."""
    text = VIEWS[name]
    for t in TABLES:
        text = text.replace(f"{{{t}}}", t)
    return text.strip()
