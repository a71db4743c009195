"""Queries for counts and column profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.operators import profile
from quarryline.operators.split import train_test_split
from quarryline.operators.transform import savings_code
from quarryline.queries.catalog import query, rounded
from quarryline.queries.tables import LOAN, NUMBERED, etl_transform
from quarryline.queries.views import loan, table


@query("SELECT count(*) AS n_rows, CAST(11 AS INTEGER) AS n_columns FROM lineitem")
def table_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.table_shape(table(spark, sf_dir, "lineitem"))


@query(f"{LOAN} SELECT target, count(*) AS n FROM loan GROUP BY target")
def class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.class_counts(loan(spark, sf_dir, "target"), "target")


@query(
    f"""{LOAN}, parts AS (
      SELECT target, CASE WHEN row_number() OVER (ORDER BY
        CAST('0x' || substr(md5('42:' || CAST(app_id AS VARCHAR)), 1, 12) AS BIGINT), app_id)
        <= ceil(CAST(0.2 AS DOUBLE) * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split
      FROM loan)
    SELECT split, target, count(*) AS n,
           round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY split), 6) AS share
    FROM parts GROUP BY split, target"""
)
def class_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = train_test_split(loan(spark, sf_dir, "target"), "app_id")
    return rounded(profile.class_balance(parts, "target", "split"), 6, "share")


def _numeric_line(column: str) -> str:
    return f"""
    SELECT '{column}' AS "column", count(x) AS non_null, count(*) - count(x) AS nulls,
      round((count(*) - count(x)) / CAST(count(*) AS DOUBLE), 6) AS pct_null,
      count(*) FILTER (x = 0) AS zeros,
      round(count(*) FILTER (x = 0) / CAST(count(*) AS DOUBLE), 6) AS pct_zeros,
      round(avg(x), 4) AS mean, round(stddev_samp(x), 4) AS sd,
      round(stddev_samp(x) / avg(x), 6) AS coef_var,
      round(avg(pow(x - m, 3)) / pow(stddev_pop(x), 3), 6) AS skew,
      round(avg(pow(x - m, 4)) / pow(stddev_pop(x), 4) - 3, 6) AS kurtosis,
      min(x) AS min,
      round(quantile_cont(x, 0.10), 4) AS p10, round(quantile_cont(x, 0.25), 4) AS p25,
      round(quantile_cont(x, 0.50), 4) AS p50, round(quantile_cont(x, 0.75), 4) AS p75,
      round(quantile_cont(x, 0.90), 4) AS p90, max(x) AS max
    FROM (SELECT {column} AS x, avg({column}) OVER () AS m FROM edited)"""


EDITED = f"""{NUMBERED}, edited AS (
  SELECT CASE WHEN place BETWEEN 10 AND 53 THEN CAST(0 AS DOUBLE) ELSE credit_amount END
           AS credit_amount,
         CASE WHEN place BETWEEN 0 AND 45 THEN NULL ELSE duration END AS duration,
         CASE WHEN place BETWEEN 25 AND 74 THEN NULL ELSE checking_status END AS checking_status,
         purpose, savings_status, CAST(foreign_worker AS VARCHAR) AS foreign_worker
  FROM numbered)"""


@query(f"{EDITED} {_numeric_line('credit_amount')} UNION ALL {_numeric_line('duration')}")
def numeric_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = etl_transform(spark, sf_dir)
    lines = profile.numeric_summary(df, ["credit_amount", "duration"])
    lines = rounded(lines, 4, "mean", "sd", *profile.PERCENTILES)
    return rounded(lines, 6, "pct_null", "pct_zeros", "coef_var", "skew", "kurtosis")


@query(
    EDITED
    + ", long AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {c} AS value FROM edited"
        for c in ("checking_status", "purpose", "savings_status", "foreign_worker")
    )
    + """), counts AS (SELECT "column", value, count(*) AS n FROM long GROUP BY ALL),
    top AS (SELECT "column", value, row_number() OVER (PARTITION BY "column"
              ORDER BY n DESC, value) AS place FROM counts WHERE value IS NOT NULL)
    SELECT c."column", CAST(coalesce(sum(n) FILTER (c.value IS NOT NULL), 0) AS BIGINT) AS non_null,
      CAST(coalesce(sum(n) FILTER (c.value IS NULL), 0) AS BIGINT) AS nulls,
      round(coalesce(sum(n) FILTER (c.value IS NULL), 0) / CAST(sum(n) AS DOUBLE), 6) AS pct_null,
      min(t.value) AS most_frequent, count(c.value) AS "unique",
      round(count(c.value) / CAST(sum(n) AS DOUBLE), 6) AS pct_unique
    FROM counts c LEFT JOIN top t ON t."column" = c."column" AND t.place = 1
    GROUP BY c."column" """
)
def non_numeric_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = etl_transform(spark, sf_dir)
    lines = profile.non_numeric_summary(
        df, ["checking_status", "purpose", "savings_status", "foreign_worker"]
    )
    return rounded(lines, 6, "pct_null", "pct_unique")


@query(f"{EDITED} SELECT DISTINCT checking_status FROM edited")
def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distinct_values(etl_transform(spark, sf_dir), "checking_status")


@query(
    f"""{LOAN} SELECT DISTINCT savings_status, CAST(CASE savings_status
      WHEN 'no known savings' THEN 0 WHEN '<100' THEN 1 WHEN '100<=X<500' THEN 2
      WHEN '500<=X<1000' THEN 3 ELSE 4 END AS DOUBLE) AS code FROM loan ORDER BY code"""
)
def savings_code_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = loan(spark, sf_dir, "savings_status")
    coded = df.select("savings_status", savings_code(F.col("savings_status")).alias("code"))
    return coded.distinct().orderBy("code")
