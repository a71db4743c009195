"""Queries for sources and sinks, projections, row edits and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.functions import scalars
from quarryline.operators import edit
from quarryline.operators.split import train_test_split
from quarryline.plans.etl import transform
from quarryline.queries.catalog import query, rounded, stamp
from quarryline.queries.views import (
    LOAN_SQL,
    PARAM_SQL,
    RUN_SQL,
    SCHEMAS,
    TRIAL_SCORES_SQL,
    TRIAL_SQL,
    loan,
    run,
    table,
    trial,
    trial_scores,
    with_views,
)
from quarryline.session import new_path
from quarryline.sources import tables as io

LOAN = with_views(LOAN_SQL)
TRIAL = with_views(TRIAL_SQL)
PARAM = with_views(TRIAL_SQL, PARAM_SQL)
RUN = with_views(RUN_SQL)


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return io.read_table(spark, f"{sf_dir}/customer.parquet", SCHEMAS["customer"])


@query(f"{LOAN} SELECT count(*) AS n_rows, CAST(8 AS INTEGER) AS n_columns FROM loan")
def extract_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = new_path(spark, "raw")
    features = loan(spark, sf_dir).drop("target")
    io.extract(features, loan(spark, sf_dir, "target"), "app_id", raw)
    stored = spark.read.parquet(raw)
    return stored.agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(len(stored.columns)).alias("n_columns")
    )


@query(f"{LOAN} SELECT * FROM loan")
def processed_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "processed")
    io.write_table(loan(spark, sf_dir), path)
    return io.read_table(spark, path)


@query(
    f"""{LOAN}, split AS (
      SELECT app_id, target, row_number() OVER (ORDER BY
        CAST('0x' || substr(md5('42:' || CAST(app_id AS VARCHAR)), 1, 12) AS BIGINT), app_id)
        <= ceil(CAST(0.2 AS DOUBLE) * count(*) OVER ()) AS is_test FROM loan)
    SELECT app_id, target, CASE WHEN is_test THEN 'test' ELSE 'train' END AS split FROM split"""
)
def artifact_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_path(spark, "store")
    io.save_dataset(train_test_split(loan(spark, sf_dir, "target"), "app_id"), root, "1")
    absent = io.load_dataset(spark, root, "2")
    if absent is not None:
        raise AssertionError("a run without a data set must give None")
    return io.load_dataset(spark, root, "1").select("app_id", "target", "split")


@query(
    f"""{with_views(TRIAL_SQL, TRIAL_SCORES_SQL)}
    SELECT t.trial_id, t.model, t.max_depth, s.fold, s.score
    FROM trial t JOIN trial_scores s ON s.trial_id = t.trial_id"""
)
def trial_results_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_path(spark, "store")
    io.save_results(trial(spark, sf_dir), trial_scores(spark, sf_dir), root, "1")
    trials, scores = io.load_results(spark, root, "1")
    kept = trials.select(
        "trial_id", "model", F.col("params")["model__max_depth"].alias("max_depth")
    )
    return kept.join(scores, "trial_id")


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def drop_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").drop("o_orderstatus", "o_orderdate")


@query(f"{LOAN} SELECT app_id, credit_amount, duration FROM loan")
def select_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = loan(spark, sf_dir)
    return df.select(edit.numeric_columns(df))


@query(
    f"""{LOAN} SELECT checking_status, purpose, savings_status, foreign_worker, target
    FROM loan"""
)
def select_non_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = loan(spark, sf_dir)
    return df.select(edit.non_numeric_columns(df))


@query(f"{LOAN} SELECT checking_status, purpose, foreign_worker, target FROM loan")
def select_non_numeric_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = loan(spark, sf_dir)
    return df.select(edit.non_numeric_columns(df, leave_out=["savings_status"]))


NUMBERED = (
    f"{LOAN}, numbered AS (SELECT *, row_number() OVER (ORDER BY app_id) - 1 AS place FROM loan)"
)


@query(
    f"""{NUMBERED} SELECT app_id,
    CASE WHEN place BETWEEN 0 AND 45 THEN NULL ELSE duration END AS duration FROM numbered"""
)
def inject_null_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit.edit_rows(
        loan(spark, sf_dir, "duration"), "app_id", [edit.RowRange("duration", 0, 46)]
    )


@query(
    f"""{NUMBERED} SELECT app_id,
    CASE WHEN place BETWEEN 25 AND 74 THEN NULL ELSE checking_status END AS checking_status
    FROM numbered"""
)
def inject_null_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit.edit_rows(
        loan(spark, sf_dir, "checking_status"),
        "app_id",
        [edit.RowRange("checking_status", 25, 75)],
    )


@query(
    f"""{NUMBERED} SELECT app_id,
    CASE WHEN place BETWEEN 10 AND 53 THEN CAST(0 AS DOUBLE) ELSE credit_amount END
      AS credit_amount FROM numbered"""
)
def inject_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit.edit_rows(
        loan(spark, sf_dir, "credit_amount"),
        "app_id",
        [edit.RowRange("credit_amount", 10, 54, 0.0)],
    )


@query(
    f"""{NUMBERED} SELECT app_id,
    CASE WHEN place BETWEEN 10 AND 53 THEN CAST(0 AS DOUBLE) ELSE credit_amount END
      AS credit_amount,
    CASE WHEN place BETWEEN 0 AND 45 THEN NULL ELSE duration END AS duration,
    CASE WHEN place BETWEEN 25 AND 74 THEN NULL ELSE checking_status END AS checking_status,
    purpose, savings_status, foreign_worker, target FROM numbered"""
)
def etl_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transform(loan(spark, sf_dir), "app_id")


@query(f"{TRIAL} SELECT trial_id, model, score FROM trial WHERE model = 'RandomForestClassifier()'")
def trials_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    trials = trial(spark, sf_dir).filter("model == 'RandomForestClassifier()'")
    return trials.select("trial_id", "model", "score")


@query(f"{TRIAL} SELECT trial_id, model, score FROM trial ORDER BY trial_id LIMIT 500")
def trials_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trial(spark, sf_dir).select("trial_id", "model", "score").orderBy("trial_id").limit(500)


@query(
    """SELECT p_partkey,
    CASE WHEN p_size % 3 = 0 THEN p_name WHEN p_size % 3 = 1 THEN p_brand || '_' || p_type
         ELSE 'savings_status__' || p_type END AS feature
    FROM part"""
)
def feature_name_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    size = F.col("p_size") % 3
    encoded = (
        F.when(size == 0, F.concat(F.lit("numeric__"), "p_name"))
        .when(size == 1, F.concat(F.lit("non_numeric__"), "p_brand", F.lit("_"), "p_type"))
        .otherwise(F.concat(F.lit("savings_status__"), "p_type"))
    )
    return part.select("p_partkey", scalars.clean_feature_name(encoded).alias("feature"))


@query(f"{PARAM} SELECT trial_id, param AS name, value FROM param")
def rename_trial_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    renamed = scalars.friendly_params(F.col("params"))
    return trial(spark, sf_dir).select("trial_id", F.explode(renamed).alias("name", "value"))


@query(f"{PARAM} SELECT trial_id, path AS name, value FROM param WHERE path <> 'model'")
def params_without_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    logged = scalars.without_model(F.col("params"))
    return trial(spark, sf_dir).select("trial_id", F.explode(logged).alias("name", "value"))


@query(
    f"""{LOAN} SELECT app_id, CAST(CASE WHEN target = 'bad' THEN 1 ELSE 0 END AS INTEGER) AS label
    FROM loan"""
)
def label_binarize(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = loan(spark, sf_dir, "target")
    return df.select("app_id", scalars.binary_label(F.col("target")).alias("label"))


@query(f"{RUN} SELECT run_id, strftime(start_time, '%Y_%m_%d_%H_%M_%S') AS name FROM run")
def run_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir).select(
        "run_id", scalars.run_name(F.col("start_time")).alias("name")
    )


@query(
    f"""{RUN} SELECT run_id, strftime(make_timestamp((start_us // 1000) * 1000),
    '%Y-%m-%d %H:%M:%S.%f') AS started FROM run"""
)
def epoch_ms_to_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ms = F.unix_millis("start_time")
    return run(spark, sf_dir).select(
        "run_id", stamp(scalars.epoch_ms_to_timestamp(ms)).alias("started")
    )


@query(
    f"""{RUN} SELECT run_id, round((end_us - start_us) / CAST(1000000 AS DOUBLE), 2) AS seconds
    FROM run"""
)
def elapsed_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = scalars.elapsed_seconds(F.col("start_time"), F.col("end_time"))
    return rounded(run(spark, sf_dir).select("run_id", seconds.alias("seconds")), 2, "seconds")


@query(
    f"""{NUMBERED} SELECT app_id, CASE WHEN place BETWEEN 25 AND 74 THEN '<missing>'
    ELSE checking_status END AS checking_status FROM numbered"""
)
def fill_missing_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = inject_null_category(spark, sf_dir)
    return df.withColumn("checking_status", scalars.fill_missing(F.col("checking_status")))
