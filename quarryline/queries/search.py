"""Queries for splits, folds, prior samples and trial plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.functions import sampling
from quarryline.functions.hashing import unit_draw
from quarryline.operators import split
from quarryline.operators.search_space import (
    Choice,
    Integer,
    Space,
    classification_spaces,
    plan_trials,
    regression_spaces,
)
from quarryline.queries.catalog import query
from quarryline.queries.views import table

HASH = "CAST('0x' || substr(md5({0}), 1, 12) AS BIGINT)"
DRAW = f"({HASH} / CAST(281474976710656 AS DOUBLE))"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey")


@query(
    f"""SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY
      {HASH.format("'42:' || CAST(o_orderkey AS VARCHAR)")}, o_orderkey)
      <= ceil(CAST(0.2 AS DOUBLE) * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split
    FROM orders"""
)
def train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.train_test_split(_orders(spark, sf_dir), "o_orderkey", 0.2, 42)


def _fold(seed: int) -> str:
    order = HASH.format(f"'{seed}:' || CAST(o_orderkey AS VARCHAR)")
    return f"CAST(ntile(3) OVER (ORDER BY {order}, o_orderkey) - 1 AS INTEGER)"


@query(f"SELECT o_orderkey, {_fold(42)} AS fold_0, {_fold(43)} AS fold_1 FROM orders")
def repeated_kfold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.repeated_kfold(_orders(spark, sf_dir), "o_orderkey", 3, 2, 42)


def _sampled(spark: SparkSession, sf_dir: str, name: str, draw) -> DataFrame:
    u: Column = unit_draw(42, F.col("o_orderkey"), name)
    return _orders(spark, sf_dir).select("o_orderkey", draw(u).alias(name))


def _sample_sql(name: str, value: str) -> str:
    draw = DRAW.format(f"'42:' || CAST(o_orderkey AS VARCHAR) || ':{name}'")
    return f"SELECT o_orderkey, {value} AS {name} FROM (SELECT o_orderkey, {draw} AS u FROM orders)"


@query(_sample_sql("criterion", "CASE WHEN u < 0.5::DOUBLE THEN 'gini' ELSE 'entropy' END"))
def sample_categorical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sampled(
        spark, sf_dir, "criterion", lambda u: sampling.categorical(u, ["gini", "entropy"])
    )


@query(
    _sample_sql(
        "imputer",
        "CASE WHEN u < 0.5::DOUBLE THEN 'mean' WHEN u < 0.75::DOUBLE THEN 'median' ELSE 'mode' END",
    )
)
def sample_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sampled(
        spark,
        sf_dir,
        "imputer",
        lambda u: sampling.categorical(u, ["mean", "median", "mode"], [0.5, 0.25, 0.25]),
    )


@query(_sample_sql("max_features", "round(0.01::DOUBLE + u * (0.95 - 0.01)::DOUBLE, 9)"))
def sample_uniform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sampled(
        spark, sf_dir, "max_features", lambda u: F.round(sampling.uniform(u, 0.01, 0.95), 9)
    )


@query(
    _sample_sql("c", "round(exp(ln(1e-6::DOUBLE) + u * (ln(100::DOUBLE) - ln(1e-6::DOUBLE))), 9)")
)
def sample_loguniform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sampled(spark, sf_dir, "c", lambda u: F.round(sampling.log_uniform(u, 1e-6, 100), 9))


@query(_sample_sql("max_depth", "CAST(1 + floor(u * 100) AS BIGINT)"))
def sample_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sampled(spark, sf_dir, "max_depth", lambda u: sampling.integer(u, 1, 100))


@query(_sample_sql("min_child_weight", "CAST(round(exp(u * ln(50::DOUBLE))) AS BIGINT)"))
def sample_int_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sampled(spark, sf_dir, "min_child_weight", lambda u: sampling.integer_log(u, 1, 50))


def _plan_sql(spaces: Sequence[Space], iterations: int) -> str:
    """The plan as SQL: the priors as a table of values, the draws as a CASE over their kind."""
    priors, slots = [], []
    for space_id, space in enumerate(spaces):
        for iteration in range(iterations if space.tuned else 1):
            slots.append(f"({len(slots)}, {space_id}, {iteration}, '{space.model}')")
        for name, prior in space.params.items():
            if isinstance(prior, Choice):
                options = ", ".join("'" + o.replace("'", "''") + "'" for o in prior.options)
                weights = prior.weights or [1 / len(prior.options)] * len(prior.options)
                edges = ", ".join(
                    repr(sum(weights[: i + 1])) + "::DOUBLE" for i in range(len(weights) - 1)
                )
                line = f"'choice', NULL::DOUBLE, NULL::DOUBLE, [{options}], [{edges}]::DOUBLE[]"
            else:
                kind = "integer" if isinstance(prior, Integer) else "real"
                kind += "_log" if prior.log else ""
                line = (
                    f"'{kind}', {float(prior.low)!r}::DOUBLE, {float(prior.high)!r}::DOUBLE, "
                    "[]::VARCHAR[], []::DOUBLE[]"
                )
            priors.append(f"({space_id}, '{name}', {line})")
    draw = DRAW.format("concat_ws(':', CAST(exp_id AS VARCHAR), space_id, iteration, name)")
    return f"""
    WITH prior(space_id, name, kind, low, high, options, edges) AS (VALUES {", ".join(priors)}),
    slot(trial_id, space_id, iteration, model) AS (VALUES {", ".join(slots)}),
    drawn AS (
      SELECT e.exp_id, s.trial_id, s.model, p.*, {draw.replace("space_id", "s.space_id")} AS u
      FROM (SELECT DISTINCT user_id AS exp_id FROM events) e CROSS JOIN slot s
      JOIN prior p ON p.space_id = s.space_id)
    SELECT exp_id, trial_id, model, name,
      CASE WHEN kind = 'choice' THEN options[1
        + CASE WHEN u >= coalesce(edges[1], 1) THEN 1 ELSE 0 END
        + CASE WHEN u >= coalesce(edges[2], 1) THEN 1 ELSE 0 END] END AS text,
      CASE kind WHEN 'real' THEN round(low + u * (high - low), 9)
        WHEN 'real_log' THEN round(exp(ln(low) + u * (ln(high) - ln(low))), 9)
        WHEN 'integer' THEN low + floor(u * (high - low + 1))
        WHEN 'integer_log' THEN round(exp(ln(low) + u * (ln(high) - ln(low)))) END AS number
    FROM drawn"""


def _plan(spark: SparkSession, sf_dir: str, spaces: Sequence[Space], iterations: int) -> DataFrame:
    """One search per experiment in the log, seeded by the experiment."""
    experiments = table(spark, sf_dir, "events").select(F.col("user_id").alias("exp_id")).distinct()
    seeded = experiments.withColumn("seed", F.col("exp_id"))
    trials = plan_trials(seeded, spaces, iterations)
    long = trials.select("exp_id", "trial_id", "model", F.explode("params").alias("name", "value"))
    number = F.col("value").try_cast("double")
    return long.filter("name <> 'model'").select(
        "exp_id",
        "trial_id",
        "model",
        "name",
        F.when(number.isNull(), F.col("value")).alias("text"),
        F.round(number, 9).alias("number"),
    )


@query(_plan_sql(classification_spaces(), 4))
def trial_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir, classification_spaces(), 4)


@query(_plan_sql(regression_spaces(), 4))
def trial_plan_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir, regression_spaces(), 4)
