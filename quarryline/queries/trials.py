"""Queries over search trials: means, ranks, bests, and the tables behind the charts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.operators import trials as t
from quarryline.queries.catalog import query, rounded
from quarryline.queries.views import (
    PARAM_SQL,
    TRIAL_SCORES_SQL,
    TRIAL_SQL,
    table,
    trial,
    trial_scores,
    with_views,
)

TRIAL = with_views(TRIAL_SQL)
PARAM = with_views(TRIAL_SQL, PARAM_SQL)
FOREST = "model = 'RandomForestClassifier()'"
NUMBERS = ["max_depth", "min_samples_leaf"]
TEXTS = ["imputer", "savings_status_encoder"]
RANKED = f"""{TRIAL}, ranked AS (
  SELECT *, CASE WHEN score IS NOT NULL THEN row_number()
    OVER (ORDER BY score DESC NULLS LAST, trial_id) END AS rank FROM trial)"""


def _plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trial(spark, sf_dir).select("trial_id", "model", "score")


@query(
    f"""{with_views(TRIAL_SCORES_SQL)} SELECT trial_id, round(avg(score), 9) AS mean_score,
    round(stddev_samp(score), 9) AS sd_score, count(score) AS n_folds
    FROM trial_scores GROUP BY trial_id"""
)
def trial_mean_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(t.trial_means(trial_scores(spark, sf_dir)), 9, "mean_score", "sd_score")


@query(
    f"""{TRIAL} SELECT trial_id, model, score FROM trial WHERE score IS NOT NULL
    ORDER BY score DESC, trial_id LIMIT 1"""
)
def best_trial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.best_trial(_plain(spark, sf_dir))


@query(
    f"""{TRIAL} SELECT trial_id, model, score, CASE WHEN score IS NOT NULL THEN row_number()
    OVER (PARTITION BY model ORDER BY score DESC NULLS LAST, trial_id) END AS model_rank
    FROM trial"""
)
def rank_in_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.rank_in_model(_plain(spark, sf_dir))


@query(
    f"""{TRIAL}, ranked AS (SELECT trial_id, model, score, CAST(row_number()
      OVER (PARTITION BY model ORDER BY score DESC NULLS LAST, trial_id) AS INTEGER) AS model_rank
      FROM trial WHERE score IS NOT NULL)
    SELECT * FROM ranked WHERE model_rank = 1"""
)
def best_per_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.best_per_model(_plain(spark, sf_dir))


@query(f"{RANKED} SELECT trial_id, model, score, rank FROM ranked")
def trial_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.trial_rank(_plain(spark, sf_dir))


@query(
    f"""{TRIAL} SELECT trial_id, model, score, max(score)
    OVER (PARTITION BY model ORDER BY trial_id) AS best_so_far FROM trial"""
)
def performance_across_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.performance_across_trials(_plain(spark, sf_dir))


@query(
    """SELECT p_partkey, p_name AS feature, p_retailprice AS importance FROM part
    ORDER BY p_retailprice DESC, p_partkey LIMIT 20"""
)
def top_k_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_name").alias("feature"), F.col("p_retailprice").alias("importance")
    )
    return t.top_k(pairs, "importance", "p_partkey", 20)


@query(
    f"""{RANKED} SELECT trial_id, exp_id, model, score, rank, max_depth, min_samples_leaf, imputer,
    savings_status_encoder FROM ranked"""
)
def trial_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.trial_table(trial(spark, sf_dir), [*NUMBERS, *TEXTS])


@query(
    f"""{RANKED} SELECT trial_id, exp_id, model, score, rank, max_depth FROM ranked
    WHERE {FOREST} AND rank IS NOT NULL ORDER BY rank LIMIT 500"""
)
def trial_table_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.trial_table(
        trial(spark, sf_dir),
        ["max_depth"],
        query=f"{FOREST} AND rank IS NOT NULL",
        num_rows=500,
    )


@query(f"{PARAM} SELECT trial_id, param, value FROM param WHERE param <> 'model' AND {FOREST}")
def param_values_across_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.param_values_across_trials(trial(spark, sf_dir), FOREST)


NUMERIC = f"""{PARAM}, numeric AS (SELECT trial_id, model, param, score,
  TRY_CAST(value AS DOUBLE) AS x FROM param WHERE param <> 'model' AND {FOREST}
  AND TRY_CAST(value AS DOUBLE) IS NOT NULL)"""


@query(
    f"""{NUMERIC} SELECT param, count(*) AS n, round(corr(x, score), 9) AS correlation,
    round(regr_slope(score, x), 9) AS slope FROM numeric WHERE score IS NOT NULL GROUP BY param"""
)
def numeric_param_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = t.numeric_param_performance(trial(spark, sf_dir), FOREST)
    return rounded(lines, 9, "correlation", "slope")


@query(
    f"""{NUMERIC} SELECT trial_id, param, score, round((x - min(x) OVER (PARTITION BY param))
    / (max(x) OVER (PARTITION BY param) - min(x) OVER (PARTITION BY param)), 9) AS position
    FROM numeric"""
)
def parallel_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(t.parallel_coordinates(trial(spark, sf_dir), FOREST), 9, "position")


@query(
    f"""{PARAM} SELECT param, value, count(*) AS n, round(avg(score), 9) AS mean_score,
    min(score) AS min_score, max(score) AS max_score, round(median(score), 9) AS median_score
    FROM param WHERE param <> 'model' AND {FOREST} AND TRY_CAST(value AS DOUBLE) IS NULL
    AND score IS NOT NULL GROUP BY param, value"""
)
def non_numeric_param_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = t.non_numeric_param_performance(trial(spark, sf_dir), FOREST)
    return rounded(lines, 9, "mean_score", "median_score")


@query(
    f"""{TRIAL} SELECT trial_id, score, max_depth, min_samples_leaf, savings_status_encoder
    FROM trial WHERE {FOREST}"""
)
def score_vs_parameter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.score_vs_parameter(
        trial(spark, sf_dir), "max_depth", "min_samples_leaf", "savings_status_encoder", FOREST
    )


@query(
    f"""{TRIAL} SELECT trial_id, score, max_depth, min_samples_leaf, imputer
    FROM trial WHERE model = 'XGBClassifier()'"""
)
def parameter_vs_parameter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.parameter_vs_parameter(
        trial(spark, sf_dir), "max_depth", "min_samples_leaf", "imputer",
        "model = 'XGBClassifier()'",
    )


@query(
    f"""{TRIAL}, wide AS (SELECT CAST(max_depth AS DOUBLE) AS d,
      CAST(min_samples_leaf AS DOUBLE) AS l, score AS s FROM trial WHERE {FOREST})
    SELECT 'max_depth' AS first, 'min_samples_leaf' AS second, round(corr(d, l), 9) AS correlation
    FROM wide
    UNION ALL SELECT 'max_depth', 'score', round(corr(d, s), 9) FROM wide
    UNION ALL SELECT 'min_samples_leaf', 'score', round(corr(l, s), 9) FROM wide"""
)
def param_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = t.param_correlation(trial(spark, sf_dir), NUMBERS, FOREST)
    return rounded(lines, 9, "correlation")


# Ids this large are not exact as doubles; 1152921504606846976 is 2^60.
BIG = f"{TRIAL}, big AS (SELECT trial_id + 1152921504606846976 AS trial_id, model, score FROM trial)"


def _big_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(spark, sf_dir).withColumn("trial_id", F.col("trial_id") + F.lit(1 << 60))


@query(
    f"""{BIG} SELECT trial_id, model, score, max(score)
    OVER (PARTITION BY model ORDER BY trial_id) AS best_so_far FROM big"""
)
def performance_across_trials_big_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.performance_across_trials(_big_keys(spark, sf_dir))


@query(
    f"""{BIG} SELECT trial_id, model, score, CASE WHEN score IS NOT NULL THEN row_number()
    OVER (ORDER BY score DESC NULLS LAST, trial_id) END AS rank FROM big"""
)
def rank_big_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.trial_rank(_big_keys(spark, sf_dir))
