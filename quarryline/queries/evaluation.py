"""Queries for the evaluation of a two-class scorer."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.operators import evaluate
from quarryline.operators.split import train_test_split
from quarryline.queries.catalog import query, rounded
from quarryline.queries.views import SCORED_SQL, scored, with_views

SCORED = with_views(SCORED_SQL)
CELLS = """
  count(*) FILTER (label = 1 AND called) AS tp, count(*) FILTER (label = 0 AND called) AS fp,
  count(*) FILTER (label = 0 AND NOT called) AS tn,
  count(*) FILTER (label = 1 AND NOT called) AS fn"""


def _curve(score: str = "score") -> str:
    return f"""
    at_score AS (SELECT {score} AS score, CAST(sum(label) AS BIGINT) AS pos,
                        CAST(sum(1 - label) AS BIGINT) AS neg FROM scored GROUP BY 1),
    curve AS (SELECT score, pos, neg,
      CAST(sum(pos) OVER (ORDER BY score DESC) AS BIGINT) AS tp,
      CAST(sum(neg) OVER (ORDER BY score DESC) AS BIGINT) AS fp,
      CAST(sum(pos) OVER () AS DOUBLE) AS p, CAST(sum(neg) OVER () AS DOUBLE) AS n
      FROM at_score)"""


AREAS = """
  sum(pos * (n - fp + neg / CAST(2 AS DOUBLE))) / (max(p) * max(n)) AS roc_auc,
  sum(pos / p * tp / (tp + fp)) AS pr_auc"""


@query(
    f"""{SCORED} SELECT label, CAST(least(floor(score * 20), 19) AS INTEGER) AS bin, count(*) AS n
    FROM scored GROUP BY 1, 2"""
)
def score_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.score_histogram(scored(spark, sf_dir))


@query(f"{SCORED} SELECT {CELLS} FROM (SELECT label, score >= 0.37::DOUBLE AS called FROM scored)")
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.confusion_matrix(scored(spark, sf_dir))


def _metrics_sql(cells: str, areas: str) -> str:
    return f"""
    SELECT tp + fp + tn + fn AS n, round((tp + fn) / CAST(tp + fp + tn + fn AS DOUBLE), 3)
             AS prevalence,
      tp, fp, tn, fn, round(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 3) AS tpr,
      round(tn / nullif(CAST(tn + fp AS DOUBLE), 0), 3) AS tnr,
      round(fp / nullif(CAST(tn + fp AS DOUBLE), 0), 3) AS fpr,
      round(fn / nullif(CAST(tp + fn AS DOUBLE), 0), 3) AS fnr,
      round(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 3) AS ppv,
      round(tn / nullif(CAST(tn + fn AS DOUBLE), 0), 3) AS npv,
      round(2 * tp / nullif(CAST(2 * tp + fp + fn AS DOUBLE), 0), 3) AS f1,
      round((tp + tn) / CAST(tp + fp + tn + fn AS DOUBLE), 3) AS accuracy,
      round((fp + fn) / CAST(tp + fp + tn + fn AS DOUBLE), 3) AS error_rate,
      round(roc_auc, 3) AS roc_auc, round(pr_auc, 3) AS pr_auc
    FROM ({cells}) CROSS JOIN ({areas})"""


def _scorer_sql(score: str) -> str:
    return _metrics_sql(
        f"SELECT {CELLS} FROM (SELECT label, {score} >= 0.37::DOUBLE AS called FROM scored)",
        f"SELECT {AREAS} FROM curve_{score}",
    )


def _curve_named(score: str) -> str:
    return (
        _curve(score)
        .replace("at_score", f"at_{score}")
        .replace("curve AS", f"curve_{score} AS")
    )


@query(f"{SCORED}, {_curve_named('score')} {_scorer_sql('score')}")
def two_class_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.two_class_metrics(scored(spark, sf_dir))


SPLIT_SCORED = f"""{SCORED}, parts AS (
  SELECT label, row_number() OVER (ORDER BY
      CAST('0x' || substr(md5('42:' || CAST(app_id AS VARCHAR)), 1, 12) AS BIGINT), app_id)
      <= ceil(CAST(0.2 AS DOUBLE) * count(*) OVER ()) AS is_test FROM scored),
share AS (SELECT avg(label) FILTER (NOT is_test) AS prior, avg(label) FILTER (is_test) AS p FROM parts)"""


def _dummy_sql(score: str) -> str:
    return _metrics_sql(
        f"SELECT {CELLS} FROM (SELECT label, {score} >= 0.37::DOUBLE AS called FROM parts CROSS JOIN share WHERE is_test)",
        "SELECT CAST(0.5 AS DOUBLE) AS roc_auc, p AS pr_auc FROM share",
    )


@query(
    f"""{SPLIT_SCORED} SELECT 'prior' AS scorer, * FROM ({_dummy_sql("prior")})
    UNION ALL SELECT 'constant' AS scorer, * FROM ({_dummy_sql("1.0")})"""
)
def dummy_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baselines fitted on the train rows, evaluated on the test rows."""
    parts = train_test_split(scored(spark, sf_dir).select("app_id", "label"), "app_id")
    return evaluate.dummy_metrics(parts.filter("split = 'train'"), parts.filter("split = 'test'"))


@query(f"{SCORED}, {_curve()} SELECT round(roc_auc, 9) AS roc_auc FROM (SELECT {AREAS} FROM curve)")
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.roc_auc(scored(spark, sf_dir)), 9, "roc_auc")


@query(
    f"""{SCORED}, {_curve()} SELECT score, tp, fp, round(tp / p, 9) AS tpr, round(fp / n, 9) AS fpr
    FROM curve"""
)
def roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.roc_curve(scored(spark, sf_dir)), 9, "tpr", "fpr")


@query(
    f"""{SCORED}, {_curve()} SELECT score, round(tp / p, 9) AS recall,
    round(tp / CAST(tp + fp AS DOUBLE), 9) AS precision FROM curve"""
)
def pr_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.pr_curve(scored(spark, sf_dir)), 9, "recall", "precision")


@query(
    f"""{SCORED}, {_curve()} SELECT round(pr_auc, 9) AS average_precision
    FROM (SELECT {AREAS} FROM curve)"""
)
def average_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.average_precision(scored(spark, sf_dir)), 9, "average_precision")


def _threshold_sql(last: int) -> str:
    return f"""{SCORED}, grid AS (
      SELECT CAST(i AS DOUBLE) / CAST(100 AS DOUBLE) AS threshold FROM range(10, {last + 1}) g(i)),
    cells AS (SELECT threshold, {CELLS} FROM (
      SELECT threshold, label, score >= threshold AS called FROM grid CROSS JOIN scored)
      GROUP BY threshold)"""


@query(
    f"""{_threshold_sql(70)}
    SELECT threshold, round(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 9) AS tpr,
      round(tn / nullif(CAST(tn + fp AS DOUBLE), 0), 9) AS tnr,
      round(fp / nullif(CAST(tn + fp AS DOUBLE), 0), 9) AS fpr,
      round(fn / nullif(CAST(tp + fn AS DOUBLE), 0), 9) AS fnr,
      round(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 9) AS ppv,
      round(tn / nullif(CAST(tn + fn AS DOUBLE), 0), 9) AS npv,
      round(2 * tp / nullif(CAST(2 * tp + fp + fn AS DOUBLE), 0), 9) AS f1,
      round((tp + tn) / CAST(tp + fp + tn + fn AS DOUBLE), 9) AS accuracy,
      round((fp + fn) / CAST(tp + fp + tn + fn AS DOUBLE), 9) AS error_rate
    FROM cells"""
)
def threshold_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = evaluate.threshold_curves(scored(spark, sf_dir))
    return rounded(lines, 9, *[c for c in lines.columns if c != "threshold"])


@query(
    f"""{_threshold_sql(60)}
    SELECT threshold, round(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 9) AS precision,
      round(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 9) AS recall FROM cells"""
)
def precision_recall_tradeoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = evaluate.precision_recall_tradeoff(scored(spark, sf_dir))
    return rounded(lines, 9, "precision", "recall")


@query(
    f"""{SCORED}, placed AS (
      SELECT label, (row_number() OVER (ORDER BY score DESC, app_id) - 1) * 20
                    // count(*) OVER () + 1 AS step FROM scored),
    steps AS (SELECT step, count(*) AS n, sum(label) AS pos FROM placed GROUP BY step),
    upto AS (SELECT step,
      CAST(sum(pos) OVER (ORDER BY step) AS DOUBLE) / sum(pos) OVER () AS gain,
      CAST(sum(n) OVER (ORDER BY step) AS DOUBLE) / sum(n) OVER () AS seen FROM steps)
    SELECT step * CAST(5 AS DOUBLE) AS percentile, round(gain, 9) AS gain,
           round(gain / seen, 9) AS lift FROM upto"""
)
def lift_gain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.lift_gain(scored(spark, sf_dir), "app_id"), 9, "gain", "lift")


@query(
    f"""{SCORED}, {_curve_named('score')}, {_curve_named('rival')}
    SELECT 'last run' AS model, * FROM ({_scorer_sql('score')})
    UNION ALL SELECT 'production' AS model, * FROM ({_scorer_sql('rival')})"""
)
def compare_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.compare_models(
        scored(spark, sf_dir), {"last run": "score", "production": "rival"}
    )


@query(
    f"""{SCORED} SELECT round(avg(CASE WHEN (score >= 0.5::DOUBLE) = (label = 1) THEN 1 ELSE 0 END),
    9) AS accuracy FROM scored"""
)
def score_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.accuracy(scored(spark, sf_dir)), 9, "accuracy")


@query(
    f"""{SCORED} SELECT round(2 * tp / CAST(2 * tp + fp + fn AS DOUBLE), 9) AS f1
    FROM (SELECT {CELLS} FROM (SELECT label, score >= 0.5::DOUBLE AS called FROM scored))"""
)
def score_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.f1(scored(spark, sf_dir)), 9, "f1")


@query(f"{SCORED} SELECT round(sqrt(avg(pow(score - label, 2))), 9) AS rmse FROM scored")
def score_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.rmse(scored(spark, sf_dir)), 9, "rmse")


_CALLED = f"SELECT {CELLS} FROM (SELECT label, score >= 0.5::DOUBLE AS called FROM scored)"
_TINY = "2.220446049250313e-16::DOUBLE"
_SCORES_SQL = {
    "precision": f"SELECT tp / CAST(tp + fp AS DOUBLE) FROM ({_CALLED})",
    "recall": f"SELECT tp / CAST(tp + fn AS DOUBLE) FROM ({_CALLED})",
    "balanced_accuracy": f"SELECT (tp / CAST(tp + fn AS DOUBLE) + tn / CAST(tn + fp AS DOUBLE)) / 2 FROM ({_CALLED})",
    "log_loss": f"""SELECT avg(-(label * ln(p) + (1 - label) * ln(1 - p)))
      FROM (SELECT label, greatest(least(score, 1 - {_TINY}), {_TINY}) AS p FROM scored)""",
    "brier": "SELECT avg(pow(score - label, 2)) FROM scored",
    "rmse": "SELECT sqrt(avg(pow(score - label, 2))) FROM scored",
    "mse": "SELECT avg(pow(score - label, 2)) FROM scored",
    "mae": "SELECT avg(abs(score - label)) FROM scored",
    "r2": "SELECT 1 - avg(pow(score - label, 2)) / var_pop(label) FROM scored",
}
_ALL_SCORES_SQL = {
    **_SCORES_SQL,
    **{n: f"SELECT -({_SCORES_SQL[of]})" for n, of in evaluate.NEGATIVES.items()},
}


@query(
    f"{SCORED} "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS scorer, round(({sql}), 9) AS score" for name, sql in _ALL_SCORES_SQL.items()
    )
)
def named_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scorers by the names they are asked for."""
    cases = scored(spark, sf_dir).select("label", "score")
    lines = [
        rounded(evaluate.score_table(cases, name), 9, "score").select(F.lit(name).alias("scorer"), "score")
        for name in _ALL_SCORES_SQL
    ]
    return functools.reduce(DataFrame.unionByName, lines)
