"""Evaluation tables on cases that SQL over the test tables does not reach."""

import random

import pytest
from pyspark.sql import functions as F

from quarryline.operators import evaluate as ev

SCHEMA = "id bigint, label int, score double"


def _frame(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)


def _brute_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("ties", [True, False])
def test_roc_auc_is_the_pair_probability(spark, ties):
    rng = random.Random(3)
    rows = [(int(rng.random() < 0.4), rng.random()) for _ in range(200)]
    if ties:  # a third of the cases share one score
        rows = [(y, 0.5 if i % 3 == 0 else round(s, 1)) for i, (y, s) in enumerate(rows)]
    assert ev.roc_auc(_frame(spark, rows)).first()[0] == pytest.approx(_brute_auc(rows))


def test_scores_per_group(spark):
    rng = random.Random(5)
    rows = [(i % 2, int(rng.random() < 0.4), round(rng.random(), 2)) for i in range(200)]
    df = spark.createDataFrame(rows, "g int, label int, score double")
    got = {r["g"]: r["score"] for r in ev.score_table(df, "roc_auc", ["g"]).collect()}
    for g in (0, 1):
        assert got[g] == pytest.approx(_brute_auc([(y, s) for k, y, s in rows if k == g]))


def test_one_class_only(spark):
    df = _frame(spark, [(1, 0.2), (1, 0.9)])
    line = ev.two_class_metrics(df).first()
    assert line["roc_auc"] is None and line["tnr"] is None
    assert (line["tp"], line["fn"], line["pr_auc"]) == (1, 1, 1.0)
    assert ev.dummy_metrics(df, df).filter("scorer = 'prior'").first()["roc_auc"] is None


def test_baselines_are_fitted_on_train(spark):
    train = _frame(spark, [(1, 0.0), (0, 0.0), (0, 0.0), (0, 0.0)])
    test = _frame(spark, [(1, 0.0), (1, 0.0), (0, 0.0)])
    lines = {r["scorer"]: r for r in ev.dummy_metrics(train, test, threshold=0.37).collect()}
    assert (lines["prior"]["tp"], lines["prior"]["fn"]) == (0, 2)  # a share of 0.25 is below 0.37
    assert (lines["constant"]["tp"], lines["constant"]["fp"]) == (2, 1)
    assert ev.dummy_metrics(train, test, threshold=0.25).filter("tp = 2").count() == 2


def test_empty_input(spark):
    df = _frame(spark, [(1, 0.2)]).limit(0)
    line = ev.two_class_metrics(df).first()
    assert line["n"] == 0 and line["accuracy"] is None
    assert ev.lift_gain(df, "id").collect() == []
    assert all(r["tpr"] is None for r in ev.threshold_curves(df).collect())


def test_threshold_equal_to_a_score_is_positive(spark):
    df = _frame(spark, [(1, 0.37), (0, 0.36)])
    assert tuple(ev.confusion_matrix(df, 0.37).first()) == (1, 0, 1, 0)
    at = {r["threshold"]: r for r in ev.threshold_curves(df).collect()}
    assert at[0.37]["tpr"] == 1.0 and at[0.38]["tpr"] == 0.0


def test_lift_with_one_shared_score(spark):
    """All cases tie: the order is by key, so the first half by key holds every positive."""
    df = _frame(spark, [(int(i < 50), 0.5) for i in range(100)])
    lines = {r["percentile"]: r for r in ev.lift_gain(df, "id").collect()}
    assert len(lines) == 20
    assert lines[25.0]["gain"] == 0.5 and lines[50.0]["gain"] == 1.0
    assert lines[100.0]["lift"] == 1.0


def test_unknown_score(spark):
    with pytest.raises(ValueError, match="unknown score"):
        ev.score_table(_frame(spark, [(1, 0.5)]), "auc")


@pytest.mark.parametrize("score", ["roc_auc", "average_precision", "log_loss", "rmse", "neg_mean_squared_error", "mae"])
def test_lines_for_many_cases_score_as_the_cases(spark, score):
    cases = spark.range(200).select(
        (F.col("id") % 2).alias("g"), ((F.col("id") * 7) % 5).alias("s"), (F.col("id") % 3 == 0).cast("double").alias("label"))
    cases = cases.select("g", (F.col("s") / 8 + 0.1).alias("score"), "label").persist()
    if ev.of_squares(score):
        n = F.count("label")
        lines = cases.groupBy("g", "score").agg(F.avg("label").alias("mean"), n.alias("n"), (F.var_pop("label") * n).alias("spread"))
        lines = lines.withColumnRenamed("mean", "label")
    else:
        lines = cases.groupBy("g", "score", "label").agg(F.count(F.lit(1)).alias("n")).withColumn("spread", F.lit(0.0))
    got = ev.score_counted(ev.counted(lines, score, ["g"]), score, ["g"])
    want = {r["g"]: r["score"] for r in ev.score_table(cases, score, ["g"]).collect()}
    assert {r["g"]: r["score"] for r in got.collect()} == pytest.approx(want)
    cases.unpersist()
