"""Queries for models, batch prediction, the search, and the first question from end to end."""

from __future__ import annotations

import datetime

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.functions.scalars import binary_label
from quarryline.models import estimators as m
from quarryline.models.trees import Boosting, fit_trees
from quarryline.operators import evaluate
from quarryline.operators import search_space as sp
from quarryline.operators.registry import RUN_SCHEMA, RunLog
from quarryline.operators.split import train_test_split
from quarryline.operators.transform import (
    LEARNED_ORDER,
    MEAN,
    STANDARD,
    Columns,
    Prep,
    apply_numeric,
    fit_features,
    fit_numeric,
)
from quarryline.plans.experiment import run_experiment
from quarryline.plans.predict import run_predict
from quarryline.plans.report import compare_last_run
from quarryline.plans.search import SearchSettings, search
from quarryline.queries.catalog import query, rounded
from quarryline.queries.tables import LOAN, NUMBERED, etl_transform
from quarryline.queries.views import doc_all, doc_feat, loan, reg
from quarryline.session import new_path
from quarryline.sources import tables as io

SPLIT = f"""{LOAN}, parts AS (
  SELECT app_id, CAST(CASE WHEN target = 'bad' THEN 1 ELSE 0 END AS INTEGER) AS label,
    row_number() OVER (ORDER BY
      CAST('0x' || substr(md5('42:' || CAST(app_id AS VARCHAR)), 1, 12) AS BIGINT), app_id)
      <= ceil(CAST(0.2 AS DOUBLE) * count(*) OVER ()) AS is_test FROM loan)"""


def _labelled(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    df = loan(spark, sf_dir, *columns)
    return df.withColumn("label", binary_label(F.col("target"))).drop("target")


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return train_test_split(_labelled(spark, sf_dir, "target"), "app_id")


@query(
    f"""{SPLIT} SELECT app_id, label, round((SELECT avg(label) FROM parts WHERE NOT is_test), 9)
    AS score FROM parts WHERE is_test"""
)
def dummy_prior(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _parts(spark, sf_dir).select("app_id", "label", "split")
    model = m.fit_dummy(parts.filter("split = 'train'"), "label", "prior")
    test = parts.filter("split = 'test'").drop("split")
    return rounded(m.score_rows(model, test), 9, "score")


@query(f"{SPLIT} SELECT app_id, label, CAST(1 AS DOUBLE) AS score FROM parts WHERE is_test")
def dummy_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _parts(spark, sf_dir).select("app_id", "label", "split")
    model = m.fit_dummy(parts.filter("split = 'train'"), "label", "constant", 1.0)
    return m.score_rows(model, parts.filter("split = 'test'").drop("split"))


def _register_dummy(spark: SparkSession, sf_dir: str) -> tuple[RunLog, DataFrame]:
    """Put the prior model in production; returns the log and the test rows."""
    parts = _parts(spark, sf_dir).select("app_id", "label", "split")
    fitted = m.fit_dummy(parts.filter("split = 'train'"), "label")
    registry = RunLog(spark, new_path(spark, "log"))
    io.save_model(PipelineModel(fitted.stages), registry.root, "prior")
    registry.put_in_production("credit", registry.register_model("prior", "credit"))
    return registry, parts.filter("split = 'test'").drop("split")


@query(
    f"""{SPLIT} SELECT app_id, round((SELECT avg(label) FROM parts WHERE NOT is_test), 9)
    AS predictions FROM parts WHERE is_test"""
)
def predict_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry, test = _register_dummy(spark, sf_dir)
    output = new_path(spark, "predictions")
    run_predict(test, "app_id", registry, "credit", output)
    return rounded(io.read_predictions(spark, output, "app_id bigint"), 9, "predictions")


@query("SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_different FROM documents")
def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A saved and loaded model gives every row the score of the model in memory."""
    df = doc_all(spark, sf_dir)
    model = _fit(df.filter("label IS NOT NULL"), "doc_id", sp.EXTRA_TREES, Prep())
    root = new_path(spark, "store")
    io.save_model(model, root, "1")
    ours = m.score_rows(model, df, "before").select("doc_id", "before")
    theirs = m.score_rows(io.load_model(root, "1"), df, "after").select("doc_id", "after")
    same = F.col("before").eqNullSafe(F.col("after"))
    return ours.join(theirs, "doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~same).alias("n_different")
    )


def _fit(df: DataFrame, key: str, model: str, prep: Prep, **params: str) -> PipelineModel:
    leave_out = [c for c in (key, "label") if c in df.columns]
    pipeline = fit_features(df, Columns.of(df, leave_out=leave_out), prep)
    ready = pipeline.transform(df).withColumn("label", F.col("label").cast("double"))
    settings = {"model": model, **{f"model__{k}": v for k, v in params.items()}}
    fitted = m.fit_model(ready, "label", settings)
    return PipelineModel([*pipeline.stages, *fitted.stages])


def _classify(spark: SparkSession, sf_dir: str, model: str, prep: Prep, **params: str) -> DataFrame:
    """Fitted on the labelled documents, scored on all."""
    df = doc_all(spark, sf_dir)
    fitted = _fit(df.filter("label IS NOT NULL"), "doc_id", model, prep, **params)
    return m.score_rows(fitted, df).select("doc_id", "label", "score")


@query()
def logistic_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classify(spark, sf_dir, sp.LOGISTIC, Prep(scaler=STANDARD), C="0.5")


@query(
    """SELECT count(*) AS n, round(avg(CAST(1 - quality AS DOUBLE)), 4) AS mean_score
    FROM documents JOIN labels USING (doc_id)"""
)
def logistic_mean_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The intercept is not penalised, so the mean score is the share of positives."""
    scored = logistic_regression(spark, sf_dir).filter("label IS NOT NULL")
    return scored.agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("score"), 4).alias("mean_score")
    )


@query()
def linear_svc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classify(spark, sf_dir, sp.LINEAR_SVC, Prep(scaler=STANDARD), C="0.5")


# Newton's steps on (w, b) of w * x + b over the different rows, from 0; the last ones change nothing.
@query(
    """WITH RECURSIVE lines AS (
      SELECT floor(CAST(l_extendedprice AS DOUBLE) / 1000) / 10 AS x,
        CASE WHEN l_extendedprice + 600 * l_quantity > 60000 THEN 1 ELSE -1 END AS y,
        CAST(count(*) AS DOUBLE) AS n FROM lineitem GROUP BY ALL),
    steps AS (
      SELECT 0 AS step, CAST(0 AS DOUBLE) AS w, CAST(0 AS DOUBLE) AS b
      UNION ALL
      SELECT step + 1, w - (bb * g_w - wb * g_b) / (ww * bb - wb * wb),
        b - (ww * g_b - wb * g_w) / (ww * bb - wb * wb)
      FROM (
        SELECT step, w, b, 1 + sum(inside * x * x) AS ww, sum(inside * x) AS wb, 1 + sum(inside) AS bb,
          w - sum(inside * y * slack * x) AS g_w, b - sum(inside * y * slack) AS g_b
        FROM (
          SELECT *, 1 - y * (w * x + b) AS slack,
            CASE WHEN y * (w * x + b) < 1 THEN 2 * CAST(0.5 AS DOUBLE) * n ELSE 0 END AS inside
          FROM steps CROSS JOIN lines WHERE step < 40)
        GROUP BY step, w, b))
    SELECT round(w, 4) AS weight, round(b, 4) AS intercept FROM steps WHERE step = 40"""
)
def svc_optimum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weights at the least sum of squared hinge losses: does the price tell which items are large?"""
    large = F.col("label") + 600 * F.col("l_quantity") > 60000
    items = reg(spark, sf_dir).select(
        large.cast("int").alias("label"), (F.floor(F.col("label") / 1000) / 10).alias("x")
    )
    model = _fit(items, "", sp.LINEAR_SVC, Prep(), C="0.5").stages[-1]
    found = [(float(model.coefficients[0]), float(model.intercept))]
    return rounded(spark.createDataFrame(found, "weight double, intercept double"), 4, "weight", "intercept")


@query()
def random_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classify(spark, sf_dir, sp.RANDOM_FOREST, Prep(), max_features="0.5")


@query()
def extra_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classify(spark, sf_dir, sp.EXTRA_TREES, Prep(), criterion="entropy")


@query()
def xgb_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classify(spark, sf_dir, sp.XGB, Prep(), learning_rate="0.1")


@query()
def lgbm_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classify(spark, sf_dir, sp.LGBM, Prep())


@query(
    """WITH s AS (SELECT covar_pop(l_quantity, l_quantity) + 0.1::DOUBLE AS qq,
      covar_pop(l_discount, l_discount) + 0.1::DOUBLE AS dd, covar_pop(l_quantity, l_discount) AS qd,
      covar_pop(l_quantity, l_extendedprice) AS qy, covar_pop(l_discount, l_extendedprice) AS dy
      FROM lineitem)
    SELECT 'l_quantity' AS feature, round((dd * qy - qd * dy) / (qq * dd - qd * qd), 4)
      AS coefficient FROM s
    UNION ALL SELECT 'l_discount', round((qq * dy - qd * qy) / (qq * dd - qd * qd), 4) FROM s"""
)
def ridge_normal_equations(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = reg(spark, sf_dir).select("label", "l_quantity", "l_discount")
    pipeline = fit_features(items, Columns(("l_quantity", "l_discount"), ()), Prep())
    fitted = m.fit_model(
        pipeline.transform(items),
        "label",
        {"model": sp.ELASTIC_NET, "model__alpha": "0.1", "model__l1_ratio": "0"},
    )
    weights = [float(w) for w in fitted.stages[0].coefficients]
    lines = spark.createDataFrame(
        list(zip(("l_quantity", "l_discount"), weights)), "feature string, coefficient double"
    )
    return rounded(lines, 4, "coefficient")


def _regress(spark: SparkSession, sf_dir: str, model: str, prep: Prep, **params: str) -> DataFrame:
    """Error of the fitted regressor and of the mean, over all line items."""
    df = reg(spark, sf_dir)
    read = [c for c in df.columns if c != "label"]
    different = m.score_features(_fit(df, "", model, prep, **params), df, read)
    # Both sides come from one table, so the columns of one get names of their own.
    different = different.select(*[F.col(c).alias(f"of_{c}") for c in read], "score")
    same = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in read]
    scored = df.join(different, same).select("label", "score")
    error = F.sqrt(F.avg((F.col("score") - F.col("label")) ** 2))
    return scored.agg(
        F.count(F.lit(1)).alias("n"),
        F.round(error, 6).alias("rmse"),
        F.round(F.stddev_pop("label"), 6).alias("rmse_of_mean"),
    )


@query()
def elastic_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    prep = Prep(scaler=STANDARD, encoder=LEARNED_ORDER)
    return _regress(spark, sf_dir, sp.ELASTIC_NET, prep, alpha="0.5", l1_ratio="0.3")


@query("SELECT count(*) AS n, round(avg(l_extendedprice), 3) AS mean_score FROM lineitem")
def elastic_net_mean_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The intercept is not penalised, so the mean prediction is the mean of the label."""
    df = reg(spark, sf_dir)
    fitted = _fit(df, "", sp.ELASTIC_NET, Prep(scaler=STANDARD), alpha="0.2", l1_ratio="0.5")
    return m.score_rows(fitted, df).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("score"), 3).alias("mean_score")
    )


@query()
def random_forest_regressor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _regress(spark, sf_dir, sp.RANDOM_FOREST_REGRESSOR, Prep(), max_samples="0.8")


@query()
def extra_trees_regressor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _regress(spark, sf_dir, sp.EXTRA_TREES_REGRESSOR, Prep(encoder=LEARNED_ORDER))


@query()
def xgb_regressor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _regress(spark, sf_dir, sp.XGB_REGRESSOR, Prep(), learning_rate="0.3")


@query()
def feature_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = doc_feat(spark, sf_dir)
    model = _fit(df, "doc_id", sp.RANDOM_FOREST, Prep())
    return m.feature_importances(spark, model, df).orderBy(F.desc("importance"), "feature")


@query()
def cv_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every family and trial on every fold over the labelled documents, with means and ranks."""
    settings = SearchSettings(n_iterations=4, n_folds=3, parallelism=8)
    result = search(doc_feat(spark, sf_dir), "doc_id", "label", sp.classification_spaces(), settings)
    return result.trials.select(
        "trial_id", "model", "mean_score", "sd_score", "n_folds", F.size("notes").alias("n_notes")
    )


@query()
def regression_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four regression families over the line items of every order, by their error."""
    items = reg(spark, sf_dir).withColumn("row_id", F.monotonically_increasing_id())
    settings = SearchSettings(score="rmse", n_iterations=4, n_folds=3, parallelism=8)
    result = search(items, "row_id", "label", sp.regression_spaces(), settings)
    return result.trials.select("trial_id", "model", "mean_score", "n_folds")


@query()
def experiment_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two experiments with all five families on the loans; the second meets the gate of the first."""
    df = _labelled(spark, sf_dir)
    root = new_path(spark, "log")
    lines = []
    for seed, gain in ((3, 0.0001), (10, 0.5)):
        settings = SearchSettings(n_iterations=4, n_folds=3, seed=seed, parallelism=8)
        done = run_experiment(
            df, "app_id", "label", root, "credit", "credit_model",
            settings=settings, required_gain=gain, tags={"type": "search"},
        )
        lines.append((seed, done.promoted, float(done.result.best_score)))
    state = RunLog(spark, root).state("credit_model")
    outcome = spark.createDataFrame(lines, "seed int, promoted boolean, best_score double")
    return outcome.withColumn("n_versions", state.agg(F.count(F.lit(1))).scalar())


@query(
    f"""{SPLIT}, test AS (
      SELECT label, CAST(credit_amount AS DOUBLE) / 500000 AS amount
      FROM parts JOIN loan USING (app_id) WHERE is_test),
    scored AS (
      SELECT 'last run' AS model, label, amount AS score FROM test
      UNION ALL
      SELECT 'production', label, (SELECT avg(label) FROM parts WHERE app_id % 2 <> 0) FROM test),
    placed AS (
      SELECT *, rank() OVER (PARTITION BY model ORDER BY score)
        + (count(*) OVER (PARTITION BY model, score) - 1) / CAST(2 AS DOUBLE) AS place FROM scored)
    SELECT model, count(*) AS n,
      count(*) FILTER (WHERE label = 1 AND score >= CAST(0.37 AS DOUBLE)) AS tp,
      count(*) FILTER (WHERE label = 0 AND score >= CAST(0.37 AS DOUBLE)) AS fp,
      count(*) FILTER (WHERE label = 0 AND score < CAST(0.37 AS DOUBLE)) AS tn,
      count(*) FILTER (WHERE label = 1 AND score < CAST(0.37 AS DOUBLE)) AS fn,
      round((sum(place) FILTER (WHERE label = 1) - sum(label) * (sum(label) + 1) / CAST(2 AS DOUBLE))
        / (sum(label) * sum(1 - label)), 3) AS roc_auc
    FROM placed GROUP BY model"""
)
def last_run_against_production(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three stored runs: an older one in production, the last one, and a later one of another experiment."""
    loans = _labelled(spark, sf_dir, "target", "credit_amount")
    registry = RunLog(spark, new_path(spark, "log"))
    names = [("1", "credit"), ("2", "other")]
    registry.append_experiments(spark.createDataFrame(names, "exp_id string, name string"))
    other_split = F.when(F.col("app_id") % 2 == 0, "test").otherwise("train")
    older = loans.withColumn("split", other_split)
    prior = m.fit_dummy(older.filter("split = 'train'"), "label", "prior")
    by_amount = SQLTransformer(statement="SELECT *, credit_amount / 500000 AS prediction FROM __THIS__")
    runs = (
        ("older", "1", older, PipelineModel(prior.stages)),
        ("last", "1", train_test_split(loans, "app_id"), PipelineModel([by_amount])),
        ("later", "2", None, None),
    )
    for minute, (run_id, exp_id, data, model) in enumerate(runs):
        start = datetime.datetime(2024, 1, 1, 0, minute, tzinfo=datetime.timezone.utc)
        line = spark.createDataFrame([(run_id, exp_id, None, start, start, {}, {}, {})], RUN_SCHEMA)
        registry.append_runs(line)
        if data is not None:
            io.save_dataset(data, registry.root, run_id)
            io.save_model(model, registry.root, run_id)
    for run_id in ("older", "last"):
        registry.register_model(run_id, "credit_model")
    registry.put_in_production("credit_model", 1)
    lines = compare_last_run(registry, "credit", "credit_model", "label")
    return lines.select("model", "n", "tp", "fp", "tn", "fn", "roc_auc")


# One split on the quantity, at the best of all cuts between neighbouring values, by the squared error.
_STUMP = """
WITH sums AS (
  SELECT l_quantity AS x, count(*) AS n, sum(l_extendedprice) AS s FROM lineitem GROUP BY l_quantity
),
cuts AS (
  SELECT x, sum(n) OVER upto AS n_left, sum(s) OVER upto AS s_left, sum(n) OVER () AS n_all, sum(s) OVER () AS s_all
  FROM sums WINDOW upto AS (ORDER BY x)
),
best AS (
  SELECT * FROM cuts WHERE n_left < n_all
  ORDER BY s_left * s_left / n_left + (s_all - s_left) * (s_all - s_left) / (n_all - n_left) DESC LIMIT 1
)
"""
_STUMP_ROWS = """
SELECT l_quantity, round(CASE WHEN l_quantity <= best.x THEN s_left / n_left ELSE (s_all - s_left) / (n_all - n_left) END, 4) AS score,
       count(*) AS n
FROM lineitem CROSS JOIN best GROUP BY ALL
"""


def _stump(spark: SparkSession, sf_dir: str, model: str, **params: str) -> DataFrame:
    items = reg(spark, sf_dir).select("label", "l_quantity")
    fitted = _fit(items, "", model, Prep(), n_estimators="1", max_depth="1", **params)
    scored = m.score_rows(fitted, items)
    return scored.groupBy("l_quantity", F.round("score", 4).alias("score")).agg(F.count(F.lit(1)).alias("n"))


@query(_STUMP + _STUMP_ROWS)
def boosted_stump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One whole step with one split: the best cut and the means on both sides of it."""
    return _stump(spark, sf_dir, sp.XGB_REGRESSOR, learning_rate="1", reg_lambda="0")


@query(
    """
WITH sums AS (
  SELECT l_quantity AS x, count(*) AS n, sum(l_extendedprice) AS s FROM lineitem GROUP BY l_quantity
),
cuts AS (
  SELECT x, sum(n) OVER upto AS n_left, sum(s) OVER upto AS s_left, sum(n) OVER () AS n_all, sum(s) OVER () AS s_all
  FROM sums WINDOW upto AS (ORDER BY x)
),
gradients AS (
  SELECT x, n_left, n_all - n_left AS n_right, s_all / n_all AS mean,
         n_left * s_all / n_all - s_left AS g_left, (n_all - n_left) * s_all / n_all - (s_all - s_left) AS g_right
  FROM cuts WHERE n_left < n_all
),
shrunk AS (
  SELECT *, sign(g_left) * greatest(abs(g_left) - 20000::DOUBLE, 0) AS a_left,
         sign(g_right) * greatest(abs(g_right) - 20000::DOUBLE, 0) AS a_right FROM gradients
),
best AS (
  SELECT * FROM shrunk ORDER BY a_left * a_left / (n_left + 300) + a_right * a_right / (n_right + 300) DESC LIMIT 1
)
SELECT l_quantity, round(mean - 0.25::DOUBLE * CASE WHEN l_quantity <= best.x THEN a_left / (n_left + 300)
       ELSE a_right / (n_right + 300) END, 4) AS score, count(*) AS n
FROM lineitem CROSS JOIN best GROUP BY ALL
"""
)
def boosted_regularised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One round with L1 and L2 on the leaves and a short step: gain and leaves by the formula."""
    return _stump(spark, sf_dir, sp.XGB_REGRESSOR, learning_rate="0.25", reg_alpha="20000", reg_lambda="300")


@query(_STUMP + _STUMP_ROWS)
def leaf_wise_stump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One round of a tree that may have two leaves: the leaf to split first is the best one."""
    items = reg(spark, sf_dir).select("label", "l_quantity")
    pipeline = fit_features(items, Columns(("l_quantity",), ()), Prep())
    settings = Boosting(1, logistic=False, step=1.0, leaves=2, l2=0.0)
    model = fit_trees(pipeline.transform(items), "label", settings)
    scored = m.score_rows(PipelineModel([*pipeline.stages, model]), items)
    return scored.groupBy("l_quantity", F.round("score", 4).alias("score")).agg(F.count(F.lit(1)).alias("n"))


@query(_STUMP + _STUMP_ROWS)
def forest_stump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forest of one tree with one split on all rows: the same best cut and means."""
    return _stump(spark, sf_dir, sp.RANDOM_FOREST_REGRESSOR, bootstrap="False")


@query(
    """SELECT doc_id, 1 - quality AS label, count(*) OVER () AS n FROM documents LEFT JOIN labels USING (doc_id)"""
)
def scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document gets a probability of class 1, judged or not; columns the model does not know
    do not matter."""
    df = doc_all(spark, sf_dir)
    fitted = _fit(df.filter("label IS NOT NULL"), "doc_id", sp.LOGISTIC, Prep(scaler=STANDARD))
    scored = m.score_rows(fitted, df.withColumn("unknown_to_the_model", F.lit("x")))
    valid = scored.filter("score BETWEEN 0 AND 1").select("doc_id", "label")
    return valid.withColumn("n", valid.agg(F.count(F.lit(1))).scalar())


@query(
    f"""{NUMBERED}, parts AS (
      SELECT CASE WHEN target = 'bad' THEN 1 ELSE 0 END AS label,
        CASE WHEN place BETWEEN 0 AND 45 THEN NULL ELSE duration END AS duration,
        row_number() OVER (ORDER BY
          CAST('0x' || substr(md5('42:' || CAST(app_id AS VARCHAR)), 1, 12) AS BIGINT), app_id)
          <= ceil(CAST(0.2 AS DOUBLE) * count(*) OVER ()) AS is_test
      FROM numbered),
    fit AS (SELECT avg(label) AS prior, avg(duration) AS fill FROM parts WHERE NOT is_test)
    SELECT CASE WHEN is_test THEN 'test' ELSE 'train' END AS split, count(*) AS n,
      round(avg(label), 6) AS bad_share, round(max(prior), 6) AS score,
      round(avg(coalesce(duration, fill)), 6) AS mean_duration,
      CAST(sum(CASE WHEN prior >= 0.37::DOUBLE THEN label ELSE 0 END) AS BIGINT) AS tp,
      CAST(sum(CASE WHEN prior >= 0.37::DOUBLE THEN 1 - label ELSE 0 END) AS BIGINT) AS fp,
      CAST(sum(CASE WHEN prior < 0.37::DOUBLE THEN 1 - label ELSE 0 END) AS BIGINT) AS tn,
      CAST(sum(CASE WHEN prior < 0.37::DOUBLE THEN label ELSE 0 END) AS BIGINT) AS fn,
      CAST(0.5 AS DOUBLE) AS roc_auc
    FROM parts CROSS JOIN fit GROUP BY is_test"""
)
def first_question(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty the loans, impute, split, score with the prior model, report per split."""
    dirty = etl_transform(spark, sf_dir).select("app_id", "duration", "target")
    parts = train_test_split(dirty, "app_id").withColumn("label", binary_label(F.col("target")))
    train = parts.filter("split = 'train'")
    fits = fit_numeric(train, ["duration"], MEAN)
    model = m.fit_dummy(train, "label", "prior")
    scored = m.score_rows(model, apply_numeric(parts, fits))
    areas = evaluate.roc_auc(scored, ["split"])
    facts = scored.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("label"), 6).alias("bad_share"),
        F.round(F.max("score"), 6).alias("score"),
        F.round(F.avg("duration"), 6).alias("mean_duration"),
        *evaluate.confusion_counts(0.37),
    )
    return facts.join(areas, "split")
