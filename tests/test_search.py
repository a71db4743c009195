"""Search spaces, trial plans, and the search with promotion."""

import pytest
from pyspark.sql import functions as F

from quarryline.functions.scalars import (
    clean_feature_name,
    friendly_param_name,
    friendly_params,
    param_value,
)
from quarryline.models.estimators import fit_model, score_rows
from quarryline.operators import search_space as sp
from quarryline.operators import trials as trials_ops
from quarryline.operators.evaluate import score_table
from quarryline.operators.registry import RunLog
from quarryline.operators.split import repeated_kfold
from quarryline.operators.transform import Columns, Once, Prep, fit_features
from quarryline.plans.experiment import is_promoted, run_experiment
from quarryline.plans.report import compare_last_run
from quarryline.plans.search import MODEL_SEED, SearchSettings, prep_of, search
from quarryline.session import new_path
from quarryline.sources import tables as io

# fixed values: short names of the parameter paths
FRIENDLY = {
    "model": "model",
    "model__C": "C",
    "model__max_features": "max_features",
    "model__num_leaves": "num_leaves",
    "prep__numeric__imputer__transformer": "imputer",
    "prep__numeric__scaler__transformer": "scaler",
    "prep__numeric__pca__transformer": "pca",
    "prep__non_numeric__encoder__transformer": "encoder",
    "prep__savings_status__savings_encoder__transformer": "savings_status_encoder",
    "prep__other": "prep__other",
}


def test_friendly_names(spark):
    df = spark.createDataFrame(list(FRIENDLY.items()), "path string, short string")
    assert df.filter(friendly_param_name(F.col("path")) != F.col("short")).count() == 0
    clash = {"prep__numeric__x__transformer": "late", "model__x": "first"}
    line = spark.createDataFrame([(clash,)], "p map<string, string>")
    assert line.select(friendly_params(F.col("p"))).first()[0] == {"x": "first"}
    assert line.select(param_value(F.col("p"), "x")).first()[0] == "first"
    values = spark.createDataFrame([({p: s for p, s in FRIENDLY.items()},)], "p map<string, string>")
    for short in FRIENDLY.values():
        assert values.select(param_value(F.col("p"), short)).first()[0] == short
    names = spark.createDataFrame([("numeric__a",), ("non_numeric__b_x",)], "n string")
    cleaned = [r[0] for r in names.select(clean_feature_name(F.col("n"))).collect()]
    assert cleaned == ["a", "b_x"]


def test_spaces_have_one_default_and_one_tuned_entry(spark):
    spaces = sp.classification_spaces()
    slots = sp.trial_slots(spark, spaces, 23).groupBy("space_id").count().collect()
    assert sorted(r["count"] for r in slots) == [1] * 5 + [23] * 5
    assert [s.tuned for s in spaces] == [False, True] * 5
    assert [s.tuned for s in sp.regression_spaces()] == [True, False] * 4
    paths = {p for s in spaces for p in s.params}
    assert len(paths | {"model"}) == 21
    assert sp.trial_slots(spark, spaces, 4).count() == 25


def test_samples_stay_inside_their_priors(spark):
    experiments = spark.range(60).select(F.col("id").alias("exp_id"), F.col("id").alias("seed"))
    spaces = sp.classification_spaces()
    trials = sp.plan_trials(experiments, spaces, 5).collect()
    assert len(trials) == 60 * 30
    seen = {}
    for t in trials:
        space = spaces[t["space_id"]]
        assert set(t["params"]) == {"model", *space.params}
        for name, prior in space.params.items():
            value = t["params"][name]
            if isinstance(prior, sp.Choice):
                assert value in prior.options
                seen.setdefault(name, []).append(value)
            else:
                assert prior.low <= float(value) <= prior.high
                assert isinstance(prior, sp.Real) or float(value).is_integer()
    tuned = [v for t in trials if spaces[t["space_id"]].tuned for v in [t["params"][sp.IMPUTER]]]
    assert 0.45 < tuned.count(sp.MEAN) / len(tuned) < 0.55


@pytest.fixture(scope="module")
def cases(spark):
    x = F.sin(F.col("id") * 1.3)
    return spark.range(240).select(
        F.col("id").alias("app_id"),
        x.alias("duration"),
        (F.cos(F.col("id") * 2.1) * 10).alias("credit_amount"),
        F.when(F.col("id") % 3 == 0, "<100").otherwise(">=1000").alias("savings_status"),
        F.when(F.col("id") % 5 == 0, None).otherwise("car").alias("purpose"),
        (x + F.sin(F.col("id") * 7.7) > 0.3).cast("int").alias("label"),
    )


def test_search_keeps_fold_scores_and_refits_the_best(spark, cases):
    settings = SearchSettings(n_iterations=1, n_folds=2, n_repeats=2, parallelism=8)
    sizes = {"model__n_estimators": "4", "model__max_depth": "3"}
    families = (sp.EXTRA_TREES, sp.RANDOM_FOREST, sp.XGB, sp.LGBM)
    spaces = sp.with_fixed(sp.classification_spaces(), {f: sizes for f in families})
    result = search(cases, "app_id", "label", spaces, settings)
    scores = result.scores.collect()
    assert len(scores) == 10 * 4
    trials = {t["trial_id"]: t for t in result.trials.collect()}
    assert len(trials) == 10 and all(t["sampler"] == "prior" for t in trials.values())
    for trial_id, trial in trials.items():
        mine = [s["score"] for s in scores if s["trial_id"] == trial_id]
        assert trial["mean_score"] == pytest.approx(sum(mine) / 4)
    assert result.best_score == max(t["mean_score"] for t in trials.values()) > 0.6
    best = min(t for t in trials if trials[t]["mean_score"] == result.best_score)
    assert trials[best]["params"] == result.best_params
    assert result.model.transform(cases).count() == 240

    table = trials_ops.trial_table(result.trials, ["max_depth", "imputer"]).collect()
    assert sorted(r["rank"] for r in table) == list(range(1, 11))
    assert next(r["trial_id"] for r in table if r["rank"] == 1) == best
    families = trials_ops.best_per_model(result.trials.select("trial_id", "model", "score"))
    assert families.count() == 5


def test_search_with_no_second_class_has_no_best(spark, cases):
    spaces = [s for s in sp.classification_spaces() if s.model == sp.LOGISTIC]
    one_class = cases.withColumn("label", F.lit(0))
    with pytest.raises(ValueError, match="no trial has a score"):
        search(one_class, "app_id", "label", spaces, SearchSettings(n_iterations=1, n_folds=2))


def test_regression_search(spark, cases):
    df = cases.withColumn("label", F.col("duration") * 2 + F.col("label")).drop("savings_status")
    spaces = [s for s in sp.regression_spaces() if s.model == sp.ELASTIC_NET]
    settings = SearchSettings(score="rmse", n_iterations=2, n_folds=2)
    result = search(df, "app_id", "label", spaces, settings)
    assert result.best_score == min(t["mean_score"] for t in result.trials.collect())


def test_two_experiments_and_the_gate(spark, cases):
    root = new_path(spark, "log")
    spaces = [s for s in sp.classification_spaces() if s.model == sp.LOGISTIC]
    outcomes = [
        run_experiment(
            cases, "app_id", "label", root, "credit", "credit_model",
            settings=SearchSettings(n_iterations=1, n_folds=3, seed=seed),
            required_gain=gain, spaces=spaces, tags={"type": "search"},
        )
        for seed, gain in ((3, 0.0001), (10, 5.0), (10, -0.5))
    ]
    assert [o.promoted for o in outcomes] == [True, False, True]
    log = RunLog(spark, root)
    stages = {r["version"]: r["stage"] for r in log.state("credit_model").collect()}
    assert stages == {1: "Archived", 2: "Production"}
    last = log.production_run("credit_model")
    assert last["run_id"] == outcomes[2].run_id
    assert last["metrics"]["roc_auc"] == outcomes[2].result.best_score
    assert "model" not in last["params"] and last["tags"] == {"type": "search"}
    assert log.runs_of(name="credit").count() == 3
    rows = io.load_dataset(spark, root, last["run_id"]).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in rows} == {"train": 192, "test": 48}
    trials, scores = io.load_results(spark, root, last["run_id"])
    assert trials.count() == 2 and scores.count() == 6

    lines = compare_last_run(log, "credit", "credit_model", "label").collect()
    assert [r["n"] for r in lines] == [48, 48]  # the last run is the one in production
    assert len({r["roc_auc"] for r in lines}) == 1 and lines[0]["roc_auc"] > 0.5
    assert compare_last_run(log, "none", "credit_model", "label") is None


def test_gate_for_scores_where_lower_is_better(spark):
    assert is_promoted(0.9, 1.0, 0.05, "rmse")
    assert not is_promoted(0.97, 1.0, 0.05, "rmse")



def _small_space(model, imputer, **params):
    prep = {sp.IMPUTER: imputer, sp.SCALER: sp.NONE, sp.PCA_STEP: sp.NONE, sp.ENCODER: sp.ONE_HOT, sp.SAVINGS: sp.ONE_HOT}
    return sp.Space(model, {k: sp.Choice((v,)) for k, v in {**params, **prep}.items()}, tuned=False)


def _repeated_rows(spark):
    """300 rows with few different features; some values are missing."""
    a = F.when(F.col("id") % 11 > 0, (F.col("id") * 7 % 13).cast("double"))
    y = F.coalesce(a, F.lit(4.0)) * 3 + F.sin(F.col("id") * 1.7) * 9
    return spark.range(300).select("id", a.alias("a"), (F.col("id") % 3).cast("string").alias("b"), y.alias("y"))


def test_cases_give_the_scores_of_all_rows(spark):
    """A regression is fitted and scored on cases, each for many rows, with the scores of the rows themselves."""
    rows = _repeated_rows(spark).withColumnRenamed("y", "label")
    small = {"model__n_estimators": "3", "model__max_depth": "3"}
    spaces = [_small_space(sp.RANDOM_FOREST_REGRESSOR, sp.MEAN, **small), _small_space(sp.ELASTIC_NET, sp.MEAN)]
    settings = SearchSettings(score="rmse", n_iterations=1, n_folds=2)
    got = search(rows, "id", "label", spaces, settings)
    params = {t["trial_id"]: t["params"] for t in got.trials.collect()}
    folded = repeated_kfold(rows, "id", 2, 1, settings.seed).persist()
    train, valid = folded.filter("fold_0 <> 0"), folded.filter("fold_0 = 0")
    pipeline = fit_features(train, Columns.of(rows, leave_out=["id", "label"]), prep_of(params[0]))
    found = {s["trial_id"]: s["score"] for s in got.scores.collect() if s["fold"] == 0}
    for trial_id in (0, 1):
        model = fit_model(pipeline.transform(train), "label", params[trial_id], MODEL_SEED)
        scored = score_rows(model, pipeline.transform(valid)).select("label", "score")
        assert found[trial_id] == pytest.approx(score_table(scored, "rmse").first()["score"], rel=1e-9)
    folded.unpersist()


def test_pipelines_over_the_same_rows_share_what_is_fitted(spark):
    rows = _repeated_rows(spark).persist()
    columns, once = Columns.of(rows, leave_out=["id", "y"]), Once()
    fit_features(rows, columns, Prep(), once=once)
    spark.sparkContext.setJobGroup("shared", "a second pipeline")
    try:
        shared = fit_features(rows, columns, Prep(scaler="StandardScaler()"), once=once)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("shared")
    alone = fit_features(rows, columns, Prep(scaler="StandardScaler()"))
    assert [r["features"] for r in shared.transform(rows).collect()] == [r["features"] for r in alone.transform(rows).collect()]
    rows.unpersist()


def _many_rows(spark):
    """1,800 rows with a label that follows both features, not quite."""
    a, b = F.sin(F.col("id") * 1.3), F.cos(F.col("id") * 2.1) * 10
    label = (a * 3 + b / 4 + F.sin(F.col("id") * 7.7) * 2 > 0.5).cast("int")
    return spark.range(1800).select(F.col("id").alias("app_id"), a.alias("a"), b.alias("b"), label.alias("label"))


def _score_of_fold(rows, params, settings, fold):
    """The score of a model that is fitted on every row of the other folds."""
    folded = repeated_kfold(rows, "app_id", settings.n_folds, 1, settings.seed).persist()
    train, valid = folded.filter(F.col("fold_0") != fold), folded.filter(F.col("fold_0") == fold)
    pipeline = fit_features(train, Columns.of(rows, leave_out=["app_id", "label"]), prep_of(params))
    model = fit_model(pipeline.transform(train), "label", params, MODEL_SEED)
    score = score_table(score_rows(model, pipeline.transform(valid)).select("label", "score"), settings.score)
    found = score.first()["score"]
    folded.unpersist()
    return found


def test_classifiers_are_fitted_on_all_rows(spark):
    """Fold scores and the refitted best are those of models over all train rows, however many there are."""
    rows = _many_rows(spark)
    small = {"model__n_estimators": "3", "model__max_depth": "4"}
    spaces = [_small_space(sp.LOGISTIC, sp.MEAN), _small_space(sp.RANDOM_FOREST, sp.MEAN, **small)]
    settings = SearchSettings(score="log_loss", n_iterations=1, n_folds=2)
    got = search(rows, "app_id", "label", spaces, settings)
    params = {t["trial_id"]: t["params"] for t in got.trials.collect()}
    scores = got.scores.collect()
    assert len(scores) == 4
    for line in scores:
        whole = _score_of_fold(rows, params[line["trial_id"]], settings, line["fold"])
        assert line["score"] == pytest.approx(whole, rel=1e-9)
    pipeline = fit_features(rows, Columns.of(rows, leave_out=["app_id", "label"]), prep_of(got.best_params))
    model = fit_model(pipeline.transform(rows), "label", got.best_params, MODEL_SEED)
    ours = score_rows(got.model, rows).select("app_id", "score").collect()
    theirs = dict(score_rows(model, pipeline.transform(rows)).select("app_id", "score").collect())
    assert {r["app_id"]: r["score"] for r in ours} == pytest.approx(theirs, rel=1e-9)


def test_an_experiment_keeps_a_model_of_all_train_rows(spark):
    rows, root = _many_rows(spark), new_path(spark, "log")
    spaces = [_small_space(sp.LOGISTIC, sp.MEAN)]
    settings = SearchSettings(n_iterations=1, n_folds=2)
    done = run_experiment(rows, "app_id", "label", root, "credit", "credit_model", settings=settings, spaces=spaces)
    parts = io.load_dataset(spark, root, done.run_id)
    train = parts.filter("split = 'train'").drop("split")
    assert train.count() == 1440
    pipeline = fit_features(train, Columns.of(train, leave_out=["app_id", "label"]), prep_of(done.result.best_params))
    whole = fit_model(pipeline.transform(train), "label", done.result.best_params, MODEL_SEED).stages[-1]
    kept = io.load_model(root, done.run_id).stages[-1]
    assert list(kept.coefficients) == pytest.approx(list(whole.coefficients), rel=1e-6)
    assert kept.intercept == pytest.approx(whole.intercept, rel=1e-6)
