"""Model families: objectives, invariants, saving, scoring."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quarryline.models import estimators as m
from quarryline.operators import search_space as sp
from quarryline.operators.evaluate import roc_auc
from quarryline.operators.transform import Columns, Prep, fit_features
from quarryline.plans.predict import predict, run_predict
from quarryline.operators.registry import RunLog
from quarryline.session import new_path
from quarryline.sources import tables as io

SMALL = {"model__n_estimators": "8", "model__max_depth": "4", "model__num_leaves": "16"}
CLASSIFIERS = [sp.LOGISTIC, sp.EXTRA_TREES, sp.RANDOM_FOREST, sp.XGB, sp.LGBM]
REGRESSORS = [sp.ELASTIC_NET, sp.EXTRA_TREES_REGRESSOR, sp.RANDOM_FOREST_REGRESSOR, sp.XGB_REGRESSOR]


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3))
    logit = 1.5 * x[:, 0] - x[:, 1]
    y = (rng.random(400) < 1 / (1 + np.exp(-logit))).astype(float)
    z = 3 * x[:, 0] - 2 * x[:, 1] + rng.normal(size=400) * 0.3 + 5
    return x, y, z


@pytest.fixture(scope="module")
def table(spark, data):
    x, y, z = data
    rows = [(i, *map(float, x[i]), "ab"[i % 2], float(y[i]), float(z[i])) for i in range(400)]
    schema = "id bigint, x0 double, x1 double, x2 double, c string, label double, z double"
    return spark.createDataFrame(rows, schema).coalesce(2).cache()


@pytest.fixture(scope="module")
def vectors(table):
    return VectorAssembler(inputCols=["x0", "x1", "x2"], outputCol="features").transform(table)


def test_logistic_objective_has_zero_gradient(vectors, data):
    x, y, _ = data
    strength = 0.7
    fitted = m.fit_model(vectors, "label", {"model": sp.LOGISTIC, "model__C": str(strength)})
    model = fitted.stages[0]
    w, b = model.coefficients.toArray(), model.intercept
    residual = 1 / (1 + np.exp(-(x @ w + b))) - y
    assert np.abs(strength * x.T @ residual + w).max() < 0.05
    assert abs(residual.sum()) < 0.05


@pytest.mark.parametrize("strength", [0.01, 0.7, 50.0])
def test_squared_hinge_has_zero_gradient(vectors, data, strength):
    x, y, _ = data
    params = {"model": sp.LINEAR_SVC, "model__C": str(strength)}
    fitted = m.fit_model(vectors, "label", params)
    assert fitted.notes == []
    w, b = fitted.stages[0].coefficients.toArray(), fitted.stages[0].intercept
    sign = 2 * y - 1
    pull = 2 * strength * sign * np.maximum(0, 1 - sign * (x @ w + b))
    start = np.abs(2 * strength * x.T @ sign).max()
    assert np.abs(w - x.T @ pull).max() < 1e-5 * max(1, start)
    assert abs(b - pull.sum()) < 1e-5 * max(1, start)


def test_squared_hinge_with_odd_rows(spark):
    """Equal rows, one class, and rows without a label."""
    rows = [(1.0, 2.0), (1.0, 2.0), (None, 9.0)]
    table = spark.createDataFrame(rows, "label double, x double")
    table = VectorAssembler(inputCols=["x"], outputCol="features").transform(table)
    model = m.fit_model(table, "label", {"model": sp.LINEAR_SVC}).stages[0]
    # along the one direction of the rows w = 2 b, where the gradient is b - 4 * (1 - 5 b)
    assert model.coefficients[0] == pytest.approx(2 * model.intercept, abs=1e-6)
    assert model.intercept - 4 * (1 - 5 * model.intercept) == pytest.approx(0, abs=1e-5)


@pytest.mark.parametrize("alpha,mix", [(0.1, 0.0), (0.5, 0.3), (0.2, 1.0)])
def test_elastic_net_equals_coordinate_descent(vectors, data, alpha, mix):
    x, _, z = data
    centred, target = x - x.mean(axis=0), z - z.mean()
    w = np.zeros(3)
    for _ in range(500):
        for j in range(3):
            rest = target - centred @ w + centred[:, j] * w[j]
            rho = centred[:, j] @ rest / len(z)
            scale = (centred[:, j] ** 2).mean() + alpha * (1 - mix)
            w[j] = np.sign(rho) * max(abs(rho) - alpha * mix, 0) / scale
    params = {"model": sp.ELASTIC_NET, "model__alpha": str(alpha), "model__l1_ratio": str(mix)}
    fitted = m.fit_model(vectors, "z", params)
    assert fitted.stages[0].coefficients.toArray() == pytest.approx(w, abs=1e-4)


@pytest.mark.parametrize("family", [*CLASSIFIERS, sp.LINEAR_SVC])
def test_classifiers_learn_and_survive_saving(spark, table, family):
    features = table.drop("z")
    columns = Columns.of(features, leave_out=["id", "label"])
    pipeline = fit_features(features, columns, Prep())
    fitted = m.fit_model(pipeline.transform(features), "label", {"model": family, **SMALL})
    model = PipelineModel([*pipeline.stages, *fitted.stages])
    scored = m.score_rows(model, features)
    assert roc_auc(scored).first()[0] > 0.75
    if family != sp.LINEAR_SVC:
        assert scored.filter("score < 0 OR score > 1 OR score IS NULL").count() == 0
        both = model.transform(features).select(
            F.sum(F.abs(F.aggregate(vector_to_array("probability"), F.lit(0.0), lambda a, b: a + b) - 1))
        )
        assert both.first()[0] == pytest.approx(0.0, abs=1e-9)
    io.save_model(model, new := new_path(spark, "store"), "1")
    without_label = features.drop("label").withColumn("more", F.lit("x"))  # other columns
    again = m.score_rows(io.load_model(new, "1"), without_label)
    pairs = scored.select("id", "score").join(again.select("id", F.col("score").alias("s")), "id")
    assert pairs.filter("NOT (score <=> s)").count() == 0

    importances = m.feature_importances(spark, model, features)
    if family in (sp.LOGISTIC, sp.LINEAR_SVC):
        assert importances is None
    else:
        lines = {r["feature"]: r["importance"] for r in importances.collect()}
        assert set(lines) == {"x0", "x1", "x2", "c_a", "c_b"}
        assert sum(lines.values()) == pytest.approx(1.0)
        assert max(lines, key=lines.get) == "x0"


@pytest.mark.parametrize("family", REGRESSORS)
def test_regressors_beat_the_mean(vectors, family):
    params = {"model": family, "model__alpha": "0.01"}
    fitted = m.fit_model(vectors, "z", {**SMALL, **params})
    scored = m.score_rows(fitted, vectors)
    error = scored.agg(
        F.avg((F.col("score") - F.col("z")) ** 2) / F.var_pop("z")
    ).first()[0]
    assert error < 0.5


def test_forests_have_the_size_asked_for(vectors):
    params = {
        "model": sp.RANDOM_FOREST, "model__n_estimators": "12", "model__max_depth": "90",
        "model__min_samples_split": "4", "model__max_features": "0.0001",
    }
    fitted = m.fit_model(vectors, "label", params)
    assert fitted.notes == []
    assert fitted.stages[0].getNumTrees == 12 and fitted.stages[0].totalNumNodes > 12


def test_unknown_model(vectors):
    with pytest.raises(ValueError, match="unknown model"):
        m.fit_model(vectors, "label", {"model": "SVC()"})


def test_batch_prediction(spark, table):
    registry = RunLog(spark, new_path(spark, "log"))
    with pytest.raises(LookupError):
        predict(table, registry, "credit")
    io.save_model(PipelineModel(m.fit_dummy(table, "label").stages), registry.root, "r")
    registry.put_in_production("credit", registry.register_model("r", "credit"))
    output = new_path(spark, "csv")
    run_predict(table, "id", registry, "credit", output)
    share = table.agg(F.avg("label")).first()[0]
    rows = io.read_predictions(spark, output, "id bigint").collect()
    assert len(rows) == 400 and {r["predictions"] for r in rows} == {share}
