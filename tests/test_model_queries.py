"""The named model queries ask for whole models and whole searches."""

import pytest

from quarryline.operators import search_space as sp
from quarryline.queries import models

SIZES = {"model__n_estimators", "model__max_depth", "model__num_leaves"}


class Seen(Exception):
    pass


def asked(monkeypatch, spark, sf_dir, name, of, owner=models):
    """What the query gives to a function that then stops it."""

    def stop(*args, **kwargs):
        raise Seen(args, kwargs)

    monkeypatch.setattr(owner, of, stop)
    with pytest.raises(Seen) as seen:
        getattr(models, name)(spark, sf_dir)
    return seen.value.args


@pytest.mark.parametrize(
    "name",
    ["random_forest", "extra_trees", "xgb_classifier", "lgbm_classifier", "random_forest_regressor",
     "extra_trees_regressor", "xgb_regressor", "feature_importances", "model_roundtrip"],
)
def test_models_have_the_size_of_their_family(monkeypatch, spark, sf_dir, name):
    args, _ = asked(monkeypatch, spark, sf_dir, name, "fit_model", models.m)
    assert not SIZES & set(args[2])


@pytest.mark.parametrize(
    "name, whole", [("cv_search", sp.classification_spaces), ("regression_search", sp.regression_spaces)]
)
def test_searches_cover_the_whole_space(monkeypatch, spark, sf_dir, name, whole):
    args, _ = asked(monkeypatch, spark, sf_dir, name, "search")
    assert args[3] == whole()
    assert (args[4].n_iterations, args[4].n_folds) == (4, 3)


def test_experiments_cover_the_whole_space(monkeypatch, spark, sf_dir):
    _, kwargs = asked(monkeypatch, spark, sf_dir, "experiment_end_to_end", "run_experiment")
    assert kwargs.get("spaces") in (None, sp.classification_spaces())
    assert (kwargs["settings"].n_iterations, kwargs["settings"].n_folds) == (4, 3)


def test_a_regressor_scores_every_row_once(spark, tmp_path):
    """Rows with the same or missing features meet the score of their features, none is lost or doubled."""
    rows = [(100.0 * q + e, q, 0.1, "A") for q in (1.0, 2.0, 3.0) for e in (0.0, 10.0)]
    rows += [(50.0, None, 0.1, "A"), (70.0, None, 0.1, None)]
    schema = "l_extendedprice double, l_quantity double, l_discount double, l_returnflag string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    line = models._regress(spark, str(tmp_path), sp.XGB_REGRESSOR, models.Prep(), n_estimators="60", reg_lambda="0").first()
    # missing quantities are filled with their mean, 2.0, so three lines of flag A share a score
    parts = [[100.0, 110.0], [200.0, 210.0, 50.0], [300.0, 310.0], [70.0]]
    left = sum((v - sum(part) / len(part)) ** 2 for part in parts for v in part)
    assert line["n"] == 8
    assert line["rmse"] == pytest.approx((left / 8) ** 0.5, abs=0.01)
