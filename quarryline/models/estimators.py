"""Model families: from a trial's parameters to fitted MLlib stages.

Linear models are fitted by MLlib, but for the squared hinge of ``svc``; trees by ``trees``. Both return
models of MLlib's classes. Where a family differs from what its name says, it returns notes, which the search stores with the trial.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml import classification as mlc
from pyspark.ml import regression as mlr
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.functions.scalars import clean_feature_name
from quarryline.operators.search_space import (
    ELASTIC_NET,
    EXTRA_TREES,
    EXTRA_TREES_REGRESSOR,
    LGBM,
    LINEAR_SVC,
    LOGISTIC,
    RANDOM_FOREST,
    RANDOM_FOREST_REGRESSOR,
    XGB,
    XGB_REGRESSOR,
)
from quarryline.models.svc import fit_squared_hinge
from quarryline.models.trees import MAX_BINS, Boosting, Forest, fit_trees, width_of
from quarryline.operators.transform import feature_names


@dataclass
class Fitted:
    stages: list[Transformer]
    notes: list[str] = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        for stage in self.stages:
            df = stage.transform(df)
        return df


def probability_of_one(df: DataFrame) -> Column:
    """The score of a transformed row: P(class 1), or the model's own output without one."""
    if "probability" in df.columns:
        return vector_to_array("probability")[1]
    if "rawPrediction" in df.columns:
        return vector_to_array("rawPrediction")[1]
    return F.col("prediction").cast("double")


def score_rows(model: PipelineModel | Fitted, df: DataFrame, output: str = "score") -> DataFrame:
    """The input columns and the score; columns the model does not use are ignored."""
    scored = model.transform(df)
    return scored.select(*df.columns, probability_of_one(scored).alias(output))


# --- baselines that ignore the features --------------------------------------------------------


def fit_dummy(train: DataFrame, label: str, strategy: str = "prior", constant: float = 1.0) -> Fitted:
    """'prior' scores the share of positives in train; 'constant' a given value."""
    if strategy == "prior":
        share = train.agg(F.avg(label)).first()[0]
    elif strategy == "constant":
        share = constant
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    score = "CAST(NULL AS DOUBLE)" if share is None else f"CAST('{float(share)!r}' AS DOUBLE)"
    return Fitted([SQLTransformer(statement=f"SELECT *, {score} AS prediction FROM __THIS__")])


# --- linear models -----------------------------------------------------------------------------


def _number(params: dict[str, str], name: str, default: float | None) -> float | None:
    value = params.get(f"model__{name}")
    return default if value in (None, "None") else float(value)


def fit_logistic(train: DataFrame, label: str, params: dict, seed: int) -> Fitted:
    """The L2 objective with inverse strength C over the sum of losses, as MLlib's mean of losses."""
    strength = _number(params, "C", 1.0)
    n = train.count()
    model = mlc.LogisticRegression(
        labelCol=label, maxIter=1000, standardization=False, regParam=1 / (strength * max(n, 1)),
    ).fit(train)
    return Fitted([model])


def fit_linear_svc(train: DataFrame, label: str, params: dict, seed: int) -> Fitted:
    """Squared hinge loss; the score is the margin."""
    model, done = fit_squared_hinge(train, label, _number(params, "C", 1.0), width_of(train))
    return Fitted([model], [] if done else ["stopped before its gradient was small"])


def fit_elastic_net(train: DataFrame, label: str, params: dict, seed: int) -> Fitted:
    """MLlib scales the label, so the L2 part of the penalty carries the label's deviation."""
    alpha, mix = _number(params, "alpha", 1.0), _number(params, "l1_ratio", 0.5)
    spread = train.agg(F.stddev_pop(label)).first()[0] or 1.0
    strength = alpha * mix + alpha * (1 - mix) * spread
    model = mlr.LinearRegression(
        labelCol=label, standardization=False, solver="auto", maxIter=1000, tol=1e-10,
        regParam=strength, elasticNetParam=alpha * mix / strength if strength else 0.0,
    ).fit(train)
    return Fitted([model])


# --- trees -------------------------------------------------------------------------------------


def _forest(width: int, params: dict, seed: int, regression: bool, random_cuts: bool) -> Forest:
    """Extremely randomised trees draw one threshold for each feature a node looks at. Without ``max_features`` a node looks at the root of the number of features, or at all of them
    for a number to predict."""
    share = _number(params, "max_features", None)
    usual = width if regression else int(math.sqrt(width))
    return Forest(
        trees=int(_number(params, "n_estimators", 500)),
        criterion="variance" if regression else params.get("model__criterion", "gini"),
        max_depth=_number(params, "max_depth", math.inf),
        min_split=_number(params, "min_samples_split", 2),
        min_leaf=_number(params, "min_samples_leaf", 1),
        features=max(1, usual if share is None else int(share * width)),
        bootstrap=params.get("model__bootstrap", "True") == "True",
        rate=_number(params, "max_samples", 1.0),
        random_cuts=random_cuts,
        seed=seed,
    )


def _boosting(params: dict, seed: int, regression: bool, leaf_wise: bool) -> Boosting:
    """By levels with the parameters of one outside library, or by leaves with those of the other."""
    common = dict(
        logistic=not regression,
        subsample=_number(params, "subsample", 1.0),
        by_tree=_number(params, "colsample_bytree", 1.0),
        by_level=_number(params, "colsample_bylevel", 1.0),
        l1=_number(params, "reg_alpha", 0.0),
        seed=seed,
    )
    if leaf_wise:
        return Boosting(
            rounds=int(_number(params, "n_estimators", 100)),
            step=_number(params, "learning_rate", 0.1),
            leaves=int(_number(params, "num_leaves", 31)),
            max_depth=math.inf,
            min_hessian=_number(params, "min_child_weight", 1e-3),
            min_rows=_number(params, "min_child_samples", 20),
            l2=_number(params, "reg_lambda", 0.0),
            **common,
        )
    return Boosting(
        rounds=int(_number(params, "n_estimators", 500)),
        step=_number(params, "learning_rate", 0.3),
        max_depth=_number(params, "max_depth", 6),
        min_hessian=_number(params, "min_child_weight", 1),
        l2=_number(params, "reg_lambda", 1.0),
        **common,
    )


def tree_settings(width: int, params: dict[str, str], seed: int) -> Forest | Boosting | None:
    """What to grow for a trial over so many features; None for a family without trees."""
    model = params["model"]
    if model in (EXTRA_TREES, RANDOM_FOREST, EXTRA_TREES_REGRESSOR, RANDOM_FOREST_REGRESSOR):
        numbers = model in (EXTRA_TREES_REGRESSOR, RANDOM_FOREST_REGRESSOR)
        return _forest(width, params, seed, numbers, model in (EXTRA_TREES, EXTRA_TREES_REGRESSOR))
    if model in (XGB, LGBM, XGB_REGRESSOR):
        return _boosting(params, seed, model == XGB_REGRESSOR, model == LGBM)
    return None


def fit_tree_family(train: DataFrame, label: str, params: dict, seed: int) -> Fitted:
    settings = tree_settings(width_of(train), params, seed)
    return Fitted([fit_trees(train, label, settings, int(_number(params, "max_bins", MAX_BINS)))])


FAMILIES: dict[str, Callable[[DataFrame, str, dict, int], Fitted]] = {
    LOGISTIC: fit_logistic,
    LINEAR_SVC: fit_linear_svc,
    EXTRA_TREES: fit_tree_family,
    RANDOM_FOREST: fit_tree_family,
    XGB: fit_tree_family,
    LGBM: fit_tree_family,
    ELASTIC_NET: fit_elastic_net,
    EXTRA_TREES_REGRESSOR: fit_tree_family,
    RANDOM_FOREST_REGRESSOR: fit_tree_family,
    XGB_REGRESSOR: fit_tree_family,
}


def fit_model(train: DataFrame, label: str, params: dict[str, str], seed: int = 42) -> Fitted:
    """Fit the family named by ``params['model']`` on rows with ``features`` and the label."""
    family = params["model"]
    if family not in FAMILIES:
        raise ValueError(f"unknown model {family!r}; known: {sorted(FAMILIES)}")
    return FAMILIES[family](train, label, params, seed)


# --- importances -------------------------------------------------------------------------------


def feature_importances(
    spark: SparkSession, model: PipelineModel, sample: DataFrame
) -> DataFrame | None:
    """(feature, importance), as many rows as the model has features; None for a linear model."""
    trees = [s for s in model.stages if hasattr(s, "featureImportances")]
    if not trees:
        return None
    names = feature_names(model.transform(sample.limit(0)))
    values = trees[-1].featureImportances.toArray()
    pairs = spark.createDataFrame(
        [(name, float(value)) for name, value in zip(names, values)], "feature string, importance double"
    )
    return pairs.withColumn("feature", clean_feature_name(F.col("feature")))


# --- scoring rows with few different features ----------------------------------------------------


def score_features(model: PipelineModel | Fitted, rows: DataFrame, features: list[str]) -> DataFrame:
    """The scores of the different values of the columns that the model reads, one row for each."""
    return score_rows(model, rows.select(*features).distinct())
