"""Hyper-parameter search spaces and the trials sampled from them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.functions.hashing import unit_draw
from quarryline.operators.transform import (
    LEARNED_ORDER,
    MEAN,
    MEDIAN,
    MIN_MAX,
    MODE,
    NONE,
    ONE_HOT,
    PCA_MLE,
    SAVINGS_ORDER,
    STANDARD,
)

IMPUTER = "prep__numeric__imputer__transformer"
SCALER = "prep__numeric__scaler__transformer"
PCA_STEP = "prep__numeric__pca__transformer"
SAVINGS = "prep__savings_status__savings_encoder__transformer"
ENCODER = "prep__non_numeric__encoder__transformer"


@dataclass(frozen=True)
class Choice:
    options: tuple[str, ...]
    weights: tuple[float, ...] | None = None

    def edges(self) -> list[float]:
        """Cumulative weights between the options."""
        n = len(self.options)
        weights = self.weights or tuple(1 / n for _ in range(n))
        return [sum(weights[: i + 1]) for i in range(n - 1)]


@dataclass(frozen=True)
class Real:
    low: float
    high: float
    log: bool = False


@dataclass(frozen=True)
class Integer:
    low: int
    high: int
    log: bool = False


Prior = Choice | Real | Integer


@dataclass(frozen=True)
class Space:
    model: str
    params: dict[str, Prior]
    tuned: bool


# --- fixed values: families, ranges, options and weights ---------------------------------------

LOGISTIC = "LogisticRegression()"
LINEAR_SVC = "LinearSVC()"
EXTRA_TREES = "ExtraTreesClassifier()"
RANDOM_FOREST = "RandomForestClassifier()"
XGB = "XGBClassifier()"
LGBM = "LGBMClassifier()"
ELASTIC_NET = "ElasticNet()"
EXTRA_TREES_REGRESSOR = "ExtraTreesRegressor()"
RANDOM_FOREST_REGRESSOR = "RandomForestRegressor()"
XGB_REGRESSOR = "XGBRegressor()"
REGRESSORS = (ELASTIC_NET, EXTRA_TREES_REGRESSOR, RANDOM_FOREST_REGRESSOR, XGB_REGRESSOR)

_PENALTY = {"model__C": Real(1e-06, 100, log=True)}
_ELASTIC = {"model__alpha": Real(1e-05, 10, log=True), "model__l1_ratio": Real(0, 1)}
_BOOSTING = {
    "model__max_depth": Integer(1, 20, log=True),
    "model__learning_rate": Real(0.01, 0.3, log=True),
    "model__n_estimators": Integer(500, 2000),
    "model__min_child_weight": Integer(1, 50, log=True),
    "model__subsample": Real(0.5, 1),
    "model__colsample_bytree": Real(0.5, 1),
    "model__colsample_bylevel": Real(0.5, 1),
    "model__reg_alpha": Real(0.0001, 1, log=True),
    "model__reg_lambda": Real(1, 4, log=True),
}
_LEAF_WISE = {
    "model__num_leaves": Integer(2, 500),
    "model__subsample": Real(0.3, 1),
    "model__colsample_bytree": Real(0.2, 1),
    "model__reg_alpha": Real(0.0001, 20),
    "model__reg_lambda": Real(0.0001, 50),
}
_SCALED = Choice((STANDARD, MIN_MAX), (0.65, 0.35))
_UNSCALED = Choice((NONE,))


def _forest(*criteria: str) -> dict[str, Prior]:
    return {
        "model__max_features": Real(0.01, 0.95),
        "model__max_depth": Integer(1, 100),
        "model__n_estimators": Integer(500, 2000),
        "model__min_samples_split": Integer(2, 50),
        "model__min_samples_leaf": Integer(1, 50),
        "model__max_samples": Real(0.5, 1.0),
        "model__criterion": Choice(criteria),
    }


def _tuned_prep(scaler: Choice, encoder: str, other: str) -> dict[str, Prior]:
    return {
        IMPUTER: Choice((MEAN, MEDIAN, MODE), (0.5, 0.25, 0.25)),
        SCALER: scaler,
        PCA_STEP: Choice((NONE, PCA_MLE)),
        encoder: Choice((ONE_HOT, other), (0.65, 0.35)),
    }


def _default_prep(scaler: str, encoder: str) -> dict[str, Prior]:
    return {
        IMPUTER: Choice((MEAN,)),
        SCALER: Choice((scaler,)),
        PCA_STEP: Choice((NONE,)),
        encoder: Choice((ONE_HOT,)),
    }


def classification_spaces(linear_svc: bool = False) -> list[Space]:
    """Five families, each with one default space and one tuned space."""
    families = [
        (LOGISTIC, _PENALTY, STANDARD, _SCALED),
        (EXTRA_TREES, _forest("gini", "entropy"), NONE, _UNSCALED),
        (RANDOM_FOREST, _forest("gini", "entropy"), NONE, _UNSCALED),
        (XGB, _BOOSTING, NONE, _UNSCALED),
        (LGBM, _LEAF_WISE, NONE, _UNSCALED),
    ]
    if linear_svc:
        families.insert(1, (LINEAR_SVC, _PENALTY, STANDARD, _SCALED))
    spaces = []
    for model, params, scaler, scalers in families:
        spaces.append(Space(model, _default_prep(scaler, SAVINGS), tuned=False))
        tuned = {**params, **_tuned_prep(scalers, SAVINGS, SAVINGS_ORDER)}
        spaces.append(Space(model, tuned, tuned=True))
    return spaces


def regression_spaces() -> list[Space]:
    """Four families, the tuned space of each before its default one."""
    families = [
        (ELASTIC_NET, _ELASTIC, STANDARD, _SCALED),
        (EXTRA_TREES_REGRESSOR, _forest("squared_error"), NONE, _UNSCALED),
        (RANDOM_FOREST_REGRESSOR, _forest("squared_error"), NONE, _UNSCALED),
        (XGB_REGRESSOR, _BOOSTING, NONE, _UNSCALED),
    ]
    spaces = []
    for model, params, scaler, scalers in families:
        tuned = {**params, **_tuned_prep(scalers, ENCODER, LEARNED_ORDER)}
        spaces.append(Space(model, tuned, tuned=True))
        spaces.append(Space(model, _default_prep(scaler, ENCODER), tuned=False))
    return spaces


def with_fixed(spaces: list[Space], values: dict[str, dict[str, str]]) -> list[Space]:
    """The spaces with some parameters of a family at one value, in all its trials: a smaller search
    space, whose trials say so in their parameters."""
    return [
        Space(s.model, {**s.params, **{k: Choice((v,)) for k, v in values.get(s.model, {}).items()}}, s.tuned)
        for s in spaces
    ]


# --- trials ------------------------------------------------------------------------------------

PLAN_SCHEMA = (
    "trial_id int, space_id int, iteration int, model string, specs array<struct<name: string, "
    "kind: string, low: double, high: double, options: array<string>, edges: array<double>>>"
)


def _spec(name: str, prior: Prior) -> tuple:
    if isinstance(prior, Choice):
        return name, "choice", None, None, list(prior.options), prior.edges()
    kind = "real" if isinstance(prior, Real) else "integer"
    return name, kind + ("_log" if prior.log else ""), float(prior.low), float(prior.high), [], []


def trial_slots(spark: SparkSession, spaces: Sequence[Space], iterations: int) -> DataFrame:
    """One row per trial of a search: one for a default space, ``iterations`` for a tuned one."""
    rows = []
    for space_id, space in enumerate(spaces):
        specs = [_spec(name, prior) for name, prior in space.params.items()]
        for iteration in range(iterations if space.tuned else 1):
            rows.append((len(rows), space_id, iteration, space.model, specs))
    return spark.createDataFrame(rows, PLAN_SCHEMA)


def _draw(spec: Column) -> Column:
    """The sampled value of one parameter (spec, u), as text."""
    u, spec = spec["u"], spec["spec"]
    low, high = spec["low"], spec["high"]
    log_value = F.exp(F.ln(low) + u * (F.ln(high) - F.ln(low)))
    passed = F.size(F.filter(spec["edges"], lambda edge: u >= edge))
    return (
        F.when(spec["kind"] == "choice", F.get(spec["options"], passed))
        .when(spec["kind"] == "real", (low + u * (high - low)).cast("string"))
        .when(spec["kind"] == "real_log", log_value.cast("string"))
        .when(
            spec["kind"] == "integer",
            (low + F.floor(u * (high - low + 1))).cast("bigint").cast("string"),
        )
        .otherwise(F.round(log_value).cast("bigint").cast("string"))
    )


def plan_trials(
    experiments: DataFrame, spaces: Sequence[Space], iterations: int, seed: str = "seed"
) -> DataFrame:
    """All trials of every experiment (rows with exp_id and a seed), with their sampled params.

    The slots are as many as one search has trials, so they are broadcast.
    """
    slots = trial_slots(experiments.sparkSession, spaces, iterations)
    n_slots = sum(iterations if s.tuned else 1 for s in spaces)
    spark = experiments.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A fixed number of partitions: few rows become many draws, which one task should not make.
    asked = experiments.repartition(parts, "exp_id").select(
        "exp_id",
        F.col(seed).cast("string").alias("_seed"),
        F.explode(F.sequence(F.lit(0), F.lit(n_slots - 1))).alias("trial_id"),
    )
    drawn = F.transform(
        "draws", lambda d: F.struct(d["spec"]["name"].alias("key"), _draw(d).alias("value"))
    )
    place = F.col("_seed"), F.col("space_id"), F.col("iteration")
    draws = F.transform(
        "specs", lambda s: F.struct(s.alias("spec"), unit_draw(*place, s["name"]).alias("u"))
    )
    params = F.map_concat(
        F.create_map(F.lit("model"), F.col("model")), F.map_from_entries(drawn)
    )
    return asked.join(F.broadcast(slots), "trial_id").withColumn("draws", draws).select(
        "exp_id",
        "trial_id",
        "space_id",
        "iteration",
        "model",
        params.alias("params"),
        F.lit("prior").alias("sampler"),
    )

