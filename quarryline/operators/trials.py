"""Analytics over the trials of a search: means, ranks, bests, and the tables behind the charts.

A trial table has ``trial_id``, ``model``, ``score`` (NULL when the trial failed) and ``params``,
a map from parameter path to text. Ranks and running bests go through ``ordered``, so a model
family that holds most of the trials does not end up in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.functions.scalars import friendly_params, param_value
from quarryline.operators.ordered import ranked, running


def trial_means(scores: DataFrame, by: Sequence[str] = ("trial_id",)) -> DataFrame:
    """Mean and sample sd of the fold scores; folds without a score are left out of both."""
    return scores.groupBy(*by).agg(
        F.avg("score").alias("mean_score"),
        F.stddev_samp("score").alias("sd_score"),
        F.count("score").alias("n_folds"),
    )


def _best_first(higher_is_better: bool):
    score = F.col("score") if higher_is_better else -F.col("score")
    return F.when(score.isNotNull(), F.struct(score, -F.col("trial_id")))


def best_trial(trials: DataFrame, higher_is_better: bool = True) -> DataFrame:
    """The trial with the best score, the earliest of equals."""
    line = F.max_by(F.struct(*trials.columns), _best_first(higher_is_better))
    return trials.agg(line.alias("best")).select("best.*").filter("trial_id IS NOT NULL")


def best_per_model(trials: DataFrame, higher_is_better: bool = True) -> DataFrame:
    """The rank-1 trial of each model family; an aggregate, so no ranking is needed."""
    rest = [c for c in trials.columns if c != "model"]
    line = F.max_by(F.struct(*rest), _best_first(higher_is_better))
    best = trials.groupBy("model").agg(line.alias("best")).select("model", "best.*")
    return best.filter("trial_id IS NOT NULL").withColumn("model_rank", F.lit(1))


def rank_in_model(trials: DataFrame) -> DataFrame:
    """Rank within the model family, highest score first, ties in order of trial."""
    return ranked(trials, "score", "trial_id", by=["model"], name="model_rank")


def trial_rank(trials: DataFrame) -> DataFrame:
    return ranked(trials, "score", "trial_id", name="rank")


def performance_across_trials(trials: DataFrame) -> DataFrame:
    """Score of each trial and the best one so far, per model family, in order of trial."""
    return running(
        trials, "trial_id", {"best_so_far": ("max", F.col("score"))}, by=["model"]
    )


def top_k(pairs: DataFrame, value: str, tie: str, k: int = 20) -> DataFrame:
    return pairs.orderBy(F.desc_nulls_last(value), tie).limit(k)


def trial_table(
    trials: DataFrame,
    parameters: Sequence[str],
    *,
    query: str | None = None,
    include_rank: bool = True,
    num_rows: int | None = None,
) -> DataFrame:
    """One row per trial with a column per short parameter name; ranks are over all trials."""
    columns = [c for c in trials.columns if c not in ("params", *parameters)]
    wide = trials.select(*columns, *[param_value(F.col("params"), p).alias(p) for p in parameters])
    if include_rank:
        wide = trial_rank(wide)
    if query:
        wide = wide.filter(query)
    if num_rows is not None:
        wide = wide.orderBy(*(["rank"] if include_rank else []), "trial_id").limit(num_rows)
    return wide


def long_params(trials: DataFrame, query: str | None = None) -> DataFrame:
    """One row per trial and parameter (short names), without the model itself."""
    chosen = trials.filter(query) if query else trials
    params = F.map_filter(friendly_params(F.col("params")), lambda k, _: k != "model")
    return chosen.select(
        "trial_id", "model", "score", F.explode(params).alias("param", "value")
    )


def param_values_across_trials(trials: DataFrame, query: str | None = None) -> DataFrame:
    return long_params(trials, query).select("trial_id", "param", "value")


def _numeric_params(trials: DataFrame, query: str | None) -> DataFrame:
    number = F.col("value").try_cast("double")
    return long_params(trials, query).withColumn("x", number).filter("x IS NOT NULL")


def numeric_param_performance(trials: DataFrame, query: str | None = None) -> DataFrame:
    """Per numeric parameter: how the score goes with it."""
    scored = _numeric_params(trials, query).filter("score IS NOT NULL")
    return scored.groupBy("param").agg(
        F.count(F.lit(1)).alias("n"),
        F.corr("x", "score").alias("correlation"),
        F.regr_slope("score", "x").alias("slope"),
    )


def parallel_coordinates(trials: DataFrame, query: str | None = None) -> DataFrame:
    """Numeric parameters of every trial on a 0-1 scale; a constant parameter is 0."""
    values = _numeric_params(trials, query)
    ends = values.groupBy("param").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    spread = F.col("high") - F.col("low")
    position = F.when(spread > 0, (F.col("x") - F.col("low")) / spread).otherwise(0.0)
    return values.join(ends, "param").select(
        "trial_id", "param", position.alias("position"), "score"
    )


def non_numeric_param_performance(trials: DataFrame, query: str | None = None) -> DataFrame:
    """Scores by value of each non-numeric parameter, the median included."""
    text = long_params(trials, query).filter(
        F.col("value").try_cast("double").isNull() & F.col("score").isNotNull()
    )
    grouped = text.groupBy("param", "value").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("score").alias("mean_score"),
        F.min("score").alias("min_score"),
        F.max("score").alias("max_score"),
    )
    return grouped.join(_group_medians(text), ["param", "value"])


def _group_medians(text: DataFrame) -> DataFrame:
    """Exact medians per (param, value) from running counts over the distinct scores."""
    by = ["param", "value"]
    counts = text.groupBy(*by, "score").agg(F.count(F.lit(1)).alias("ties"))
    upto = running(counts, "score", {"upto": ("sum", F.col("ties"))}, by=by)
    totals = text.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    low = F.floor((F.col("n") + 1) / 2)
    high = F.floor((F.col("n") + 2) / 2)

    def holds(rank):
        return (F.col("upto") >= rank) & (F.col("upto") - F.col("ties") < rank)

    middle = upto.join(totals, by).filter(holds(low) | holds(high))
    return middle.groupBy(*by).agg(
        ((F.min("score") + F.max("score")) / 2).alias("median_score")
    )


def score_vs_parameter(
    trials: DataFrame, parameter: str, size: str, color: str, query: str | None = None
) -> DataFrame:
    wide = trial_table(trials, [parameter, size, color], query=query, include_rank=False)
    return wide.select("trial_id", "score", parameter, size, color)


def parameter_vs_parameter(
    trials: DataFrame, parameter_x: str, parameter_y: str, size: str, query: str | None = None
) -> DataFrame:
    wide = trial_table(
        trials, [parameter_x, parameter_y, size], query=query, include_rank=False
    )
    return wide.select("trial_id", parameter_x, parameter_y, size, "score")


def param_correlation(
    trials: DataFrame, parameters: Sequence[str], query: str | None = None
) -> DataFrame:
    """Correlations of all pairs of numeric parameters and the score, from one aggregate."""
    names = [*parameters, "score"]
    wide = trial_table(trials, parameters, query=query, include_rank=False).select(
        "score", *[F.col(p).try_cast("double").alias(p) for p in parameters]
    )
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    cells = wide.agg(*[F.corr(a, b).alias(f"c{k}") for k, (a, b) in enumerate(pairs)])
    lines = F.array(
        *[
            F.struct(
                F.lit(a).alias("first"),
                F.lit(b).alias("second"),
                F.col(f"c{k}").alias("correlation"),
            )
            for k, (a, b) in enumerate(pairs)
        ]
    )
    return cells.select(F.inline(lines))
