"""Evaluation tables of a two-class scorer. Input: one row per case with ``label`` 0/1 and ``score``.

Every table starts from counts per distinct score, so tied scores are combined map-side; the
cumulative counts come from ``ordered.running``.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarryline.operators.ordered import cut_points, running
from quarryline.session import stored

METRICS = (
    "n", "prevalence", "tp", "fp", "tn", "fn", "tpr", "tnr", "fpr", "fnr", "ppv", "npv",
    "f1", "accuracy", "error_rate", "roc_auc", "pr_auc",
)


def ratio(part: Column, whole: Column) -> Column:
    """NULL when the denominator is zero."""
    return F.when(whole != 0, part / whole)


def _counts(times: str | None = None) -> list[Column]:
    """Rows of each class; with ``times`` a line stands for so many of them."""
    many = F.lit(1) if times is None else F.col(times)
    return [
        F.sum(F.when(F.col("label") == 1, many).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col("label") == 0, many).otherwise(0)).alias("neg"),
    ]


def score_histogram(df: DataFrame, bins: int = 20) -> DataFrame:
    place = F.least(F.floor(F.col("score") * bins), F.lit(bins - 1)).cast("int")
    return df.groupBy("label", place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def confusion_counts(threshold: float) -> list[Column]:
    """The four cells as aggregates."""
    called = F.col("score") >= F.lit(threshold)
    positive = F.col("label") == 1
    return [
        F.count_if(positive & called).alias("tp"),
        F.count_if(~positive & called).alias("fp"),
        F.count_if(~positive & ~called).alias("tn"),
        F.count_if(positive & ~called).alias("fn"),
    ]


def confusion_matrix(
    df: DataFrame, threshold: float = 0.37, by: Sequence[str] = ()
) -> DataFrame:
    return df.groupBy(*by).agg(*confusion_counts(threshold))


def score_curve(df: DataFrame, by: Sequence[str] = (), times: str | None = None) -> DataFrame:
    """Per distinct score, highest first: cases at it (pos, neg) and at or above it (tp, fp)."""
    scored = df.filter(F.col("score").isNotNull())
    # The scores are computed once: ranges and totals come from the lines per distinct score.
    lines = stored(scored.groupBy(*by, "score").agg(*_counts(times)), "scores")
    totals = {"tp": ("sum", F.col("pos")), "fp": ("sum", F.col("neg"))}
    return running(lines, "score", totals, by=by, descending=True)


def _area_roc() -> Column:
    """Aggregate over ``score_curve``: chance that a positive outscores a negative, ties half."""
    outscored = F.sum(F.col("pos") * (F.col("fp") - F.col("neg") / F.lit(2.0)))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return F.lit(1.0) - ratio(outscored, pairs)


def _average_precision() -> Column:
    gained = F.sum(F.col("pos").cast("double") * F.col("tp") / (F.col("tp") + F.col("fp")))
    return ratio(gained, F.sum("pos").cast("double"))


def roc_auc(df: DataFrame, by: Sequence[str] = (), times: str | None = None) -> DataFrame:
    """Exact area under the ROC curve; NULL when only one class is present."""
    return score_curve(df, by, times).groupBy(*by).agg(_area_roc().alias("roc_auc"))


def average_precision(df: DataFrame, by: Sequence[str] = (), times: str | None = None) -> DataFrame:
    return score_curve(df, by, times).groupBy(*by).agg(_average_precision().alias("average_precision"))


def _with_totals(curve: DataFrame, df: DataFrame) -> DataFrame:
    """Attach the class totals, read once as scalar subqueries."""
    scored = df.filter(F.col("score").isNotNull())
    return curve.withColumns(
        {
            "all_pos": scored.agg(F.count_if(F.col("label") == 1)).scalar(),
            "all_neg": scored.agg(F.count_if(F.col("label") == 0)).scalar(),
        }
    )


def roc_curve(df: DataFrame) -> DataFrame:
    points = _with_totals(score_curve(df), df)
    return points.select(
        "score",
        "tp",
        "fp",
        ratio(F.col("tp"), F.col("all_pos")).alias("tpr"),
        ratio(F.col("fp"), F.col("all_neg")).alias("fpr"),
    )


def pr_curve(df: DataFrame) -> DataFrame:
    points = _with_totals(score_curve(df), df)
    return points.select(
        "score",
        ratio(F.col("tp"), F.col("all_pos")).alias("recall"),
        ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
    )


def _rates(tp: Column, fp: Column, tn: Column, fn: Column) -> dict[str, Column]:
    total = tp + fp + tn + fn
    return {
        "tpr": ratio(tp, tp + fn),
        "tnr": ratio(tn, tn + fp),
        "fpr": ratio(fp, tn + fp),
        "fnr": ratio(fn, tp + fn),
        "ppv": ratio(tp, tp + fp),
        "npv": ratio(tn, tn + fn),
        "f1": ratio(2 * tp, 2 * tp + fp + fn),
        "accuracy": ratio(tp + tn, total),
        "error_rate": ratio(fp + fn, total),
    }


def two_class_metrics(df: DataFrame, threshold: float = 0.37, round_by: int = 3) -> DataFrame:
    """One line with every metric; a case is called positive when score >= threshold."""
    called = F.col("score") >= F.lit(threshold)
    cells = score_curve(df).agg(
        F.coalesce(F.sum(F.when(called, F.col("pos"))), F.lit(0)).alias("tp"),
        F.coalesce(F.sum(F.when(called, F.col("neg"))), F.lit(0)).alias("fp"),
        F.coalesce(F.sum(F.when(~called, F.col("neg"))), F.lit(0)).alias("tn"),
        F.coalesce(F.sum(F.when(~called, F.col("pos"))), F.lit(0)).alias("fn"),
        _area_roc().alias("roc_auc"),
        _average_precision().alias("pr_auc"),
    )
    return _metric_line(cells, round_by)


def _metric_line(cells: DataFrame, round_by: int) -> DataFrame:
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    total = tp + fp + tn + fn
    line = cells.withColumns(
        {"n": total, "prevalence": ratio(tp + fn, total), **_rates(tp, fp, tn, fn)}
    )
    whole = {"n", "tp", "fp", "tn", "fn"}
    return line.select(
        *[F.col(m) if m in whole else F.round(m, round_by).alias(m) for m in METRICS]
    )


def dummy_metrics(
    train: DataFrame, df: DataFrame, threshold: float = 0.37, constant: float = 1.0, round_by: int = 3
) -> DataFrame:
    """The same metrics for the baselines that ignore the features, fitted on train.

    'prior' scores every case with the share of positives in train, 'constant' with one value; a
    case is called positive when its score reaches the threshold. Both rank at random: ROC-AUC 0.5,
    and the average precision is the share of positives.
    """
    cells = df.agg(*_counts())
    prior = train.agg(F.avg("label")).scalar()
    pos, neg = F.col("pos"), F.col("neg")

    def line(name: str, score: Column) -> DataFrame:
        called = F.coalesce(score >= F.lit(threshold), F.lit(False))
        counted = cells.withColumn("called", called).select(
            F.when(F.col("called"), pos).otherwise(0).alias("tp"),
            F.when(F.col("called"), neg).otherwise(0).alias("fp"),
            F.when(F.col("called"), 0).otherwise(neg).alias("tn"),
            F.when(F.col("called"), 0).otherwise(pos).alias("fn"),
            F.when((pos > 0) & (neg > 0), F.lit(0.5)).alias("roc_auc"),
            F.when(pos > 0, pos / (pos + neg)).alias("pr_auc"),
        )
        return _metric_line(counted, round_by).withColumn("scorer", F.lit(name))

    return line("prior", prior).unionByName(line("constant", F.lit(float(constant))))


def threshold_curves(
    df: DataFrame, low: float = 0.1, high: float = 0.7, step: float = 0.01
) -> DataFrame:
    """Rates when the threshold moves over a grid; rows are binned once, not per threshold."""
    per_unit = round(1 / step)
    grid = [i / per_unit for i in range(round(low * per_unit), round(high * per_unit) + 1)]
    binned = Bucketizer(
        splits=[-math.inf, *grid, math.inf], inputCol="score", outputCol="bin"
    ).transform(df.filter(F.col("score").isNotNull()).select("label", F.col("score").cast("double")))
    counts = binned.groupBy(F.col("bin").cast("int").alias("bin")).agg(*_counts())
    # every grid line must appear, also where no score falls between two thresholds
    lines = df.sparkSession.range(len(grid) + 1).select(F.col("id").cast("int").alias("bin"))
    thresholds = F.array(*[F.lit(t) for t in grid])
    down = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.orderBy("bin").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    table = lines.join(counts, "bin", "left").select(  # len(grid) + 1 lines
        "bin",
        *[F.sum(F.coalesce(c, F.lit(0))).over(down).alias(f"{c}_above") for c in ("pos", "neg")],
        *[
            F.sum(F.coalesce(c, F.lit(0))).over(everything).alias(f"{c}_all")
            for c in ("pos", "neg")
        ],
    )
    tp, fp = F.col("pos_above"), F.col("neg_above")
    tn, fn = F.col("neg_all") - fp, F.col("pos_all") - tp
    rates = _rates(tp, fp, tn, fn)
    return table.filter("bin > 0").select(
        F.element_at(thresholds, F.col("bin")).alias("threshold"),
        *[column.alias(name) for name, column in rates.items()],
    )


def precision_recall_tradeoff(
    df: DataFrame, low: float = 0.1, high: float = 0.6, step: float = 0.01
) -> DataFrame:
    return threshold_curves(df, low, high, step).select(
        "threshold", F.col("ppv").alias("precision"), F.col("tpr").alias("recall")
    )


def lift_gain(df: DataFrame, key: str, steps: int = 20) -> DataFrame:
    """Share of all positives found in the best-scored 1/steps, 2/steps, ... of the cases.

    Equal scores are ordered by key. Only the step boundaries are located; the cases are then
    counted per step without sorting them.
    """
    worst_first = -F.col("score")
    scored = stored(df.filter(F.col("score").isNotNull()).select("score", key, "label"), "cases")
    n, cuts = cut_points(
        scored.select("score", key),
        {"score": worst_first},
        F.col(key),
        lambda rows: [max(1, math.ceil(i * rows / steps)) for i in range(1, steps)],
    )["score"]
    step = sum(
        (F.when(cut.reached_by(worst_first, F.col(key)), 0).otherwise(1) for cut in cuts),
        F.lit(1),
    )
    counts = scored.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n"), *_counts())
    upto = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    all_steps = Window.orderBy("step").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    found = F.sum("pos").over(upto) / F.sum("pos").over(all_steps)
    seen = F.sum("n").over(upto) / F.sum("n").over(all_steps)
    return counts.select(  # one line per step
        (F.col("step") * F.lit(100.0) / steps).alias("percentile"),
        found.alias("gain"),
        (found / seen).alias("lift"),
    )


def compare_models(df: DataFrame, scores: dict[str, str], threshold: float = 0.37) -> DataFrame:
    """Metrics of several score columns on the same cases, one line per model."""
    lines = [
        two_class_metrics(df.select("label", F.col(c).alias("score")), threshold).withColumn(
            "model", F.lit(model)
        )
        for model, c in scores.items()
    ]
    table = lines[0]
    for line in lines[1:]:
        table = table.unionByName(line)
    return table


def accuracy(df: DataFrame, by: Sequence[str] = (), threshold: float = 0.5) -> DataFrame:
    right = (F.col("score") >= F.lit(threshold)).cast("int") == F.col("label")
    return df.groupBy(*by).agg(F.avg(right.cast("double")).alias("accuracy"))


def f1(df: DataFrame, by: Sequence[str] = (), threshold: float = 0.5) -> DataFrame:
    cells = confusion_matrix(df, threshold, by)
    balance = ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn"))
    return cells.select(*by, balance.alias("f1"))


def _from_cells(name: str) -> Callable[..., DataFrame]:
    """A rate of the confusion matrix at a threshold."""

    def score(df: DataFrame, by: Sequence[str] = (), threshold: float = 0.5) -> DataFrame:
        tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
        rates = {
            "precision": ratio(tp, tp + fp),
            "recall": ratio(tp, tp + fn),
            "balanced_accuracy": (ratio(tp, tp + fn) + ratio(tn, tn + fp)) / 2,
        }
        return confusion_matrix(df, threshold, by).select(*by, rates[name].alias(name))

    return score


def _mean_of(name: str, measure: Callable[[Column, Column], Column]) -> Callable[..., DataFrame]:
    """An average over the cases that have a score."""

    def score(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
        return df.groupBy(*by).agg(measure(F.col("label"), F.col("score")).alias(name))

    return score


def _log_loss(label: Column, score: Column) -> Column:
    tiny = F.lit(2.220446049250313e-16)  # keeps the logarithm finite
    p = F.greatest(F.least(score, 1 - tiny), tiny)
    return F.avg(-(label * F.ln(p) + (1 - label) * F.ln(1 - p)))


def _r2(label: Column, score: Column) -> Column:
    left = F.avg((score - label) ** 2)
    spread = F.var_pop(F.when(score.isNotNull(), label))
    return F.when(spread > 0, 1 - left / spread)


def _negative(name: str, of: str) -> Callable[..., DataFrame]:
    def score(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
        return SCORES[of](df, by).select(*by, (-F.col(of)).alias(name))

    return score


SCORES: dict[str, Callable[..., DataFrame]] = {
    "roc_auc": roc_auc,
    "average_precision": average_precision,
    "accuracy": accuracy,
    "f1": f1,
    **{n: _from_cells(n) for n in ("precision", "recall", "balanced_accuracy")},
    "log_loss": _mean_of("log_loss", _log_loss),
    "brier": _mean_of("brier", lambda y, p: F.avg((p - y) ** 2)),
    "rmse": _mean_of("rmse", lambda y, p: F.sqrt(F.avg((p - y) ** 2))),
    "mse": _mean_of("mse", lambda y, p: F.avg((p - y) ** 2)),
    "mae": _mean_of("mae", lambda y, p: F.avg(F.abs(p - y))),
    "r2": _mean_of("r2", _r2),
}
# fixed values: the names by which scorers are asked for when higher must be better
NEGATIVES = {
    "neg_log_loss": "log_loss",
    "neg_brier_score": "brier",
    "neg_root_mean_squared_error": "rmse",
    "neg_mean_squared_error": "mse",
    "neg_mean_absolute_error": "mae",
}
LOWER_IS_BETTER = frozenset(NEGATIVES.values())
SCORES |= {name: _negative(name, of) for name, of in NEGATIVES.items()}
rmse = SCORES["rmse"]


def score_table(df: DataFrame, score: str, by: Sequence[str] = ()) -> DataFrame:
    """The named score as column ``score``, one line per group of ``by``."""
    if score not in SCORES:
        raise ValueError(f"unknown score {score!r}; known: {sorted(SCORES)}")
    return SCORES[score](df, by).withColumnRenamed(score, "score")


# --- scores of lines that stand for many cases -------------------------------------------------


def of_squares(score: str) -> bool:
    """Whether the score needs of cases with one prediction only their number, mean and squared deviations."""
    return NEGATIVES.get(score, score) in ("mse", "rmse")


def counted(cases: DataFrame, score: str, by: Sequence[str]) -> DataFrame:
    """What ``score_counted`` needs of (label, score, n, spread): ``n`` cases with that score and that label or, for
    a score of squares, with that mean label and ``spread``, the sum of their squared deviations from it."""
    if of_squares(score):
        known = cases.filter(F.col("label").isNotNull() & F.col("score").isNotNull())
        loss = F.col("spread") + F.col("n") * (F.col("score") - F.col("label")) ** 2
        return known.groupBy(*by).agg(F.sum("n").alias("n"), F.sum(loss).alias("loss"))
    return cases.groupBy(*by, "label", "score").agg(F.sum("n").alias("n"))


def score_counted(lines: DataFrame, score: str, by: Sequence[str]) -> DataFrame:
    """``score_table`` over the lines of ``counted``."""
    if of_squares(score):
        mean = F.sum("loss") / F.sum("n")
        value = F.sqrt(mean) if NEGATIVES.get(score, score) == "rmse" else mean
        return lines.groupBy(*by).agg((-value if score in NEGATIVES else value).alias("score"))
    if score in ("roc_auc", "average_precision"):
        return SCORES[score](lines, by, "n").withColumnRenamed(score, "score")
    each = lines.withColumn("_each", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    return score_table(each.drop("n", "_each"), score, by)
