"""A linear support vector classifier with squared hinge loss.

Minimised is |w|^2 / 2 + C * sum of max(0, 1 - y * (w . x))^2 over the rows, with y of -1 or 1 and the
intercept as the weight of one more feature that is always 1, so it is penalised like the others. The
loss has a continuous gradient: L-BFGS keeps a few vectors of the width of the features on the driver
and asks for the loss and its gradient once a step, which is one aggregate over the rows.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.classification import LinearSVCModel
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Objective = Callable[[np.ndarray], tuple[float, np.ndarray]]

REMEMBERED = 10  # steps whose curvature L-BFGS uses
STEPS = 300
TOLERANCE = 1e-6  # of the largest part of the gradient, against the one at the start
TRIES = 30  # lengths tried for one step
LEAST_DECREASE, LEAST_CURVATURE = 1e-4, 0.9
SUMS = 16  # partial sums that the driver adds up, for each class


def linear_model(spark: SparkSession, weights: np.ndarray) -> LinearSVCModel:
    """MLlib's model; the last weight is the intercept."""
    jvm = spark.sparkContext._jvm
    vector = _py2java(spark.sparkContext, Vectors.dense(weights[:-1]))
    uid = jvm.org.apache.spark.ml.util.Identifiable.randomUID("linearsvc")
    return LinearSVCModel(
        jvm.org.apache.spark.ml.classification.LinearSVCModel(uid, vector, float(weights[-1]))
    )


def squared_hinge(rows: DataFrame, label: str, strength: float) -> Objective:
    """The objective and its gradient over rows with ``features`` and a label of 0 or 1.

    Rows outside the margin add nothing and leave before the aggregate, as do rows without a label.
    """
    spark = rows.sparkSession

    def evaluate(weights: np.ndarray) -> tuple[float, np.ndarray]:
        margin = vector_to_array("rawPrediction")[1]
        slack = 1 - F.when(F.col(label) == 1, margin).when(F.col(label) == 0, -margin)
        inside = (
            linear_model(spark, weights)
            .transform(rows)
            .select(F.col(label).alias("label"), "features", slack.alias("slack"))
            .filter("slack > 0")
            .withColumn("part", F.spark_partition_id() % SUMS)
        )
        sums = inside.groupBy("label", "part").agg(
            Summarizer.mean(F.col("features"), F.col("slack")).alias("mean"),
            F.sum("slack").alias("slack"),
            F.sum(F.col("slack") * F.col("slack")).alias("loss"),
        )
        value, gradient = weights @ weights / 2, weights.copy()
        for line in sums.collect():  # two classes times SUMS, each as wide as the features
            toward = -1.0 if line["label"] == 1 else 1.0
            pull = np.append(line["mean"].toArray(), 1.0) * line["slack"]
            value += strength * line["loss"]
            gradient += 2 * strength * toward * pull
        return float(value), gradient

    return evaluate


def _direction(gradient: np.ndarray, known: deque) -> np.ndarray:
    """Downhill by the curvature of the remembered steps: the two-loop recursion of L-BFGS."""
    if not known:
        return -gradient / max(1.0, float(np.linalg.norm(gradient)))
    rest, shares = gradient.copy(), []
    for moved, turned in reversed(known):
        share = (moved @ rest) / (moved @ turned)
        shares.append(share)
        rest -= share * turned
    moved, turned = known[-1]
    rest *= (moved @ turned) / (turned @ turned)
    for (moved, turned), share in zip(known, reversed(shares)):
        rest += (share - (turned @ rest) / (moved @ turned)) * moved
    return -rest


def minimise(objective: Objective, start: np.ndarray) -> tuple[np.ndarray, bool]:
    """The place of the least value of a convex function, and whether its gradient became small."""
    place = start
    value, gradient = objective(place)
    small = TOLERANCE * max(1.0, float(np.abs(gradient).max()))
    known: deque = deque(maxlen=REMEMBERED)
    for _ in range(STEPS):
        if np.abs(gradient).max() <= small:
            return place, True
        way = _direction(gradient, known)
        slope = float(gradient @ way)
        low, high, length = 0.0, np.inf, 1.0
        for _ in range(TRIES):
            there = place + length * way
            value_there, gradient_there = objective(there)
            if value_there > value + LEAST_DECREASE * length * slope:
                high = length
            elif gradient_there @ way < LEAST_CURVATURE * slope:
                low = length
            else:
                break
            length = (low + high) / 2 if np.isfinite(high) else 2 * length
        else:
            return place, False
        known.append((there - place, gradient_there - gradient))
        place, value, gradient = there, value_there, gradient_there
    return place, bool(np.abs(gradient).max() <= small)


def fit_squared_hinge(
    train: DataFrame, label: str, strength: float, width: int
) -> tuple[LinearSVCModel, bool]:
    """The fitted model, and whether the search for it ended at a small gradient."""
    rows = train.select(F.col(label).cast("double").alias(label), "features")
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        weights, done = minimise(squared_hinge(rows, label, strength), np.zeros(width + 1))
    finally:
        rows.unpersist()
    return linear_model(train.sparkSession, weights), done
