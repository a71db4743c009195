"""Evaluation of the last run: its held-out rows, scored by its model and by the one in production."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.models.estimators import score_rows
from quarryline.operators.evaluate import compare_models
from quarryline.operators.registry import RunLog
from quarryline.sources.tables import load_dataset, load_model


def held_out_rows(registry: RunLog, run_id: str) -> DataFrame | None:
    """The rows a run held out, None when it stored no data."""
    stored = load_dataset(registry.spark, registry.root, run_id)
    return None if stored is None else stored.filter("split = 'test'").drop("split")


def compare_last_run(
    registry: RunLog, experiment: str, model_name: str, label: str, threshold: float = 0.37
) -> DataFrame | None:
    """Metrics of the experiment's last run and of the production model on the same rows.

    None when the experiment has no run with data; one line when nothing is in production.
    """
    found = registry.experiment(name=experiment)
    last = None if found is None else registry.last_run(found["exp_id"])
    rows = None if last is None else held_out_rows(registry, last["run_id"])
    if rows is None:
        return None
    models = {"last run": last["run_id"]}
    production = registry.production_model(model_name)
    if production is not None:
        models["production"] = production["run_id"]
    scored = rows
    for name, run_id in models.items():
        scored = score_rows(load_model(registry.root, run_id), scored, name)
    return compare_models(
        scored.withColumn("label", F.col(label)), {name: name for name in models}, threshold
    )
