"""Batch prediction with the model in production."""

from __future__ import annotations

from pyspark.sql import DataFrame

from quarryline.models.estimators import score_rows
from quarryline.operators.registry import RunLog
from quarryline.sources.tables import load_model, write_predictions


def predict(df: DataFrame, registry: RunLog, model_name: str) -> DataFrame:
    """The rows with a ``score`` from the production model."""
    production = registry.production_model(model_name)
    if production is None:
        raise LookupError(f"no version of {model_name} is in production")
    return score_rows(load_model(registry.root, production["run_id"]), df)


def run_predict(
    df: DataFrame, key: str, registry: RunLog, model_name: str, output: str
) -> None:
    write_predictions(predict(df, registry, model_name), key, "score", output)
