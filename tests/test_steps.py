"""User functions as steps that can be saved."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from quarryline.models.estimators import RANDOM_FOREST, feature_importances, fit_model
from quarryline.operators import steps
from quarryline.operators import transform as tr
from quarryline.session import new_path


@steps.table_function("test_squares", names=lambda inputs: [f"{c}_squared" for c in inputs])
def squares(df, inputs):
    return df.withColumns({f"{c}_squared": F.col(c) * F.col(c) for c in inputs})


@steps.table_function("test_roots", names=lambda inputs: [f"{c}_root" for c in inputs])
def roots(df, inputs):
    """No column expression: works on Arrow batches."""

    def add(batches):
        for batch in batches:
            yield batch.assign(**{f"{c}_root": np.sqrt(batch[c]) for c in inputs})

    added = ", ".join(f"`{c}_root` double" for c in inputs)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInPandas(add, f"{schema}, {added}")


@steps.table_function("test_forgetful", names=lambda inputs: inputs)
def forgetful(df, inputs):
    return df.select(*inputs)


def _rows(spark):
    rows = [(i, float(i), float(i % 7), "ab"[i % 2]) for i in range(1, 60)]
    return spark.createDataFrame(rows, "id int, x double, y double, c string")


def test_saved_and_loaded_within_the_pipeline(spark):
    df = _rows(spark)
    columns = tr.Columns.of(df, leave_out=["id"])
    chain = [
        steps.NamedStep(function="test_squares", inputs=["x"]),
        steps.NamedStep(function="test_roots", inputs=["x_squared", "y"]),
    ]
    model = tr.fit_features(df, columns, tr.Prep(), chain)
    path = new_path(spark, "steps")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    done = loaded.transform(df.withColumn("target", F.lit(1)))
    assert tr.feature_names(done) == [
        "numeric__x_squared_root", "numeric__y_root", "non_numeric__c_a", "non_numeric__c_b",
    ]
    one = model.transform(df).orderBy("id").select("features").collect()
    assert one == done.orderBy("id").select("features").collect()
    for i, row in enumerate(one, 1):
        assert row["features"].toArray()[:2] == pytest.approx([i, (i % 7) ** 0.5])


def test_names_reach_the_importances(spark):
    df = _rows(spark).withColumn("label", (F.col("x") > 30).cast("int"))
    columns = tr.Columns.of(df, leave_out=["id", "label"])
    features = tr.fit_features(df, columns, tr.Prep(), [steps.NamedStep(function="test_squares", inputs=["x"])])
    params = {"model": RANDOM_FOREST, "model__max_depth": 3, "model__n_estimators": 5}
    fitted = fit_model(features.transform(df), "label", params)
    whole = PipelineModel([*features.stages, *fitted.stages])
    names = {r["feature"] for r in feature_importances(spark, whole, df).collect()}
    assert any("x_squared" in n for n in names)


def test_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([(1, None), (2, 3.0)], "id int, x double")
    step = steps.NamedStep(function="test_squares", inputs=["x"])
    assert [r["x_squared"] for r in step.transform(df).orderBy("id").collect()] == [None, 9.0]
    assert step.transform(df.limit(0)).columns == ["id", "x", "x_squared"]
    assert step.transform(df.limit(0)).count() == 0


def test_errors_name_the_function(spark):
    df = _rows(spark)
    with pytest.raises(LookupError, match="no_such"):
        steps.NamedStep(function="no_such", inputs=["x"]).transform(df)
    with pytest.raises(ValueError, match="test_forgetful"):
        steps.NamedStep(function="test_forgetful", inputs=["x"]).transform(df)
    with pytest.raises(ValueError, match="test_squares"):
        steps.table_function("test_squares", names=list)(roots)
    steps.table_function("test_squares", names=steps._FUNCTIONS["test_squares"].names)(squares)
