"""Feature transformers: edge cases, PCA invariants, the feature pipeline."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from quarryline.operators import transform as tr
from quarryline.session import new_path


def _values(df, column):
    return [r[0] for r in df.orderBy("id").select(column).collect()]


def _numbers(spark, *values):
    rows = list(enumerate(values))
    return spark.createDataFrame(rows, "id int, x double")


@pytest.mark.parametrize(
    "imputer,expected", [(tr.MEAN, 8 / 3), (tr.MEDIAN, 2.0), (tr.MODE, 2.0)]
)
def test_imputers(spark, imputer, expected):
    df = _numbers(spark, 2.0, None, 2.0, float("nan"), 4.0)
    filled = tr.apply_numeric(df, tr.fit_numeric(df, ["x"], imputer))
    assert _values(filled, "x") == pytest.approx([2.0, expected, 2.0, expected, 4.0])


def test_median_of_two_is_their_mean(spark):
    df = _numbers(spark, 1.0, 4.0, None)
    assert tr.fit_numeric(df, ["x"], tr.MEDIAN)[0].fill == 2.5


def test_mode_takes_the_smallest_of_ties(spark):
    df = _numbers(spark, 5.0, 5.0, 1.0, 1.0, 9.0)
    assert tr.fit_numeric(df, ["x"], tr.MODE)[0].fill == 1.0


def test_all_missing_column_becomes_zero(spark):
    df = _numbers(spark, None, None)
    for imputer in (tr.MEAN, tr.MEDIAN, tr.MODE):
        for scaler in (tr.NONE, tr.STANDARD, tr.MIN_MAX):
            fits = tr.fit_numeric(df, ["x"], imputer, scaler)
            assert _values(tr.apply_numeric(df, fits), "x") == [0.0, 0.0]


@pytest.mark.parametrize("scaler", [tr.STANDARD, tr.MIN_MAX])
def test_constant_column_scales_to_zero(spark, scaler):
    df = _numbers(spark, 3.0, 3.0, 3.0)
    assert _values(tr.apply_numeric(df, tr.fit_numeric(df, ["x"], tr.MEAN, scaler)), "x") == [0] * 3


def test_standard_scale_counts_imputed_rows(spark):
    df = _numbers(spark, 1.0, 2.0, 10.0, None)
    fits = tr.fit_numeric(df, ["x"], tr.MEDIAN, tr.STANDARD)
    filled = np.array([1.0, 2.0, 10.0, 2.0])
    expected = (filled - filled.mean()) / filled.std()
    assert _values(tr.apply_numeric(df, fits), "x") == pytest.approx(list(expected))


def test_unknown_savings_level_is_an_error(spark):
    df = spark.createDataFrame([("a lot",)], "s string")
    with pytest.raises(Exception, match="unknown savings status: a lot"):
        df.select(tr.savings_code(F.col("s"))).collect()


def test_unseen_categories(spark):
    train = spark.createDataFrame([(0, "b"), (1, "a")], "id int, c string")
    other = spark.createDataFrame([(0, "a"), (1, "z"), (2, None)], "id int, c string")
    levels = tr.fit_levels(train, ["c"])
    assert _codes(levels) == {"a": 0, "b": 1}
    assert _values(tr.ordinal_encode(other, levels, ["c"]), "c") == [0.0, -1.0, -1.0]
    assert [r["feature"] for r in tr.one_hot_long(other, "id", levels, ["c"]).collect()] == ["c_a"]
    with_missing = tr.fit_levels(train.union(other), ["c"])
    assert _codes(with_missing) == {"<missing>": 0, "a": 1, "b": 2, "z": 3}


def _codes(levels):
    return {r["level"]: r["code"] for r in levels.filter("column = 'c'").collect()}


def test_as_many_levels_as_rows(spark):
    df = spark.range(5000).select("id", F.format_string("k%05d", 4999 - F.col("id")).alias("c"))
    got = tr.ordinal_encode(df.repartition(7), tr.fit_levels(df, ["c"]), ["c"]).collect()
    assert all(r["c"] == 4999 - r["id"] for r in got) and len(got) == 5000


@pytest.mark.parametrize("rank", [2, 5])
def test_pca_dimension_and_components(spark, rank):
    rng = np.random.default_rng(rank)
    data = rng.normal(size=(800, rank)) @ rng.normal(size=(rank, 8)) * 3 + rng.normal(size=(800, 8))
    df = spark.createDataFrame([(row.tolist(),) for row in data], "a array<double>").select(
        array_to_vector("a").alias("v")
    )
    full, first = tr.fit_pca(df, "v", "p")
    components = full.pc.toArray()
    assert np.allclose(components.T @ components, np.eye(8), atol=1e-8)
    assert len(first.getIndices()) == rank
    projected = first.transform(full.transform(df)).select(vector_to_array("p")).collect()
    variances = np.array([r[0] for r in projected]).var(axis=0, ddof=1)
    eigenvalues = np.sort(np.linalg.eigvalsh(np.cov(data.T)))[::-1]
    assert variances == pytest.approx(eigenvalues[:rank])


def _table(spark):
    rows = [
        (1.0, 10, True, "x", "<100"),
        (None, 20, False, None, ">=1000"),
        (3.0, 30, True, "y", "no known savings"),
        (8.0, 60, True, "y", "<100"),
    ]
    return spark.createDataFrame(
        rows, "a double, b int, c boolean, d string, savings_status string"
    )


@pytest.mark.parametrize("pca", [tr.NONE, tr.PCA_MLE])
@pytest.mark.parametrize("savings", [tr.ONE_HOT, tr.SAVINGS_ORDER])
@pytest.mark.parametrize("encoder", [tr.ONE_HOT, tr.LEARNED_ORDER])
def test_pipeline_survives_saving_and_extra_columns(spark, pca, savings, encoder):
    df = _table(spark)
    prep = tr.Prep(tr.MEDIAN, tr.STANDARD, pca, savings, encoder)
    model = tr.fit_features(df, tr.Columns.of(df, leave_out=[]), prep)
    path = new_path(spark, "features")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    one = model.transform(df).select("features").collect()
    two = loaded.transform(df.withColumn("target", F.lit("good"))).select("features").collect()
    assert one == two
    names = tr.feature_names(loaded.transform(df))
    assert len(names) == one[0]["features"].size
    if pca == tr.NONE and encoder == tr.ONE_HOT and savings == tr.SAVINGS_ORDER:
        assert names == [
            "numeric__a", "numeric__b", "non_numeric__c_false", "non_numeric__c_true",
            "non_numeric__d_<missing>", "non_numeric__d_x", "non_numeric__d_y",
            "savings_status__savings_status",
        ]


def test_function_step_names():
    step = tr.FunctionStep(lambda df: df)
    assert step.feature_names(["a"]) == ["a"]
    named = tr.FunctionStep(lambda df: df, lambda names: [n.upper() for n in names])
    assert named.feature_names(["a"]) == ["A"]


def test_function_step_runs_any_table_function(spark):
    """Where no column expression exists, the function works on Arrow batches."""
    df = _numbers(spark, 1.0, 4.0, 9.0)

    def roots(batches):
        for batch in batches:
            yield batch.assign(x=np.sqrt(batch["x"]))

    step = tr.FunctionStep(lambda table: table.mapInPandas(roots, table.schema))
    assert _values(step.transform(df), "x") == [1.0, 2.0, 3.0]


def test_chosen_step_or_passthrough(spark):
    df = spark.createDataFrame([(0, "b"), (1, "a")], "id int, c string")
    assert tr.choose(df, None) is df
    indexed = tr.choose(df, lambda table: tr._indexer(["c"], ["code"]).fit(table))
    assert _values(indexed, "code") == [1.0, 0.0]
