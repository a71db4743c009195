"""Queries for the feature transformers."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.operators import transform as tr
from quarryline.operators.steps import NamedStep, table_function
from quarryline.queries.catalog import query, rounded
from quarryline.queries.tables import LOAN, NUMBERED, etl_transform
from quarryline.queries.views import loan, table
from quarryline.session import new_path, remove

NUMBERS = ["credit_amount", "duration"]
KEYED = f"""{NUMBERED}, edited AS (
  SELECT app_id, CASE WHEN place BETWEEN 10 AND 53 THEN CAST(0 AS DOUBLE) ELSE credit_amount END
           AS credit_amount,
         CASE WHEN place BETWEEN 0 AND 45 THEN NULL ELSE duration END AS duration,
         CASE WHEN place BETWEEN 25 AND 74 THEN NULL ELSE checking_status END AS checking_status,
         purpose, savings_status, CAST(foreign_worker AS VARCHAR) AS foreign_worker, target
  FROM numbered)"""


def _numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return etl_transform(spark, sf_dir).select("app_id", *NUMBERS)


def _imputed(spark: SparkSession, sf_dir: str, imputer: str) -> DataFrame:
    df = _numbers(spark, sf_dir)
    return rounded(tr.apply_numeric(df, tr.fit_numeric(df, NUMBERS, imputer)), 6, *NUMBERS)


def _imputed_sql(statistic: str) -> str:
    return f"""{KEYED} SELECT app_id,
    round(coalesce(credit_amount, (SELECT {statistic.format('credit_amount')} FROM edited)), 6)
      AS credit_amount,
    round(coalesce(duration, (SELECT {statistic.format('duration')} FROM edited)), 6) AS duration
    FROM edited"""


@query(_imputed_sql("avg({})"))
def impute_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _imputed(spark, sf_dir, tr.MEAN)


@query(_imputed_sql("median({})"))
def impute_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _imputed(spark, sf_dir, tr.MEDIAN)


@query(
    f"""{KEYED}, common AS (SELECT duration AS value FROM edited WHERE duration IS NOT NULL
      GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
    SELECT app_id, credit_amount, coalesce(duration, (SELECT value FROM common)) AS duration
    FROM edited"""
)
def impute_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _imputed(spark, sf_dir, tr.MODE)


def _scaled(spark: SparkSession, sf_dir: str, scaler: str) -> DataFrame:
    """Six digits: sums taken in another order differ in the last bits of a mean."""
    df = _numbers(spark, sf_dir)
    fits = tr.fit_numeric(df, NUMBERS, tr.MEAN, scaler)
    return rounded(tr.apply_numeric(df, fits), 6, *NUMBERS)


FILLED = f"""{KEYED}, filled AS (SELECT app_id, credit_amount,
  coalesce(duration, (SELECT avg(duration) FROM edited)) AS duration FROM edited)"""


@query(
    f"""{FILLED} SELECT app_id,
    round((credit_amount - avg(credit_amount) OVER ()) / stddev_pop(credit_amount) OVER (), 6)
      AS credit_amount,
    round((duration - avg(duration) OVER ()) / stddev_pop(duration) OVER (), 6) AS duration
    FROM filled"""
)
def standard_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scaled(spark, sf_dir, tr.STANDARD)


@query(
    f"""{FILLED} SELECT app_id,
    round((credit_amount - min(credit_amount) OVER ())
          / (max(credit_amount) OVER () - min(credit_amount) OVER ()), 6) AS credit_amount,
    round((duration - min(duration) OVER ()) / (max(duration) OVER () - min(duration) OVER ()), 6)
      AS duration FROM filled"""
)
def minmax_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scaled(spark, sf_dir, tr.MIN_MAX)


ITEM_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


COVARIANCE = " UNION ALL ".join(
    f"SELECT '{a}' AS first, '{b}' AS second, round(covar_pop({a}, {b}), 4) AS cov FROM items"
    for i, a in enumerate(ITEM_NUMBERS)
    for b in ITEM_NUMBERS[i:]
)


@query(
    f"""WITH items AS (SELECT l_quantity, l_discount, l_tax,
      l_extendedprice / CAST(1000 AS DOUBLE) AS l_extendedprice FROM lineitem) {COVARIANCE}"""
)
def pca_covariance(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").withColumn(
        "l_extendedprice", F.col("l_extendedprice") / F.lit(1000.0)
    )
    return rounded(tr.covariance_table(items, ITEM_NUMBERS), 4, "cov")


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("vector")
    )


@query(
    """WITH entries AS (SELECT unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i
      FROM embeddings),
    variances AS (SELECT i, var_samp(CAST(x AS DOUBLE)) AS v FROM entries GROUP BY i)
    SELECT count(*) AS n_components, round(sum(v), 6) AS variance FROM variances"""
)
def pca_total_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All components together carry the variance of the vectors."""
    vectors = _vectors(spark, sf_dir)
    full, _ = tr.fit_pca(vectors, "vector", "components")
    entries = full.transform(vectors).select(
        F.posexplode(vector_to_array("components_all")).alias("i", "x")
    )
    variances = entries.groupBy("i").agg(F.var_samp("x").alias("v"))
    return variances.agg(
        F.count(F.lit(1)).alias("n_components"), F.round(F.sum("v"), 6).alias("variance")
    )


@query(
    """WITH sums AS (SELECT var_samp(CAST(embedding[1] AS DOUBLE)) AS a,
      var_samp(CAST(embedding[2] AS DOUBLE)) AS c,
      covar_samp(CAST(embedding[1] AS DOUBLE), CAST(embedding[2] AS DOUBLE)) AS b FROM embeddings),
    roots AS (SELECT (a + c) / 2 AS middle, sqrt((a - c) * (a - c) / 4 + b * b) AS half FROM sums)
    SELECT round(middle + half, 9) AS first_variance, round(middle - half, 9) AS second_variance,
    CAST(0 AS DOUBLE) AS covariance, CAST(1 AS BIGINT) AS chosen FROM roots"""
)
def pca_two_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two entries on their components: the variances are the roots of the characteristic polynomial.

    Of two directions the evidence is compared for one component alone.
    """
    pair = F.slice(F.col("embedding").cast("array<double>"), 1, 2)
    vectors = table(spark, sf_dir, "embeddings").select(array_to_vector(pair).alias("vector"))
    full, first = tr.fit_pca(vectors, "vector", "components")
    projected = full.transform(vectors).select(vector_to_array("components_all").alias("x"))
    x, y = F.col("x")[0], F.col("x")[1]
    return projected.agg(
        F.round(F.var_samp(x), 9).alias("first_variance"),
        F.round(F.var_samp(y), 9).alias("second_variance"),
        (F.round(F.covar_samp(x, y), 9) + F.lit(0.0)).alias("covariance"),
        F.lit(len(first.getIndices())).cast("bigint").alias("chosen"),
    )


@query()
def pca_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings on their principal components; how many is decided by the evidence."""
    vectors = _vectors(spark, sf_dir)
    projected = vectors
    for stage in tr.fit_pca(vectors, "vector", "components"):
        projected = stage.transform(projected)
    return projected.select("vec_id", vector_to_array("components").alias("components"))


@query(
    f"""{KEYED}, long AS (
      SELECT app_id, 'checking_status_' || coalesce(checking_status, '<missing>') AS feature
      FROM edited
      UNION ALL SELECT app_id, 'purpose_' || purpose FROM edited
      UNION ALL SELECT app_id, 'foreign_worker_' || foreign_worker FROM edited)
    SELECT app_id, feature, CAST(1 AS DOUBLE) AS value FROM long"""
)
def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = etl_transform(spark, sf_dir)
    columns = ["checking_status", "purpose", "foreign_worker"]
    return tr.one_hot_long(df, "app_id", tr.fit_levels(df, columns), columns)


@query("SELECT p_partkey, 'p_name_' || p_name AS feature, CAST(1 AS DOUBLE) AS value FROM part")
def one_hot_many_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """About a level per row."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return tr.one_hot_long(parts, "p_partkey", tr.fit_levels(parts, ["p_name"]), ["p_name"])


@query(
    f"""{LOAN} SELECT app_id, CAST(CASE savings_status WHEN 'no known savings' THEN 0
      WHEN '<100' THEN 1 WHEN '100<=X<500' THEN 2 WHEN '500<=X<1000' THEN 3 ELSE 4 END AS DOUBLE)
      AS savings_status FROM loan"""
)
def ordinal_savings(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = loan(spark, sf_dir, "savings_status")
    return df.withColumn("savings_status", tr.savings_code(F.col("savings_status")))


CODED = f"""{KEYED}, text AS (SELECT app_id, coalesce(checking_status, '<missing>')
    AS checking_status, purpose, foreign_worker, app_id % 5 > 0 AS train FROM edited),
  checking AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code
    FROM (SELECT DISTINCT checking_status AS v FROM text WHERE train)),
  purposes AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code
    FROM (SELECT DISTINCT purpose AS v FROM text WHERE train AND purpose <> 'BUILDING'))"""


@query(
    f"""{CODED} SELECT app_id, CAST(coalesce(c.code, -1) AS DOUBLE) AS checking_status,
    CAST(coalesce(p.code, -1) AS DOUBLE) AS purpose
    FROM text LEFT JOIN checking c ON c.v = checking_status LEFT JOIN purposes p ON p.v = purpose"""
)
def ordinal_learned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Levels are learned on four fifths of the rows; one purpose is never seen there."""
    df = etl_transform(spark, sf_dir).select("app_id", "checking_status", "purpose")
    train = df.filter("app_id % 5 > 0")
    levels = tr.fit_levels(train, ["checking_status"])
    levels = levels.union(tr.fit_levels(train.filter("purpose <> 'BUILDING'"), ["purpose"]))
    return tr.ordinal_encode(df, levels, ["checking_status", "purpose"])


@query(
    """SELECT c_custkey, CAST(dense_rank() OVER (ORDER BY c_name) - 1 AS DOUBLE) AS c_name,
    CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS DOUBLE) AS c_mktsegment FROM customer"""
)
def ordinal_many_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column with a level per row beside one with few."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    columns = ["c_name", "c_mktsegment"]
    return tr.ordinal_encode(customers, tr.fit_levels(customers, columns), columns)


@query(f"{KEYED} SELECT app_id, credit_amount, duration FROM edited")
def passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tr.choose(_numbers(spark, sf_dir), None)


@query(
    f"""{LOAN} SELECT app_id, round(ln(1 + credit_amount), 9) AS log_credit_amount,
    round(ln(1 + duration), 9) AS log_duration FROM loan"""
)
def function_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    step = tr.FunctionStep(
        lambda df: df.select("app_id", *[F.log1p(c).alias(f"log_{c}") for c in NUMBERS]),
        lambda names: [f"log_{name}" for name in names],
    )
    logs = step.transform(loan(spark, sf_dir, *NUMBERS))
    return rounded(logs, 9, *step.feature_names(NUMBERS))


@table_function("log1p", names=lambda inputs: [f"log_{c}" for c in inputs])
def _logs(df: DataFrame, inputs: list[str]) -> DataFrame:
    return df.withColumns({f"log_{c}": F.log1p(c) for c in inputs})


@query(
    f"""{KEYED}, logs AS (SELECT app_id, ln(1 + credit_amount) AS a, ln(1 + duration) AS d FROM edited),
    filled AS (SELECT app_id, coalesce(a, avg(a) OVER ()) AS a, coalesce(d, avg(d) OVER ()) AS d FROM logs),
    scaled AS (SELECT app_id, (a - avg(a) OVER ()) / stddev_pop(a) OVER () AS a,
      (d - avg(d) OVER ()) / stddev_pop(d) OVER () AS d FROM filled)
    SELECT app_id, 'numeric__log_credit_amount' AS feature, round(a, 6) AS value FROM scaled
    UNION ALL SELECT app_id, 'numeric__log_duration', round(d, 6) FROM scaled"""
)
def function_in_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user function, then imputing and scaling, as one saved and loaded model."""
    df = _numbers(spark, sf_dir)
    columns = tr.Columns.of(df, leave_out=["app_id"])
    step = NamedStep(function="log1p", inputs=NUMBERS)
    path = new_path(spark, "function-in-pipeline")
    tr.fit_features(df, columns, tr.Prep(scaler=tr.STANDARD), [step]).write().save(path)
    matrix = PipelineModel.load(path).transform(df)
    remove(spark, path)
    names = F.array(*[F.lit(n) for n in tr.feature_names(matrix)])
    entries = matrix.select("app_id", F.posexplode(vector_to_array("features")).alias("i", "value"))
    return rounded(entries.select("app_id", F.get(names, F.col("i")).alias("feature"), "value"), 6, "value")


@query(
    f"""{FILLED}, numbers AS (SELECT app_id,
      (credit_amount - avg(credit_amount) OVER ()) / stddev_pop(credit_amount) OVER () AS a,
      (duration - avg(duration) OVER ()) / stddev_pop(duration) OVER () AS d FROM filled),
    long AS (
      SELECT app_id, 'numeric__credit_amount' AS feature, a AS value FROM numbers
      UNION ALL SELECT app_id, 'numeric__duration', d FROM numbers
      UNION ALL SELECT app_id, 'non_numeric__checking_status_'
        || coalesce(checking_status, '<missing>'), 1 FROM edited
      UNION ALL SELECT app_id, 'non_numeric__purpose_' || purpose, 1 FROM edited
      UNION ALL SELECT app_id, 'non_numeric__foreign_worker_' || foreign_worker, 1 FROM edited
      UNION ALL SELECT app_id, 'savings_status__savings_status', CASE savings_status
        WHEN 'no known savings' THEN 0 WHEN '<100' THEN 1 WHEN '100<=X<500' THEN 2
        WHEN '500<=X<1000' THEN 3 ELSE 4 END FROM edited)
    SELECT app_id, feature, round(CAST(value AS DOUBLE), 6) AS value FROM long
    WHERE abs(value) > 1e-9"""
)
def feature_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole feature pipeline, one row per non-zero entry."""
    df = etl_transform(spark, sf_dir)
    columns = tr.Columns.of(df, leave_out=["app_id", "target"])
    prep = tr.Prep(scaler=tr.STANDARD, savings=tr.SAVINGS_ORDER)
    matrix = tr.fit_features(df, columns, prep).transform(df)
    names = F.array(*[F.lit(n) for n in tr.feature_names(matrix)])
    entries = matrix.select("app_id", F.posexplode(vector_to_array("features")).alias("i", "value"))
    return rounded(
        entries.filter(F.abs("value") > 1e-9).select(
            "app_id", F.get(names, F.col("i")).alias("feature"), "value"
        ),
        6,
        "value",
    )
