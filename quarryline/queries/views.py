"""Working tables derived from the test tables, as Spark DataFrames and as SQL.

Each view is written twice on purpose: the Spark form feeds the queries, the SQL form the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}
MODELS = (
    "LogisticRegression()",
    "ExtraTreesClassifier()",
    "RandomForestClassifier()",
    "XGBClassifier()",
    "LGBMClassifier()",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


LOAN_COLUMNS = (
    "credit_amount", "duration", "checking_status", "purpose", "savings_status",
    "foreign_worker", "target",
)


def loan(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Loan applications: one row per order. Only the tables behind ``columns`` are joined."""
    columns = columns or LOAN_COLUMNS
    orders = table(spark, sf_dir, "orders")
    if {"purpose", "savings_status", "foreign_worker"} & set(columns):
        orders = orders.join(
            table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
        )
    if "duration" in columns:
        items = (
            table(spark, sf_dir, "lineitem")
            .groupBy("l_orderkey")
            .agg(F.count(F.lit(1)).cast("double").alias("n_items"))
        )
        orders = orders.join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    balance = F.col("c_acctbal")
    defined = {
        "credit_amount": F.col("o_totalprice"),
        "duration": F.col("n_items"),
        "checking_status": F.col("o_orderpriority"),
        "purpose": F.col("c_mktsegment"),
        "savings_status": F.when(balance < 0, "no known savings")
        .when(balance < 100, "<100")
        .when(balance < 500, "100<=X<500")
        .when(balance < 1000, "500<=X<1000")
        .otherwise(">=1000"),
        "foreign_worker": F.col("c_nationkey") >= 5,
        "target": F.when(F.col("o_orderstatus") == "F", "bad").otherwise("good"),
    }
    return orders.select(
        F.col("o_orderkey").alias("app_id"), *[defined[c].alias(c) for c in columns]
    )


LOAN_SQL = """
loan AS (
  SELECT o.o_orderkey AS app_id, o.o_totalprice AS credit_amount,
         CAST(l.n AS DOUBLE) AS duration, o.o_orderpriority AS checking_status,
         c.c_mktsegment AS purpose,
         CASE WHEN c.c_acctbal < 0 THEN 'no known savings' WHEN c.c_acctbal < 100 THEN '<100'
              WHEN c.c_acctbal < 500 THEN '100<=X<500' WHEN c.c_acctbal < 1000 THEN '500<=X<1000'
              ELSE '>=1000' END AS savings_status,
         c.c_nationkey >= 5 AS foreign_worker,
         CASE WHEN o.o_orderstatus = 'F' THEN 'bad' ELSE 'good' END AS target
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
  LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) l
    ON l.l_orderkey = o.o_orderkey)"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A labelled score per order, with a real signal and many ties; ``rival`` is a weaker one."""
    orders = table(spark, sf_dir, "orders")
    label = (F.col("o_orderstatus") == "F").cast("int")
    capped = F.least(F.col("o_totalprice"), F.lit(500000.0)) / F.lit(500000.0)
    return orders.select(
        F.col("o_orderkey").alias("app_id"),
        label.alias("label"),
        F.round((capped + F.lit(0.5) * label) / F.lit(1.5), 3).alias("score"),
        F.round(capped, 2).alias("rival"),
    )


SCORED_SQL = """
scored AS (
  SELECT o_orderkey AS app_id, label,
         round((capped + CAST(0.5 AS DOUBLE) * label) / CAST(1.5 AS DOUBLE), 3) AS score,
         round(capped, 2) AS rival
  FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label,
               least(o_totalprice, CAST(500000 AS DOUBLE)) / CAST(500000 AS DOUBLE) AS capped
        FROM orders))"""


def _score() -> Column:
    value = F.col("value")
    return F.when(
        F.col("event_type") != "error", F.round(value / (value + F.lit(50.0)), 6)
    )


def trial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search trials: one row per event, failed trials without a score."""
    events = table(spark, sf_dir, "events")
    names = F.array(*[F.lit(m) for m in MODELS])
    key = F.col("event_id")
    model = F.element_at(names, (key % 5 + 1).cast("int"))
    imputer = (
        F.when(key % 4 < 2, "SimpleImputer()")
        .when(key % 4 == 2, "SimpleImputer(strategy='median')")
        .otherwise("SimpleImputer(strategy='most_frequent')")
    )
    savings = F.when(key % 3 == 0, "SavingsStatusEncoder()").otherwise("OneHotEncoder()")
    return events.select(
        key.alias("trial_id"),
        F.col("user_id").alias("exp_id"),
        model.alias("model"),
        _score().alias("score"),
        F.create_map(
            F.lit("model"), model,
            F.lit("model__max_depth"), F.get_json_object("props", "$.k"),
            F.lit("model__min_samples_leaf"), (F.col("user_id") % 50 + 1).cast("string"),
            F.lit("prep__numeric__imputer__transformer"), imputer,
            F.lit("prep__savings_status__savings_encoder__transformer"), savings,
        ).alias("params"),
    )


TRIAL_SQL = """
trial AS (
  SELECT event_id AS trial_id, user_id AS exp_id,
         CASE event_id % 5 WHEN 0 THEN 'LogisticRegression()' WHEN 1 THEN 'ExtraTreesClassifier()'
              WHEN 2 THEN 'RandomForestClassifier()' WHEN 3 THEN 'XGBClassifier()'
              ELSE 'LGBMClassifier()' END AS model,
         CASE WHEN event_type <> 'error'
              THEN round(value / (value + CAST(50 AS DOUBLE)), 6) END AS score,
         regexp_extract(props, '"k": *([0-9]+)', 1) AS max_depth,
         CAST(user_id % 50 + 1 AS VARCHAR) AS min_samples_leaf,
         CASE event_id % 4 WHEN 2 THEN 'SimpleImputer(strategy=''median'')'
              WHEN 3 THEN 'SimpleImputer(strategy=''most_frequent'')'
              ELSE 'SimpleImputer()' END AS imputer,
         CASE event_id % 3 WHEN 0 THEN 'SavingsStatusEncoder()' ELSE 'OneHotEncoder()' END
           AS savings_status_encoder
  FROM events)"""

PARAM_SQL = """
param AS (
  SELECT trial_id, model, score, 'model' AS path, 'model' AS param, model AS value FROM trial
  UNION ALL SELECT trial_id, model, score, 'model__max_depth', 'max_depth', max_depth FROM trial
  UNION ALL SELECT trial_id, model, score, 'model__min_samples_leaf', 'min_samples_leaf',
                   min_samples_leaf FROM trial
  UNION ALL SELECT trial_id, model, score, 'prep__numeric__imputer__transformer', 'imputer',
                   imputer FROM trial
  UNION ALL SELECT trial_id, model, score, 'prep__savings_status__savings_encoder__transformer',
                   'savings_status_encoder', savings_status_encoder FROM trial)"""


def trial_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three fold scores per trial; a failed fold has none."""
    events = table(spark, sf_dir, "events")
    return events.select(
        F.floor(F.col("event_id") / 3).alias("trial_id"),
        (F.col("event_id") % 3).alias("fold"),
        _score().alias("score"),
    )


TRIAL_SCORES_SQL = """
trial_scores AS (
  SELECT event_id // 3 AS trial_id, event_id % 3 AS fold,
         CASE WHEN event_type <> 'error'
              THEN round(value / (value + CAST(50 AS DOUBLE)), 6) END AS score
  FROM events)"""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logged runs: one per event."""
    events = table(spark, sf_dir, "events")
    start = F.col("ts").cast("timestamp")
    end = F.timestamp_micros(
        F.unix_micros(start) + F.round(F.col("value") * F.lit(1e6)).cast("bigint")
    )
    return events.select(
        F.col("event_id").cast("string").alias("run_id"),
        F.col("user_id").alias("exp_id"),
        start.alias("start_time"),
        end.alias("end_time"),
        _score().alias("roc_auc"),
        F.col("event_type").alias("kind"),
        F.get_json_object("props", "$.k").alias("k"),
    )


RUN_SQL = """
run AS (
  SELECT CAST(event_id AS VARCHAR) AS run_id, event_id, user_id AS exp_id, epoch_us(ts) AS start_us,
         ts AS start_time,
         epoch_us(ts) + CAST(round(value * CAST(1000000 AS DOUBLE)) AS BIGINT) AS end_us,
         CASE WHEN event_type <> 'error'
              THEN round(value / (value + CAST(50 AS DOUBLE)), 6) END AS roc_auc,
         event_type AS kind, regexp_extract(props, '"k": *([0-9]+)', 1) AS k
  FROM events)"""


def stage_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage changes of model versions, in the order of ``event_seq``."""
    events = table(spark, sf_dir, "events").filter("event_type <> 'error'")
    stage = (
        F.when(F.col("event_type") == "purchase", "Production")
        .when(F.col("event_type") == "view", "Staging")
        .when(F.col("event_type") == "click", "Archived")
        .otherwise("None")
    )
    return events.select(
        F.concat(F.lit("model_"), F.col("user_id").cast("string")).alias("model_name"),
        (F.col("event_id") % 20 + 1).cast("int").alias("version"),
        F.col("event_id").cast("string").alias("run_id"),
        stage.alias("stage"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("event_seq"),
    )


STAGE_EVENT_SQL = """
stage_event AS (
  SELECT 'model_' || CAST(user_id AS VARCHAR) AS model_name,
         CAST(event_id % 20 + 1 AS INTEGER) AS version, CAST(event_id AS VARCHAR) AS run_id,
         CASE event_type WHEN 'purchase' THEN 'Production' WHEN 'view' THEN 'Staging'
              WHEN 'click' THEN 'Archived' ELSE 'None' END AS stage,
         epoch_us(ts) AS event_seq
  FROM events WHERE event_type <> 'error')"""


def doc_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents for the classifiers: label 1 = bad quality, NULL where nobody judged."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("label"))
    return documents.join(labels, "doc_id", "left")


def doc_feat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents."""
    return doc_all(spark, sf_dir).filter("label IS NOT NULL")


def reg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items for the regressors."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_extendedprice").alias("label"), "l_quantity", "l_discount", "l_returnflag"
    )


def with_views(*views: str) -> str:
    return "WITH " + ",".join(views)


def recursive_views(*views: str) -> str:
    return "WITH RECURSIVE " + ",".join(views)
