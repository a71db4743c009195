"""Queries over the run log, the model registry and the promotion gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.operators import registry as r
from quarryline.operators.registry import RunLog
from quarryline.queries.catalog import query, rounded, stamp
from quarryline.queries.views import (
    RUN_SQL,
    STAGE_EVENT_SQL,
    recursive_views,
    run,
    stage_event,
    with_views,
)
from quarryline.session import new_path

RUN = with_views(RUN_SQL)
EVENT = with_views(STAGE_EVENT_SQL)
START = "strftime(start_time, '%Y-%m-%d %H:%M:%S.%f') AS start_time"
NAME = "strftime(start_time, '%Y_%m_%d_%H_%M_%S')"
STATE_SQL = """
state AS (
  SELECT model_name, version, max_by(stage, event_seq) AS stage,
         min_by(run_id, event_seq) AS run_id, max(event_seq) AS event_seq
  FROM stage_event GROUP BY model_name, version)"""
PROMOTED_SQL = """
promoted AS (
  SELECT s.model_name, s.version, s.run_id,
    CASE WHEN s.stage = 'Production' AND EXISTS (SELECT 1 FROM stage_event e
           WHERE e.model_name = s.model_name AND e.stage = 'Production'
             AND e.event_seq > s.event_seq)
         THEN 'Archived' ELSE s.stage END AS stage
  FROM state s)"""


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run view in the shape of the ``runs`` table."""
    metrics = F.when(
        F.col("roc_auc").isNotNull(), F.create_map(F.lit("roc_auc"), F.col("roc_auc"))
    ).otherwise(F.create_map().cast("map<string, double>"))
    params = F.create_map(
        F.lit("model"), F.lit("LogisticRegression()"), F.lit("model__max_depth"), F.col("k")
    )
    tags = F.create_map(F.lit("type"), F.col("kind"))
    return r.run_records(run(spark, sf_dir), metrics, params, tags)


def _experiments(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = run(spark, sf_dir).select(F.col("exp_id").cast("string").alias("exp_id")).distinct()
    return ids.select("exp_id", F.concat(F.lit("experiment_"), "exp_id").alias("name"))


def _stored(spark: SparkSession, sf_dir: str) -> RunLog:
    log = RunLog(spark, new_path(spark, "log"))
    log.append_experiments(_experiments(spark, sf_dir))
    log.append_runs(_records(spark, sf_dir))
    return log


@query(
    f"""{RUN} SELECT exp_id, max_by(run_id, start_us) AS run_id,
    arg_max_null(roc_auc, start_us) AS roc_auc,
    strftime(max(start_time), '%Y-%m-%d %H:%M:%S.%f') AS start_time FROM run GROUP BY exp_id"""
)
def last_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = r.last_run(run(spark, sf_dir))
    return latest.select(
        "exp_id", "run_id", "roc_auc", stamp(F.col("start_time")).alias("start_time")
    )


@query(f"{RUN} SELECT run_id, exp_id, {START} FROM run ORDER BY run.start_time DESC, run_id")
def runs_newest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = r.newest_first(run(spark, sf_dir).select("run_id", "exp_id", "start_time"))
    return ordered.withColumn("start_time", stamp(F.col("start_time")))


@query(
    f"""{RUN} SELECT run_id, CAST(exp_id AS VARCHAR) AS exp_id, {NAME} AS name, {START},
    roc_auc, k AS max_depth, kind AS type FROM run"""
)
def run_append_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir).runs.select(
        "run_id",
        "exp_id",
        "name",
        stamp(F.col("start_time")).alias("start_time"),
        F.col("metrics")["roc_auc"].alias("roc_auc"),
        F.col("params")["model__max_depth"].alias("max_depth"),
        F.col("tags")["type"].alias("type"),
    )


@query(f"{RUN} SELECT run_id, 'roc_auc' AS metric, roc_auc AS value FROM run WHERE roc_auc IS NOT NULL")
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir).select(
        "run_id", F.explode("metrics").alias("metric", "value")
    )


@query(
    f"""{RUN} SELECT DISTINCT CAST(exp_id AS VARCHAR) AS exp_id,
    'experiment_' || CAST(exp_id AS VARCHAR) AS name FROM run WHERE exp_id = 8"""
)
def experiment_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _stored(spark, sf_dir)
    if log.experiment(name="no such experiment") is not None:
        raise AssertionError("an unknown experiment must give None")
    return log.experiments.filter(F.col("name") == "experiment_8")


@query(f"{RUN} SELECT run_id, {NAME} AS name, {START} FROM run WHERE exp_id = 8")
def runs_of_experiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = _stored(spark, sf_dir).runs_of(name="experiment_8")
    return runs.select("run_id", "name", stamp(F.col("start_time")).alias("start_time"))


@query(
    f"""{RUN}, newest AS (SELECT exp_id, {NAME} AS name, max_by(run_id, start_us) AS run_id
      FROM run GROUP BY 1, 2)
    SELECT CAST(exp_id AS VARCHAR) AS exp_id, name, run_id FROM newest"""
)
def run_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run by (experiment, name), for every pair at once; the newest when names collide."""
    runs = _records(spark, sf_dir)
    return runs.groupBy("exp_id", "name").agg(
        F.max_by("run_id", F.struct("start_time", "run_id")).alias("run_id")
    )


@query(
    f"""{RUN} SELECT run_id, 'experiment_' || CAST(exp_id AS VARCHAR) AS exp_name, {NAME} AS name,
    round((end_us - start_us) / CAST(1000000 AS DOUBLE), 2) AS elapsed_seconds,
    k AS max_depth, kind AS type, roc_auc FROM run"""
)
def run_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = r.run_properties(_records(spark, sf_dir), _experiments(spark, sf_dir))
    return rounded(table, 2, "elapsed_seconds").select(
        "run_id",
        "exp_name",
        "name",
        "elapsed_seconds",
        F.col("params")["model__max_depth"].alias("max_depth"),
        F.col("tags")["type"].alias("type"),
        F.col("metrics")["roc_auc"].alias("roc_auc"),
    )


@query(
    f"""{EVENT} SELECT model_name, CAST(max(version) + 1 AS INTEGER) AS next_version
    FROM stage_event GROUP BY model_name"""
)
def next_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.next_version(stage_event(spark, sf_dir))


@query(f"{with_views(STAGE_EVENT_SQL, STATE_SQL)} SELECT model_name, version, stage, run_id FROM state")
def stage_after_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.version_state(stage_event(spark, sf_dir)).drop("event_seq")


@query(
    f"""{with_views(STAGE_EVENT_SQL, STATE_SQL, PROMOTED_SQL)}
    SELECT model_name, version, stage, run_id FROM promoted"""
)
def stage_after_promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.version_state_one_production(stage_event(spark, sf_dir)).drop("event_seq")


@query(
    f"""{with_views(STAGE_EVENT_SQL, STATE_SQL, PROMOTED_SQL)}
    SELECT model_name, stage, max(version) AS version, max_by(run_id, version) AS run_id
    FROM promoted GROUP BY model_name, stage"""
)
def latest_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.latest_versions(r.version_state_one_production(stage_event(spark, sf_dir)))


@query(
    f"""{with_views(STAGE_EVENT_SQL, STATE_SQL, PROMOTED_SQL)}
    SELECT model_name, version, run_id FROM promoted WHERE stage = 'Production'"""
)
def production_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return r.production_model(r.version_state_one_production(stage_event(spark, sf_dir)))


@query(
    f"""{with_views(STAGE_EVENT_SQL, STATE_SQL, PROMOTED_SQL, RUN_SQL)}
    SELECT p.model_name, p.version, p.run_id, r.roc_auc, {START}
    FROM promoted p JOIN run r ON r.run_id = p.run_id WHERE p.stage = 'Production'"""
)
def production_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = r.version_state_one_production(stage_event(spark, sf_dir))
    found = r.production_run(state, run(spark, sf_dir))
    return found.select(
        "model_name", "version", "run_id", "roc_auc", stamp(F.col("start_time")).alias("start_time")
    )


@query(
    f"""{with_views(STAGE_EVENT_SQL, STATE_SQL, PROMOTED_SQL, RUN_SQL)},
    production AS (SELECT p.model_name, r.roc_auc AS score FROM promoted p JOIN run r
      ON r.run_id = p.run_id WHERE p.stage = 'Production'),
    latest AS (SELECT 'model_' || CAST(exp_id AS VARCHAR) AS model_name,
      arg_max_null(roc_auc, start_us) AS best FROM run GROUP BY exp_id)
    SELECT l.model_name, best, score, score IS NULL
      OR coalesce(best >= score * CAST(1.03 AS DOUBLE), false) AS promote
    FROM latest l LEFT JOIN production p ON p.model_name = l.model_name"""
)
def promotion_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = run(spark, sf_dir)
    state = r.version_state_one_production(stage_event(spark, sf_dir))
    production = r.production_run(state, runs).select(
        "model_name", F.col("roc_auc").alias("score")
    )
    latest = r.last_run(runs).select(
        F.concat(F.lit("model_"), F.col("exp_id").cast("string")).alias("model_name"),
        F.col("roc_auc").alias("best"),
    )
    return r.promotion_gate(latest, production, 0.03)


@query(
    f"""{recursive_views(RUN_SQL)},
    ordered AS (SELECT exp_id, start_us, roc_auc,
      row_number() OVER (PARTITION BY exp_id ORDER BY start_us) AS place
      FROM run WHERE roc_auc IS NOT NULL),
    replay AS (
      SELECT exp_id, start_us, roc_auc, place, roc_auc AS bar, 1 AS promotion, true AS promoted
      FROM ordered WHERE place = 1
      UNION ALL
      SELECT o.exp_id, o.start_us, o.roc_auc, o.place,
        CASE WHEN o.roc_auc >= p.bar * CAST(1.03 AS DOUBLE) THEN o.roc_auc ELSE p.bar END,
        p.promotion + CASE WHEN o.roc_auc >= p.bar * CAST(1.03 AS DOUBLE) THEN 1 ELSE 0 END,
        o.roc_auc >= p.bar * CAST(1.03 AS DOUBLE)
      FROM replay p JOIN ordered o ON o.exp_id = p.exp_id AND o.place = p.place + 1)
    SELECT exp_id, start_us, roc_auc, CAST(promotion AS BIGINT) AS promotion
    FROM replay WHERE promoted"""
)
def promotion_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = run(spark, sf_dir).withColumn("start_us", F.unix_micros("start_time"))
    return r.promotion_history(runs, "exp_id", "start_us", "roc_auc", 0.03)
