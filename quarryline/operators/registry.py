"""Run log and model registry as append-only tables, and queries over them.

Tables: ``experiments(exp_id, name)``, ``runs(run_id, exp_id, name, start_time, end_time, metrics,
params, tags)``, ``model_version_events(model_name, version, run_id, stage, event_seq)``. The
state of a model version is its latest event; nothing is updated in place. Events are added by
commits, numbered without gaps, of which each is one file that only one writer can create.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.functions.scalars import elapsed_seconds, run_name, without_model
from quarryline.operators.ordered import running
from quarryline.sources.tables import create_once, path_exists

NO_STAGE, STAGING, PRODUCTION, ARCHIVED = "None", "Staging", "Production", "Archived"
STAGES = (NO_STAGE, STAGING, PRODUCTION, ARCHIVED)

EXPERIMENT_SCHEMA = "exp_id string, name string"
RUN_SCHEMA = (
    "run_id string, exp_id string, name string, start_time timestamp, end_time timestamp, "
    "metrics map<string, double>, params map<string, string>, tags map<string, string>"
)
COMMIT_TRIES = 1000  # others may take a number first; a missing file never comes back
EVENTS = "model_version_events"
EVENT_SCHEMA = (
    "model_name string, version int, run_id string, stage string, event_seq bigint"
)


# --- queries on any number of runs, experiments and models -------------------------------------


def run_records(
    started: DataFrame, metrics: Column, params: Column, tags: Column
) -> DataFrame:
    """Rows for the ``runs`` table from rows with run_id, exp_id, start_time, end_time."""
    return started.select(
        F.col("run_id").cast("string").alias("run_id"),
        F.col("exp_id").cast("string").alias("exp_id"),
        run_name(F.col("start_time")).alias("name"),
        "start_time",
        "end_time",
        metrics.alias("metrics"),
        without_model(params).alias("params"),
        tags.alias("tags"),
    )


def newest_first(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.desc("start_time"), "run_id")


def last_run(runs: DataFrame) -> DataFrame:
    """The latest run of every experiment."""
    rest = [c for c in runs.columns if c != "exp_id"]
    latest = F.max_by(F.struct(*rest), F.struct("start_time", "run_id"))
    return runs.groupBy("exp_id").agg(latest.alias("run")).select("exp_id", "run.*")


def run_properties(runs: DataFrame, experiments: DataFrame) -> DataFrame:
    named = experiments.select("exp_id", F.col("name").alias("exp_name"))
    return runs.join(named, "exp_id").withColumn(
        "elapsed_seconds", elapsed_seconds(F.col("start_time"), F.col("end_time"))
    )


def next_version(events: DataFrame) -> DataFrame:
    return events.groupBy("model_name").agg((F.max("version") + 1).alias("next_version"))


def version_state(events: DataFrame) -> DataFrame:
    """Current stage per model version when every event changes only its own version."""
    return events.groupBy("model_name", "version").agg(
        # writers that took the same number at once: the later stage name, the smaller run
        F.max_by("stage", F.struct("event_seq", "stage")).alias("stage"),
        F.min_by("run_id", F.struct("event_seq", "run_id")).alias("run_id"),
        F.max("event_seq").alias("event_seq"),
    )


def version_state_one_production(events: DataFrame) -> DataFrame:
    """Current stages when putting a version in production archives the one there before."""
    state = version_state(events)
    last = (
        events.filter(F.col("stage") == PRODUCTION)
        .groupBy("model_name")
        .agg(F.max("event_seq").alias("last_production"))
    )
    replaced = (F.col("stage") == PRODUCTION) & (F.col("event_seq") < F.col("last_production"))
    return (
        state.join(last, "model_name", "left")
        .withColumn("stage", F.when(replaced, ARCHIVED).otherwise(F.col("stage")))
        .drop("last_production")
    )


def latest_versions(state: DataFrame, stages: tuple[str, ...] | None = None) -> DataFrame:
    """Highest version per model and stage."""
    chosen = state.filter(F.col("stage").isin(list(stages))) if stages else state
    return chosen.groupBy("model_name", "stage").agg(
        F.max("version").alias("version"), F.max_by("run_id", "version").alias("run_id")
    )


def production_model(state: DataFrame) -> DataFrame:
    """The version in production per model; more than one is an error."""
    found = (
        state.filter(F.col("stage") == PRODUCTION)
        .groupBy("model_name")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max("version").alias("version"),
            F.max_by("run_id", "version").alias("run_id"),
        )
    )
    many = F.concat(F.lit("several production versions of "), "model_name")
    version = F.when(F.col("n") > 1, F.raise_error(many).cast("int")).otherwise(F.col("version"))
    return found.select("model_name", version.alias("version"), "run_id")


def production_run(state: DataFrame, runs: DataFrame) -> DataFrame:
    return production_model(state).join(runs, "run_id")


def passes_gate(best: Column, production: Column, gain: float) -> Column:
    """Promote when nothing is in production, or the best score beats it by the fraction."""
    return production.isNull() | F.coalesce(
        best >= production * (F.lit(1.0) + F.lit(float(gain))), F.lit(False)
    )


def promotion_gate(candidates: DataFrame, production: DataFrame, gain: float = 0.03) -> DataFrame:
    """One decision per model: candidates(model_name, best) against production(model_name, score)."""
    return candidates.join(production, "model_name", "left").withColumn(
        "promote", passes_gate(F.col("best"), F.col("score"), gain)
    )


def promotion_history(
    runs: DataFrame, group: str, order: str, score: str, gain: float = 0.03
) -> DataFrame:
    """Replay the gate over the whole history of every model: the promoted runs, numbered.

    A run can only be promoted if it is at least as good as all earlier ones (unless those are
    negative, where the required score lies below the one in production). Such candidates are found
    with a running maximum, in parallel whatever the size of a model. Without a required gain they
    are all promoted. Otherwise each decision depends on the one before, so the replay streams over
    the candidates of a model in order, keeping one number.
    """
    if gain < 0:
        raise ValueError("the history needs a gain of at least 0")
    scored = runs.filter(F.col(score).isNotNull()).select(
        F.col(group).alias("_group"),
        F.col(order).alias("_order"),
        F.col(score).cast("double").alias("_score"),
    )
    seen = running(scored, "_order", {"_best": ("max", F.col("_score"))}, by=["_group"])
    record = F.col("_score") >= F.col("_best")
    if gain == 0:
        promoted = running(
            seen.filter(record), "_order", {"_number": ("sum", F.lit(1))}, by=["_group"]
        )
    else:
        candidates = seen.filter(record | (F.col("_best") < 0)).drop("_best")
        promoted = _replay_in_order(candidates, gain)
    return promoted.select(
        F.col("_group").alias(group),
        F.col("_order").alias(order),
        F.col("_score").alias(score),
        F.col("_number").cast("bigint").alias("promotion"),
    )


def _replay_in_order(candidates: DataFrame, gain: float) -> DataFrame:
    """One pass over each model's candidates in time order, with constant memory."""

    def replay(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, bar, number = None, 0.0, 0
        for batch in batches:
            kept = []
            for name, place, value in zip(batch["_group"], batch["_order"], batch["_score"]):
                if current is None or name != current:
                    current, number = name, 0
                elif value < bar * (1.0 + gain):
                    continue
                bar, number = value, number + 1
                kept.append((name, place, value, number))
            yield pd.DataFrame(kept, columns=["_group", "_order", "_score", "_number"])

    kind = dict(candidates.dtypes)
    schema = f"_group {kind['_group']}, _order {kind['_order']}, _score double, _number bigint"
    ordered = candidates.repartition("_group").sortWithinPartitions("_group", "_order")
    return ordered.mapInPandas(replay, schema)


# --- the stored log ----------------------------------------------------------------------------


class RunLog:
    """The tables below one root folder. Lookups give None for what is not there."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _table(self, name: str, schema: str) -> DataFrame:
        path = f"{self.root}/{name}"
        if path_exists(self.spark, path):
            return self.spark.read.schema(schema).parquet(path)
        return self.spark.createDataFrame([], schema)

    def _append(self, df: DataFrame, name: str, like: DataFrame) -> None:
        df.select(like.columns).write.mode("append").parquet(f"{self.root}/{name}")

    @property
    def experiments(self) -> DataFrame:
        return self._table("experiments", EXPERIMENT_SCHEMA)

    @property
    def runs(self) -> DataFrame:
        return self._table("runs_log", RUN_SCHEMA)

    @property
    def events(self) -> DataFrame:
        """All events, of the files there are now: one for each commit, named by its number."""
        path = f"{self.root}/{EVENTS}"
        if path_exists(self.spark, path):
            return self.spark.read.schema(EVENT_SCHEMA).json(path)
        return self.spark.createDataFrame([], EVENT_SCHEMA)

    def append_experiments(self, experiments: DataFrame) -> None:
        """Add experiments that are not there yet, by name."""
        new = experiments.join(self.experiments.select("name"), "name", "left_anti")
        self._append(new, "experiments", self.experiments)

    def append_runs(self, records: DataFrame) -> None:
        self._append(records, "runs_log", self.runs)

    # one experiment, run or model

    def experiment(self, *, name: str | None = None, exp_id: str | None = None):
        wanted = F.col("name") == name if name is not None else F.col("exp_id") == exp_id
        return self.experiments.filter(wanted).first()

    def runs_of(self, *, name: str | None = None, exp_id: str | None = None) -> DataFrame | None:
        experiment = self.experiment(name=name, exp_id=exp_id)
        if experiment is None:
            return None
        return newest_first(self.runs.filter(F.col("exp_id") == experiment["exp_id"]))

    def last_run(self, exp_id: str):
        return last_run(self.runs.filter(F.col("exp_id") == exp_id)).first()

    def run(self, run_id: str):
        return self.runs.filter(F.col("run_id") == run_id).first()

    def run_by_name(self, experiment: str, run: str):
        """The named run, the newest when names collide; None when either is unknown."""
        runs = self.runs_of(name=experiment)
        return None if runs is None else runs.filter(F.col("name") == run).first()

    def _model_events(self, model_name: str) -> DataFrame:
        return self.events.filter(F.col("model_name") == model_name)

    def state(self, model_name: str) -> DataFrame:
        return version_state(self._model_events(model_name))

    def latest_versions(self, model_name: str, stages: tuple[str, ...] | None = None) -> DataFrame:
        return latest_versions(self.state(model_name), stages)

    def production_model(self, model_name: str):
        return production_model(self.state(model_name)).first()

    def production_run(self, model_name: str):
        model = self.production_model(model_name)
        return None if model is None else self.run(model["run_id"])

    def _commit(self, decide: Callable[[DataFrame, int], tuple[Any, list[tuple]]]) -> Any:
        """Add the events that are decided on, given all events so far and the number of the commit.

        A writer whose number was taken by another decides again on the events with that commit, so
        every decision rests on all commits before its own.
        """
        for _ in range(COMMIT_TRIES):
            events = self.events
            known = events.agg(
                F.max("event_seq").alias("last"), F.count_distinct("event_seq").alias("n")
            ).first()
            if (known["last"] or 0) != known["n"]:
                continue  # a listing during a commit may show a later file and miss an earlier one
            seq = known["n"] + 1
            answer, rows = decide(events, seq)
            fields = [part.split()[0] for part in EVENT_SCHEMA.split(", ")]
            lines = "".join(json.dumps(dict(zip(fields, (*row, seq)))) + "\n" for row in rows)
            if not rows or create_once(self.spark, f"{self.root}/{EVENTS}/{seq:019d}.json", lines):
                return answer
        raise RuntimeError(f"no commit to {self.root}/{EVENTS} in {COMMIT_TRIES} tries")

    def register_model(self, run_id: str, model_name: str) -> int:
        """The next version of the model for this run; a run is registered once per model."""

        def decide(events: DataFrame, seq: int) -> tuple[int, list[tuple]]:
            mine = F.when(F.col("run_id") == run_id, F.col("version"))
            of_model = events.filter(F.col("model_name") == model_name)
            known = of_model.agg(F.max(mine).alias("mine"), F.max("version").alias("latest")).first()
            if known["mine"] is not None:
                return known["mine"], []
            version = (known["latest"] or 0) + 1
            return version, [(model_name, version, run_id, NO_STAGE)]

        return self._commit(decide)

    def _move(self, model_name: str, version: int, stage: str, archive_others: bool) -> None:
        def decide(events: DataFrame, seq: int) -> tuple[None, list[tuple]]:
            state = version_state(events.filter(F.col("model_name") == model_name))
            chosen = (F.col("version") == version) | (F.col("stage") == PRODUCTION)
            lines = state.filter(chosen).collect()  # this version and the one in production
            run_id = next((line["run_id"] for line in lines if line["version"] == version), None)
            if run_id is None:
                raise ValueError(f"{model_name} has no version {version}")
            others = [x for x in lines if archive_others and x["version"] != version]
            rows = [(model_name, x["version"], x["run_id"], ARCHIVED) for x in others]
            return None, [*rows, (model_name, version, run_id, stage)]

        self._commit(decide)

    def transition(self, model_name: str, version: int, stage: str) -> None:
        """Move one version; the others stay where they are."""
        if stage not in STAGES:
            raise ValueError(f"unknown stage {stage!r}")
        self._move(model_name, version, stage, archive_others=False)

    def put_in_production(self, model_name: str, version: int) -> None:
        """Archive the version now in production and promote this one, in one commit."""
        self._move(model_name, version, PRODUCTION, archive_others=True)
