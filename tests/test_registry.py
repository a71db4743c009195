"""The registry's state machine, and the promotion gate replayed over a history."""

import datetime
import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from quarryline.operators import registry as r
from quarryline.session import new_path
from quarryline.sources import tables as io


def _add_run(log, exp_id, run_id, minute, auc, params):
    start = datetime.datetime(2024, 1, 1, 0, minute, tzinfo=datetime.timezone.utc)
    line = log.spark.createDataFrame(
        [(run_id, exp_id, None, start, start + datetime.timedelta(seconds=5), {"roc_auc": auc},
          params, {"type": "BayesSearchCV"})],
        r.RUN_SCHEMA,
    )
    log.append_runs(r.run_records(line, F.col("metrics"), F.col("params"), F.col("tags")))


def test_registry_scenario(spark):
    log = r.RunLog(spark, new_path(spark, "log"))
    assert log.experiment(name="exp") is None and log.experiment(exp_id="1") is None
    assert log.run("none") is None and log.run_by_name("exp", "none") is None
    assert log.latest_versions("credit").collect() == []
    assert log.production_model("credit") is None and log.production_run("credit") is None
    assert log.last_run("1") is None

    experiments = spark.createDataFrame([("1", "exp")], "exp_id string, name string")
    log.append_experiments(experiments)
    log.append_experiments(experiments)  # already there
    assert log.experiments.count() == 1
    assert log.runs_of(name="exp").collect() == []
    _add_run(log, "1", "r1", 1, 0.9, {"model": "m", "param1": "value", "param2": "2"})
    run = log.run("r1")
    assert run["metrics"] == {"roc_auc": 0.9}
    assert run["params"] == {"param1": "value", "param2": "2"}
    assert run["tags"]["type"] == "BayesSearchCV" and run["name"] == "2024_01_01_00_01_00"
    assert log.run_by_name("exp", run["name"]) == run
    assert log.last_run("1").asDict() == run.asDict()
    assert log.run_by_name("exp", "other") is None

    assert log.register_model("r1", "credit") == 1
    assert log.register_model("r1", "credit") == 1  # not registered twice
    assert _stages(log) == {1: "None"}
    assert log.production_model("credit") is None
    log.put_in_production("credit", 1)
    assert log.production_run("credit")["run_id"] == "r1"
    log.transition("credit", 1, r.ARCHIVED)
    assert _stages(log) == {1: "Archived"} and log.production_model("credit") is None
    log.put_in_production("credit", 1)
    log.put_in_production("credit", 1)  # stays in production
    assert _stages(log) == {1: "Production"}

    _add_run(log, "1", "r2", 2, 0.8, {"param1": "value2", "param2": "3"})
    assert [x["run_id"] for x in log.runs_of(exp_id="1").collect()] == ["r2", "r1"]
    assert log.last_run("1")["run_id"] == "r2"
    assert log.register_model("r2", "credit") == 2
    log.put_in_production("credit", 2)
    assert _stages(log) == {1: "Archived", 2: "Production"}
    assert log.production_run("credit")["metrics"] == {"roc_auc": 0.8}
    only = log.latest_versions("credit", (r.ARCHIVED,)).collect()
    assert [(x["stage"], x["version"]) for x in only] == [("Archived", 1)]
    with pytest.raises(ValueError, match="no version 9"):
        log.transition("credit", 9, r.STAGING)
    with pytest.raises(ValueError, match="unknown stage"):
        log.transition("credit", 1, "Live")


def _stages(log):
    return {x["version"]: x["stage"] for x in log.state("credit").collect()}


def test_writers_at_once(spark):
    """Each run gets a version of its own, and one version stays in production."""
    log = r.RunLog(spark, new_path(spark, "log"))
    with ThreadPoolExecutor(4) as pool:
        versions = list(pool.map(lambda i: log.register_model(f"r{i % 6}", "m"), range(8)))
    assert sorted(set(versions)) == [1, 2, 3, 4, 5, 6]
    assert versions[:2] == versions[6:]  # the runs that two threads registered
    assert log.events.filter("stage = 'None'").count() == 6
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda v: log.put_in_production("m", v), versions[:6]))
    stages = sorted(x["stage"] for x in log.state("m").collect())
    assert stages == [r.ARCHIVED] * 5 + [r.PRODUCTION]
    assert log.production_model("m")["run_id"] in {f"r{i}" for i in range(6)}
    seqs = [x[0] for x in log.events.select("event_seq").distinct().orderBy("event_seq").collect()]
    assert seqs == list(range(1, 13))  # one number for each commit


def test_a_slow_writer_decides_again(spark, monkeypatch):
    """Another commit between reading and writing: the version it took is not taken twice."""
    log = r.RunLog(spark, new_path(spark, "log"))
    plain, other = r.create_once, []

    def late(session, path, text):
        if not other:
            other.append(None)
            other.append(log.register_model("a", "m"))
        return plain(session, path, text)

    monkeypatch.setattr(r, "create_once", late)
    assert log.register_model("b", "m") == 2
    assert other == [None, 1]


@pytest.mark.parametrize("move", [io._link_once, io._rename_once])
def test_files_are_created_once(spark, monkeypatch, move):
    path = new_path(spark, "once") + "/1.json"
    monkeypatch.setattr(io, "_link_once", move)
    assert io.create_once(spark, path, "first\n")
    assert not io.create_once(spark, path, "second\n")
    folder = path.rsplit("/", 1)[0]
    assert [x[0] for x in spark.read.text(folder).collect()] == ["first"]


def test_two_production_versions_are_an_error(spark):
    events = [("m", 1, "a", "Production", 1), ("m", 2, "b", "Production", 2)]
    table = spark.createDataFrame(events, r.EVENT_SCHEMA)
    with pytest.raises(Exception, match="several production versions of m"):
        r.production_model(r.version_state(table)).collect()
    fixed = r.production_model(r.version_state_one_production(table)).collect()
    assert [x["version"] for x in fixed] == [2]


def test_version_ten_is_after_version_nine(spark):
    events = [("m", v, str(v), "None", v) for v in range(1, 11)]
    assert r.next_version(spark.createDataFrame(events, r.EVENT_SCHEMA)).first()[1] == 11


@pytest.mark.parametrize("best,bar,gain,expected", [
    (0.76277, 0.75338, 0.03, False), (0.77467, 0.75338, 0.01, True),
    (0.5, 0.5, 0.0, True), (0.1, None, 0.03, True), (None, 0.5, 0.0, False),
])
def test_gate(spark, best, bar, gain, expected):
    line = spark.range(1).select(
        r.passes_gate(F.lit(best).cast("double"), F.lit(bar).cast("double"), gain)
    )
    assert line.first()[0] is expected


@pytest.mark.parametrize("kind,gain", [
    ("random", 0.0), ("random", 0.05), ("rising", 0.0), ("rising", 0.05), ("falling", 0.05),
    ("negative", 0.05), ("negative", 0.0), ("zero", 0.05),
])
def test_promotion_history_equals_a_plain_replay(spark, kind, gain):
    rng = random.Random(11)
    rows = []
    for i in range(600):  # one model holds a third of the runs
        group = "hot" if i % 3 == 0 else f"m{i % 7}"
        score = {
            "random": rng.random(), "rising": 0.1 + i / 1000, "falling": 1 - i / 1000,
            "negative": rng.random() - 0.7, "zero": 0.0,
        }[kind]
        rows.append((group, i, None if i % 11 == 5 else round(score, 4)))
    expected, bar = [], {}
    for group, i, score in rows:
        if score is not None and (group not in bar or score >= bar[group][0] * (1.0 + gain)):
            bar[group] = (score, bar.get(group, (0, 0))[1] + 1)
            expected.append((group, i, score, bar[group][1]))
    df = spark.createDataFrame(rows, "name string, at bigint, auc double").repartition(5)
    got = r.promotion_history(df, "name", "at", "auc", gain).collect()
    assert sorted(map(tuple, got)) == sorted(expected)
