import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarryline.llm import sharding


def brute_force(shards, slots):
    def number(name, start):
        return int(hashlib.md5(name.encode()).hexdigest()[start : start + 8], 16)

    orders = [(number(s, 0) % slots, number(s, 8) % (slots - 1) + 1) for s in shards]
    owner, looked, turn = {}, [0] * len(shards), 0
    while len(owner) < slots:
        shard = turn % len(shards)
        first, step = orders[shard]
        while (slot := (first + looked[shard] * step) % slots) in owner:
            looked[shard] += 1
        owner[slot] = shards[shard]
        turn += 1
    return owner


@pytest.mark.parametrize("n, slots", [(1, 2), (3, 7), (5, 101), (20, 503)])
def test_table_equals_brute_force(spark, n, slots):
    shards = [f"s{i}" for i in range(n)]
    got = {r["slot"]: r["shard"] for r in sharding.lookup_table(spark, shards, slots).collect()}
    assert got == brute_force(shards, slots)
    shares = Counter(got.values())
    assert max(shares.values()) - min(shares.values()) <= 1


def test_few_slots_move_when_a_shard_goes(spark):
    shards = [f"s{i}" for i in range(10)]
    before, after = brute_force(shards, 1009), brute_force(shards[:-1], 1009)
    stayed = [s for s in before if before[s] != "s9"]
    assert sum(before[s] != after[s] for s in stayed) < 0.2 * len(stayed)


def test_bad_parameters(spark):
    for shards, slots in (([], 7), (["a"], 8), (["a", "a"], 7), (["a", "b", "c"], 2)):
        with pytest.raises(ValueError):
            sharding.lookup_table(spark, shards, slots)


def test_odd_rows(spark, tricky, none_at_all):
    table = sharding.lookup_table(spark, ["x", "y"], 101)
    placed = sharding.place(tricky, F.col("doc_id"), table, 101)
    assert placed.columns == [*tricky.columns, "slot_1", "shard"]
    got = placed.collect()
    assert len(got) == tricky.count() and {r["shard"] for r in got} <= {"x", "y"}
    assert len({r["slot_1"] for r in got if r["doc_id"] is None}) == 1
    assert sharding.place(none_at_all, F.col("doc_id"), table, 101).count() == 0


def test_plan_has_no_python_and_no_shuffle(spark, tricky):
    table = sharding.lookup_table(spark, ["x", "y"], 101)
    plan = sharding.place(tricky, F.col("doc_id"), table, 101)._jdf.queryExecution().toString()
    joined = plan[plan.index("Physical Plan") :].split("BroadcastExchange")[0]
    assert "BroadcastHashJoin" in joined and "SortMergeJoin" not in joined and "Python" not in joined
