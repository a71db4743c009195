import math
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarryline.llm import mixing


def shares(sizes, limit=3.0):
    """Targets by sharing again what is above the limits, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (1.0, 2.0, 3.0)[i % 3] for i, s in enumerate(names)}
    done, total = {}, sum(sizes.values())
    while len(done) < len(sizes):
        left = total - sum(done.values())
        rest = sum(weight[s] for s in sizes if s not in done)
        share = {s: left * weight[s] / rest for s in sizes if s not in done}
        above = [s for s in share if share[s] > limit * sizes[s] + 1e-9]
        if not above:
            return done | share
        done |= {s: limit * sizes[s] for s in above}
    return done


def targets(spark, sizes):
    rows = [(s, n) for s, n in sizes.items()]
    df = spark.createDataFrame(rows, "source string, size long")
    return {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}


CASES = [
    {"a": 10},
    {"a": 1000, "b": 1, "c": 1},
    {"a": 1, "b": 5, "c": 1000, None: 30, "\U0001f600": 7, "\uffff": 9},
    {"a": 0, "b": 10},
    {f"s{i:02d}": (i * 37) % 101 + 1 for i in range(20)},
    {"x": 100000, **{f"s{i}": 1 for i in range(10)}},
]


@pytest.mark.parametrize("sizes", CASES)
def test_targets_equal_repeated_sharing(spark, sizes):
    got, want = targets(spark, sizes), shares(sizes)
    assert got.keys() == want.keys()
    for s in want:
        assert math.isclose(got[s], want[s], rel_tol=1e-9, abs_tol=1e-9)


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.text("abcdef", min_size=1, max_size=3), st.integers(1, 10**6), min_size=1))
def test_repeated_sharing_ends_at_one_level(sizes):
    want = shares(sizes)
    assert math.isclose(sum(want.values()), sum(sizes.values()), rel_tol=1e-9)
    assert all(want[s] <= 3 * sizes[s] + 1e-6 for s in sizes)


def test_taken_words_come_near_the_targets(spark, prose):
    rows = [(i, prose(1 + i % 50, i), "abcd"[min(i % 10, 3)]) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    taken, target = defaultdict(int), {}
    for r in got:
        assert 0 <= r["epochs"] <= 3
        taken[r["source"]] += r["epochs"] * r["size"]
        target[r["source"]] = r["target"]
    for s in target:
        assert abs(taken[s] - target[s]) <= 25
    # Complete epochs come first: within a source the numbers of epochs differ by one at most.
    for s in target:
        assert len({r["epochs"] for r in got if r["source"] == s}) <= 2


def test_repeated_rows_fill_the_budget(spark):
    rows = [(1, "w " * 10, "a")] * 500 + [(2, "w " * 10, "b")] * 1000
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    for s in "ab":
        own = [r for r in got if r["source"] == s]
        assert abs(sum(r["epochs"] * 10 for r in own) - own[0]["target"]) <= 5


def test_good_documents_are_taken_more_often(spark):
    rows = [(i, "w " * 10, "ab"[i % 3 == 0]) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    marks = spark.createDataFrame([(i, 4.0 if i % 2 else 1.0) for i in range(6000)], "doc_id long, weight double")
    got = mixing.mix(docs, quality=marks).filter("source = 'a' and epochs > 0").collect()
    by_mark = Counter(r["row"]["doc_id"] % 2 for r in got)
    assert by_mark[1] > 1.2 * by_mark[0]


def test_odd_rows(spark, tricky, none_at_all):
    got = mixing.mix(tricky, carry=["doc_id", "text", "size", "weight"]).collect()
    assert len(got) == tricky.count()
    assert all(r["size"] == len((r["row"]["text"] or "").encode().split()) for r in got)
    assert mixing.mix(none_at_all).count() == 0
    empty = tricky.filter("text is null")
    assert {r["target"] for r in mixing.mix(empty).collect()} == {0.0}
