import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarryline.llm import similarity_join as sj
from quarryline.llm.common import words_of


def brute_force(rows, words=5, percent=80):
    """(n_shingles, component) of each row, by comparing all sets."""
    sets = []
    for _, text in rows:
        found = words_of(text)
        wide = min(words, len(found))
        sets.append({tuple(found[i : i + wide]) for i in range(len(found) - wide + 1)} if found else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        groups[root(i)].append(doc_id)
    first = {r: min((i for i in ids if i is not None), default=None) for r, ids in groups.items()}
    return [(len(sets[i]), first[root(i)] if sets[i] else rows[i][0]) for i in range(len(rows))]


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sj.join_components(docs, carry=["doc_id", "text"]).collect()
    want = defaultdict(list)
    for (doc_id, text), answer in zip(rows, brute_force(rows)):
        want[doc_id, text].append(answer)
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_shingles"], r["component_id"]) in want[r["row"]["doc_id"], r["row"]["text"]]
    leaders = [r for r in got if r["leader"] and r["n_shingles"]]
    assert len(leaders) == len({r["component_id"] for r in got if r["n_shingles"]})
    return got


def test_near_copies_at_every_distance(spark, prose):
    draw, rows = random.Random(3), []
    for i in range(60):
        base = prose(draw.choice([6, 12, 30, 100, 300]), i).split()
        rows.append((len(rows), " ".join(base)))
        for changes in range(draw.randint(0, 4)):
            new = list(base)
            for _ in range(changes + 1):
                new[draw.randrange(len(new))] = f"new{draw.random()}"
            rows.append((len(rows), " ".join(new[: draw.randint(len(new) * 4 // 5, len(new))])))
    check(spark, rows)


def test_large_group_with_a_common_passage(spark, prose):
    draw, rows = random.Random(4), []
    passage, base = prose(40, 1000), prose(120, 1001).split()
    for i in range(150):  # near copies of one text, some of them near to others only
        new = list(base)
        for _ in range(draw.randint(0, 5)):
            new[draw.randrange(len(new))] = f"v{draw.randrange(50)}"
        rows.append((1000 - i, " ".join(new)))
    rows += [(2000 + i, f"{passage} {prose(30 + i % 3, 3000 + i)}") for i in range(100)]
    check(spark, rows)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 400), st.integers(0, 60), st.integers(0, 60), st.integers(0, 10**6))
def test_similar_sets_share_a_signature(common, left, right, seed):
    draw = np.random.default_rng(seed)
    values = np.unique(draw.integers(0, 2**63, common + left + right, dtype=np.uint64))
    a = np.sort(np.concatenate([values[:common], values[common : common + left]]))
    b = np.sort(np.concatenate([values[:common], values[common + left :]]))
    if not len(a) or not len(b) or not sj.similar(a, b) or np.array_equal(a, b):
        return
    codes, owner = sj.sign([a, b], sj.Bands())
    assert set(codes[owner == 0]) & set(codes[owner == 1])


def test_contraction_finds_components(spark):
    draw = random.Random(5)
    links = {tuple(sorted(draw.sample(range(300), 2))) for _ in range(200)} | {(i, i + 1) for i in range(400, 460)}
    links |= {(500, i) for i in range(501, 600)}
    parent = {x: x for pair in links for x in pair}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    got = sj.components(spark.createDataFrame(sorted(links), "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in got} == {x: root(x) for x in parent}


def test_threshold_is_exact():
    universe = np.arange(100, dtype=np.uint64)
    assert sj.similar(universe[:80], universe) and not sj.similar(universe[:79], universe)


def test_odd_rows(spark, tricky, none_at_all):
    rows = [(r["doc_id"], r["text"]) for r in tricky.select("doc_id", "text").collect()]
    check(spark, rows)
    got = sj.join_components(tricky, carry=tricky.columns)
    assert got.select("row.*").columns == tricky.columns
    assert sj.join_components(none_at_all).count() == 0


@pytest.mark.parametrize("text, n", [("", 0), ("a", 1), ("a b c d", 1), ("a b c d e f", 2), ("a " * 9, 1)])
def test_shingles_of_short_texts(text, n):
    assert len(sj.shingles(text)) == n


def test_texts_that_a_join_does_not_need_leave_before_its_shuffle(spark):
    nodes = np.random.default_rng(5).integers(-(1 << 63), 1 << 63, 20_000, np.int64).tolist()
    texts = spark.createDataFrame([(n, f"text {n}") for n in nodes], "node long, packed string")
    wanted = spark.createDataFrame([(n,) for n in [*nodes[:500], *nodes[:50]]], "node long")
    left = sj._perhaps_in(texts, wanted)
    found = left.collect()
    assert left.columns == texts.columns
    assert {r["node"] for r in found} >= set(nodes[:500]) and len(found) == len({r["node"] for r in found})
    assert len(found) < 1_000
    assert "SortMergeJoin" not in left._jdf.queryExecution().toString()
    assert sj._perhaps_in(texts, wanted.limit(0)).isEmpty()
