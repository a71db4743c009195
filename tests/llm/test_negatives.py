import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarryline.llm import negatives as ng

SCHEMA = "vec_id long, embedding array<float>, label int, strip string, score double, rank string"


def brute_force(rows, is_anchor):
    """All lines, by scoring all pairs with Python's integers."""
    part = []
    for i, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        part.append((i, [math.floor(256 * float(x)) for x in vector], label))
    out, seen = [], set()
    for anchor in part:
        i, mine, label = anchor
        if not is_anchor(i) or (i, tuple(mine), label) in seen:
            continue
        seen.add((i, tuple(mine), label))
        scored = [(sum(a * b for a, b in zip(mine, v)), j, other) for j, v, other in part if j != i]
        scored.sort(key=lambda s: (-s[0], j if (j := s[1]) is not None else math.inf))
        positives = [s for s in scored if s[2] == label][:5]
        for score, positive, _ in positives:
            fits = [s for s in scored if s[2] != label and 80 * score <= 100 * s[0] <= 100 * score][:5]
            out += [(i, positive, k + 1, s[1], score, s[0]) for k, s in enumerate(fits)]
    return sorted(out, key=repr)


def mine(spark, rows, every=100, kind="float"):
    lines = [(i, v, label, "s", 1.0, None) for i, v, label in rows]
    table = spark.createDataFrame(lines, SCHEMA.replace("float", kind)).repartition(4)
    return sorted((tuple(r) for r in ng.hard_negatives(table, F.col("vec_id") % every == 0).collect()), key=repr)


def cloud(n, wide, seed, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, wide))
    data = centres[rng.integers(0, 6, n)] + 0.3 * rng.normal(size=(n, wide))
    data = (data / np.linalg.norm(data, axis=1, keepdims=True)).astype(np.float32)
    return [(i, [float(x) for x in data[i]], int(rng.integers(0, labels))) for i in range(n)]


@pytest.mark.parametrize("wide,every", [(8, 10), (64, 100), (1, 20)])
def test_equals_brute_force(spark, monkeypatch, wide, every):
    monkeypatch.setattr(ng, "STRIP", 150)
    monkeypatch.setattr(ng, "SHARD", 8)
    rows = cloud(700, wide, wide)
    want = brute_force(rows, lambda i: i % every == 0)
    assert mine(spark, rows, every) == want and want


def test_ties_copies_and_odd_rows(spark):
    draw = random.Random(1)
    rows = [(i, [draw.choice([-0.5, 0.0, 0.25, 0.5]) for _ in range(3)], draw.randrange(3)) for i in range(400)]
    same = [0.5, 0.25, 0.0]
    rows += [(1000 + i, same, i % 2) for i in range(300)]  # a vector that many rows have
    rows += [(200, same, 1), (200, same, 1), (200, same, 2), (300, [0.5], 1), (301, [], 1), (302, [0.0] * 3, 0)]
    rows += [(400, None, 1), (401, same, None), (402, [math.nan, 0.0, 0.0], 1), (403, [None, 0.1, 0.1], 1)]
    rows += [(500, [math.inf, 0.0, 0.0], 1), (None, same, 1), (None, same, 2), (501, same + [0.25], 2)]
    want = brute_force(rows, lambda i: i is not None and i % 100 == 0)
    assert mine(spark, rows) == want and want


def test_large_components_stay_exact(spark):
    rng = random.Random(4)
    for top in (40.0, 1e4, 4e6):
        rows = [(i, [rng.uniform(-top, top) for _ in range(4)], i % 3) for i in range(200)]
        want = brute_force(rows, lambda i: i % 10 == 0)
        assert want and all(abs(x) < 2**63 for line in want for x in line)
        assert mine(spark, rows, 10, "double") == want


def test_nothing_to_ask(spark):
    assert mine(spark, []) == []
    assert mine(spark, [(1, [0.5], 1), (2, [0.5], 2)]) == []
    assert mine(spark, [(100, [0.5], 1), (2, [0.5], 2)]) == []  # no positives


def test_bounds_hold_and_leave_rows_out():
    rng = np.random.default_rng(3)
    numbers = np.floor(256 * rng.normal(size=(300, 5)) * 10.0 ** rng.integers(-2, 3, (300, 1)))
    numbers[:5] = 0
    numbers[5:40] = numbers[40:75] * 2  # the same direction
    directions = numbers[100:104] / np.maximum(ng._norms(numbers[100:104]), 1)[:, None]
    norms = ng._norms(numbers)
    angles = ng._angles(numbers, norms, directions)
    low, high = ng.bounds(angles, angles, norms, norms)
    exact = numbers @ numbers.T
    assert (low <= exact).all() and (exact <= high).all()
    assert (high < np.outer(norms, norms) * 0.9).mean() > 0.2


def test_query_on_few_rows_of_the_table(spark, sf_dir):
    from quarryline.llm.queries import QUERIES

    table = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    rows = [(i, v, (x + 1) % 10 if i % 7 == 0 and x is not None else x) for i, v, x in table]
    got = QUERIES["op13_angular_filter"](spark, sf_dir)
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert got.columns == names
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_force(rows, lambda i: i % 100 == 0)
