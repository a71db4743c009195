"""Ranks, cuts and running totals against brute force, with hot values, NULLs and empty input."""

import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarryline.operators import ordered


def _skewed(n: int, seed: int = 7) -> list[tuple]:
    """A third of the rows share one value; some have none."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        kind = rng.random()
        value = 0.5 if kind < 0.35 else None if kind < 0.45 else round(rng.random(), 2)
        rows.append((i, "a" if rng.random() < 0.6 else "b", value))
    rng.shuffle(rows)
    return rows


SCHEMA = "id bigint, g string, v double"


def test_exact_quantiles_match_sorting(spark):
    rows = _skewed(3000)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    values = sorted(v for _, _, v in rows if v is not None)
    expected = []
    for p in probabilities:
        spot = p * (len(values) - 1)
        low, high = values[math.floor(spot)], values[math.ceil(spot)]
        expected.append(low + (high - low) * (spot - math.floor(spot)))
    assert ordered.exact_quantiles(df, ["v"], probabilities)["v"] == pytest.approx(expected)


@pytest.mark.parametrize("bins", [2, 7])
def test_bins_are_divided_until_few_rows_are_left(spark, monkeypatch, bins):
    """Heavy tails, a hot value, infinities and huge integers, with tasks of at most 20 rows."""
    monkeypatch.setattr(ordered, "ROWS_TO_SORT", 20)
    monkeypatch.setattr(ordered, "BINS", bins)
    rng = random.Random(2)
    values = [rng.lognormvariate(0, 6) for _ in range(300)] + [3.25] * 200
    values += [math.inf, -math.inf, -1e308, 1e308, 0.0]
    rng.shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    ranks = [1, 2, 50, 150, 250, 400, 504, 505]
    wanted = {"v": ordered.Wanted(F.col("v"), lambda _: ranks)}
    n, found = ordered.order_statistics(df, wanted)["v"]
    values.sort()
    assert n == 505 and [f.value for f in found] == [values[r - 1] for r in ranks]
    assert [f.below for f in found] == [values.index(f.value) for f in found]
    assert [f.ties for f in found] == [values.count(f.value) for f in found]

    big = [2**62 + i for i in range(100)]  # equal as doubles
    ids = spark.createDataFrame([(i,) for i in big], "i bigint")
    wanted = {"i": ordered.Wanted(F.col("i"), lambda _: [1, 60, 100])}
    assert [f.value for f in ordered.order_statistics(ids, wanted)["i"][1]] == [
        big[0], big[59], big[99]
    ]


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(1, "a", None)], SCHEMA)
    assert ordered.exact_quantiles(df, ["v"], [0.5]) == {"v": [None]}
    assert ordered.exact_quantiles(df.limit(0), ["v"], [0.5]) == {"v": [None]}


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.sampled_from([0.0, 0.25, 0.5, 1.0, -3.0]), min_size=1, max_size=60))
def test_cut_points_split_at_the_exact_rank(spark, values):
    rows = [(i, "a", v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, SCHEMA)
    wanted = sorted({max(1, len(values) // 3), max(1, len(values) // 2)})
    n, cuts = ordered.cut_points(df, {"v": F.col("v")}, F.col("id"), lambda _: wanted)["v"]
    assert n == len(values)
    for rank, cut in zip(wanted, cuts):
        before = df.filter(cut.reached_by(F.col("v"), F.col("id"))).select("id").collect()
        expected = sorted(range(len(values)), key=lambda i: (values[i], i))[:rank]
        assert {r["id"] for r in before} == set(expected)


@pytest.mark.parametrize("by", [[], ["g"]])
@pytest.mark.parametrize("pieces", [None, 3, 16])
def test_ranked_matches_sorting(spark, by, pieces):
    rows = _skewed(2000)
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    ranks = ordered.ranked(df, "v", "id", by=by, pieces=pieces)
    got = {r["id"]: r["rank"] for r in ranks.collect()}
    expected = {}
    for group in {g if by else None for _, g, _ in rows}:
        mine = [r for r in rows if r[2] is not None and (not by or r[1] == group)]
        for rank, row in enumerate(sorted(mine, key=lambda r: (-r[2], r[0])), 1):
            expected[row[0]] = rank
    assert got == {r[0]: expected.get(r[0]) for r in rows}


@pytest.mark.parametrize("pieces", [None, 9])
def test_running_maximum_and_sum(spark, pieces):
    rows = [(i, "a" if i % 3 else "b", float((i * 37) % 101)) for i in range(500)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = ordered.running(
        df, "id", {"best": ("max", F.col("v")), "total": ("sum", F.col("v"))}, by=["g"],
        pieces=pieces,
    ).collect()
    best, total = {}, {}
    expected = {}
    for i, g, v in rows:
        best[g] = max(best.get(g, v), v)
        total[g] = total.get(g, 0.0) + v
        expected[i] = (best[g], total[g])
    assert {r["id"]: (r["best"], r["total"]) for r in got} == expected


@pytest.mark.parametrize("shape", ["uniform", "heavy tail", "hot"])
def test_no_range_holds_much_more_than_its_share(spark, monkeypatch, shape):
    """Whatever the distribution, the windows stay small; a hot value is spread by its ties."""
    n, pieces = 20000, 16
    value = {
        "uniform": F.rand(1),
        "heavy tail": F.exp(F.randn(1) * 5),
        "hot": F.when(F.col("id") % 4 > 0, 0.5).otherwise(F.rand(1)),
    }[shape]
    df = spark.range(n).select("id", value.alias("v")).cache()
    sizes = []
    real = type(df).join

    def watch(self, other, *args, **kwargs):
        if "_tie_range" in self.columns:
            sizes.extend(r["count"] for r in self.groupBy("_range", "_tie_range").count().collect())
        return real(self, other, *args, **kwargs)

    monkeypatch.setattr(type(df), "join", watch)
    ranks = ordered.running(df, "v", {"n": ("sum", F.lit(1))}, tie="id", pieces=pieces)
    assert ranks.agg(F.countDistinct("n"), F.max("n")).first() == (n, n)
    assert max(sizes) <= 2 * n / pieces


@pytest.mark.parametrize("pieces", [None, 8])
def test_empty_input(spark, pieces):
    df = spark.createDataFrame([], SCHEMA)
    assert ordered.ranked(df, "v", "id", pieces=pieces).collect() == []
    missing = spark.createDataFrame([(1, "a", None), (2, "a", None)], SCHEMA)
    ranks = ordered.ranked(missing, "v", "id", pieces=pieces).collect()
    assert [r["rank"] for r in ranks] == [None, None]


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("pieces", [1, 3, 16])
def test_keys_that_are_equal_as_doubles(spark, descending, pieces):
    """Integers around 2^60, in any input order, with and without a tie column."""
    rows = [(2**60 + i, float((i * 7) % 13)) for i in range(40)]
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, "k bigint, v double").repartition(4)
    got = ordered.running(
        df, "k", {"best": ("max", F.col("v")), "n": ("sum", F.lit(1))}, descending=descending, pieces=pieces
    ).collect()
    best, expected = -1.0, {}
    for n, (k, v) in enumerate(sorted(rows, reverse=descending), 1):
        best = max(best, v)
        expected[k] = (best, n)
    assert {r["k"]: (r["best"], r["n"]) for r in got} == expected
    ties = df.withColumn("low", F.lit(2**60) + F.col("k") % 2)
    ranks = ordered.ranked(ties, "low", "k", descending=descending, pieces=pieces).collect()
    order = sorted(rows, key=lambda r: ((-1 if descending else 1) * (r[0] % 2), r[0]))
    assert [r["k"] for r in sorted(ranks, key=lambda r: r["rank"])] == [k for k, _ in order]
