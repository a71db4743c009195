"""Trees against plain Python: splits, random cuts, boosting rounds, and lines dealt out to tasks."""

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quarryline.models import tree_table
from quarryline.models import trees as tr
from quarryline.session import new_path


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(7)
    x = np.stack([rng.integers(0, 12, 600), rng.normal(size=600).round(2), rng.integers(0, 2, 600)], axis=1)
    y = (rng.random(600) < 1 / (1 + np.exp(-(x[:, 0] / 3 - 2 + x[:, 1])))).astype(float)
    z = x[:, 0] * 2 + x[:, 1] ** 2 + rng.normal(size=600) * 0.2
    return x, y, z


@pytest.fixture(scope="module")
def rows(spark, data):
    x, y, z = data
    lines = [(*map(float, x[i]), float(y[i]), float(z[i])) for i in range(len(x))]
    df = spark.createDataFrame(lines, "a double, b double, c double, y double, z double").repartition(4)
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df).cache()


def lines_of(x, y):
    """All values as bins of their own, and the folded lines."""
    values = [np.unique(x[:, i]) for i in range(x.shape[1])]
    bins = tr.Bins([(v[:-1] + v[1:]) / 2 for v in values], values, [True] * len(values))
    code = np.stack([np.searchsorted(v, x[:, i]) for i, v in enumerate(values)], axis=1).astype(np.uint16)
    found, where = np.unique(code, axis=0, return_inverse=True)
    where = where.reshape(-1)
    return tr.Lines(found.astype(np.int64), np.bincount(where).astype(float), np.bincount(where, y)), bins


def scored(model, rows):
    said = model.transform(rows)
    out = vector_to_array("probability")[1] if "probability" in said.columns else F.col("prediction")
    got = said.select(vector_to_array("features").alias("x"), out.alias("p")).collect()
    return {tuple(r["x"]): r["p"] for r in got}


def cart(x, y, score, depth, min_leaf):
    """The mean label of every row's leaf in a tree that tries every cut of every feature."""
    out = np.full(len(y), y.mean())
    if depth == 0:
        return out
    best = None
    for f in range(x.shape[1]):
        ends = np.unique(x[:, f])
        for cut in (ends[:-1] + ends[1:]) / 2:
            left = x[:, f] <= cut
            if min(left.sum(), (~left).sum()) < min_leaf:
                continue
            gain = score(y[left]) + score(y[~left]) - score(y)
            if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                best = gain, left
    if best:
        for side in (best[1], ~best[1]):
            out[side] = cart(x[side], y[side], score, depth - 1, min_leaf)
    return out


def gini(y):
    return (y.sum() ** 2 + (len(y) - y.sum()) ** 2) / len(y)


def entropy(y):
    p = y.mean()
    return len(y) * sum(q * math.log2(q) for q in (p, 1 - p) if q > 0)


def variance(y):
    return y.sum() ** 2 / len(y)


@pytest.mark.parametrize("criterion,score", [("gini", gini), ("entropy", entropy), ("variance", variance)])
def test_one_tree_on_all_rows_makes_the_best_cuts(rows, data, criterion, score):
    x, y, z = data
    of = z if criterion == "variance" else y
    settings = tr.Forest(1, criterion, max_depth=4, min_leaf=7, features=3, bootstrap=False)
    model = tr.fit_trees(rows, "z" if criterion == "variance" else "y", settings, max_bins=1000)
    got, want = scored(model, rows), cart(x, of, score, 4, 7)
    # equal gains may be cut differently, so the quality of the leaves is compared, and nearly all rows
    mine = np.array([got[tuple(r)] for r in x])
    assert np.isclose(((mine - of) ** 2).sum(), ((want - of) ** 2).sum(), rtol=0.02)
    assert np.isclose(mine, want).mean() > 0.9


def test_depth_has_no_limit():
    n = 90  # every cut but the last takes one row off
    x, y = np.arange(n, dtype=float)[:, None], 2.0 ** np.arange(n)
    lines, bins = lines_of(x, y)
    nodes = tr.grow_forest(lines, bins, tr.Forest(1, "variance", max_depth=88, features=1, bootstrap=False), [0])
    c = {k: np.concatenate(v) for k, v in nodes.columns.items()}
    depth = {0: 0}
    for i in range(len(c["id"])):
        for child in (c["left"][i], c["right"][i]):
            if child >= 0:
                depth[child] = depth[c["id"][i]] + 1
    assert max(depth.values()) > 40
    few = tr.grow_forest(lines, bins, tr.Forest(1, "variance", min_split=50, features=1, bootstrap=False), [0])
    assert len(np.concatenate(few.columns["id"])) < len(c["id"])


def test_random_cuts_differ_from_node_to_node(data):
    lines, bins = lines_of(data[0], data[1])
    settings = tr.Forest(40, "gini", features=2, random_cuts=True)
    nodes = tr.grow_forest(lines, bins, settings, list(range(40)))
    c = {k: np.concatenate(v) for k, v in nodes.columns.items()}
    cuts = c["threshold"][(c["left"] >= 0) & (c["feature"] == 1)]
    assert len(cuts) > 500 and len(np.unique(cuts)) > 0.99 * len(cuts)
    roots = c["threshold"][(c["id"] == 0) & (c["feature"] == 0)]
    assert len(np.unique(roots)) == len(roots) > 5


def test_bootstrap_and_features_follow_the_seed(data):
    lines, bins = lines_of(data[0], data[1])

    def grow(seed, trees):
        nodes = tr.grow_forest(lines, bins, tr.Forest(9, features=1, seed=seed), trees)
        c = {k: np.concatenate(v) for k, v in nodes.columns.items()}
        return sorted(zip(c["tree"].tolist(), c["id"].tolist(), c["w"].tolist(), c["threshold"].tolist()))

    together = grow(1, list(range(9)))
    assert together == sorted(sum((grow(1, [t]) for t in range(9)), []))  # wherever they grow
    assert together != grow(2, list(range(9)))
    weights = [w for _, i, w, _ in together if i == 0]
    assert len(set(weights)) > 3 and 500 < np.mean(weights) < 700


def rounds(x, y, n, step, l1, l2, min_hessian, logistic):
    """Boosting with one cut a round, by formula."""
    mean = y.mean()
    margin = np.full(len(y), math.log(mean / (1 - mean)) if logistic else mean)
    soft = lambda g: math.copysign(max(abs(g) - l1, 0), g)
    for _ in range(n):
        p = 1 / (1 + np.exp(-margin)) if logistic else margin
        g, h = p - y, p * (1 - p) if logistic else np.ones(len(y))
        best = None
        for f in range(x.shape[1]):
            ends = np.unique(x[:, f])
            for cut in (ends[:-1] + ends[1:]) / 2:
                left = x[:, f] <= cut
                parts = [(g[s].sum(), h[s].sum(), s) for s in (left, ~left)]
                if min(b for _, b, _ in parts) < min_hessian:
                    continue
                gain = sum(soft(a) ** 2 / (b + l2) for a, b, _ in parts)
                if best is None or gain > best[0] + 1e-9:
                    best = gain, parts
        for a, b, side in best[1]:
            margin[side] -= step * soft(a) / (b + l2)
    return 1 / (1 + np.exp(-margin)) if logistic else margin


@pytest.mark.parametrize("logistic", [True, False])
@pytest.mark.parametrize("l1,l2,min_hessian", [(0, 1, 1), (3, 0, 1), (0.5, 20, 40)])
def test_boosting_follows_the_formula(rows, data, logistic, l1, l2, min_hessian):
    x, y, z = data
    settings = tr.Boosting(3, logistic, 0.4, 1, l1=l1, l2=l2, min_hessian=min_hessian)
    got = scored(tr.fit_trees(rows, "y" if logistic else "z", settings, max_bins=1000), rows)
    want = rounds(x, y if logistic else z, 3, 0.4, l1, l2, min_hessian, logistic)
    assert [got[tuple(r)] for r in x] == pytest.approx(want, abs=1e-6)


def test_leaf_wise_trees_have_as_many_leaves_as_asked(data):
    lines, bins = lines_of(data[0], data[2])
    settings = tr.Boosting(4, False, leaves=9, max_depth=math.inf, l2=0.0)
    c = {k: np.concatenate(v) for k, v in tr.grow_boosted(lines, bins, settings).columns.items()}
    for t in range(1, 5):
        assert (c["left"][c["tree"] == t] < 0).sum() == 9
    # best first: the gains of the first splits are those of the best leaves at the time
    first = {i: (g, left) for t, i, g, left in zip(c["tree"], c["id"], c["gain"], c["left"]) if t == 1}
    split = sorted((left, i) for i, (g, left) in first.items() if left >= 0)
    open_ = {0}
    for left, i in split:
        assert first[i][0] == max(first[j][0] for j in open_ if first[j][1] >= 0)
        open_ = open_ - {i} | {left, left + 1}


def test_every_parameter_changes_the_result(data):
    lines, bins = lines_of(data[0], data[1])
    base = dict(rounds=3, max_depth=3)
    seen = set()
    for change in (
        {}, {"step": 0.1}, {"max_depth": 2}, {"min_hessian": 20}, {"subsample": 0.5}, {"by_tree": 0.4},
        {"by_level": 0.4}, {"l1": 2.0}, {"l2": 9.0}, {"leaves": 4}, {"min_rows": 60}, {"rounds": 4}, {"logistic": False},
    ):
        nodes = tr.grow_boosted(lines, bins, tr.Boosting(**base | change))
        seen.add(tuple(nodes.sums(data[0][:50]).round(9)))
    assert len(seen) == 13


@pytest.mark.parametrize(
    "settings",
    [tr.Forest(2, features=3, bootstrap=False, max_depth=2), tr.Forest(2, random_cuts=True, features=3, bootstrap=False, max_depth=2), tr.Boosting(2, max_depth=2)],
)
def test_lines_dealt_out_give_the_same_trees(rows, settings):
    """More lines than a task holds: the tasks of a barrier stage add up their sums."""
    together = scored(tr.fit_trees(rows, "y", settings), rows)
    dealt = scored(tr.fit_trees(rows, "y", settings, lines_per_task=150), rows)
    assert dealt == pytest.approx(together)


def test_scores_of_trials_equal_those_of_models(rows):
    trials = [(0, tr.Forest(9, features=1)), (3, tr.Boosting(5)), (4, tr.Forest(5, "entropy", random_cuts=True))]
    x = rows.select(vector_to_array("features").alias("x")).distinct()
    got = tr.score_trials(rows, "y", trials, x).collect()
    for trial_id, settings in trials:
        want = scored(tr.fit_trees(rows, "y", settings), rows)
        mine = {tuple(r["x"]): r["score"] for r in got if r["trial_id"] == trial_id}
        assert mine == pytest.approx(want)


def test_rows_to_score_do_not_pass_through_the_driver(spark, rows, monkeypatch):
    x = spark.range(3000).select(F.array(F.col("id") / 100, F.col("id") % 7 - 3.0, F.col("id") % 2 * 1.0).alias("x"))
    seen, fetch = [], type(x).toArrow

    def counted(df):
        table = fetch(df)
        seen.append(table.num_rows)
        return table

    monkeypatch.setattr(type(x), "toArrow", counted)
    assert tr.score_trials(rows, "y", [(0, tr.Forest(3))], x).count() == 3000
    assert all(n <= 600 for n in seen)  # lines of the train rows only


def test_many_values_are_cut_at_quantiles(spark):
    df = spark.range(5000).select(F.array((F.col("id") * 1.0), (F.col("id") % 3) * 1.0).alias("x"))
    bins = tr.find_bins(df, set(), 2, 64)
    assert 50 < len(bins.cuts[0]) < 64 and not bins.exact[0]
    assert bins.cuts[1].tolist() == [0.5, 1.5] and bins.values[1].tolist() == [0, 1, 2]


@pytest.mark.parametrize(
    "settings",
    [tr.Forest(7, features=2), tr.Forest(7, "entropy", features=2, random_cuts=True), tr.Forest(5, "variance", features=3), tr.Boosting(4)],
)
def test_a_table_of_trees_is_the_same_model(spark, rows, settings, monkeypatch):
    """Too many nodes for one process: scores, importances and the saved copy are those of MLlib's model."""
    label = "z" if getattr(settings, "criterion", "") == "variance" else "y"
    model = tr.fit_trees(rows, label, settings, max_bins=64)
    monkeypatch.setattr(tr, "NODES_ON_DRIVER", 0)
    monkeypatch.setattr(tree_table, "NODES_PER_TASK", 100)
    monkeypatch.setattr(tree_table, "CELLS_PER_TASK", 200)
    table = tr.fit_trees(rows, label, settings, max_bins=64)
    assert type(table) is tree_table.TreeTable and len(table.about["starts"]) > 1
    assert (table.getNumTrees, table.totalNumNodes) == (model.getNumTrees, model.totalNumNodes)
    assert table.featureImportances.toArray() == pytest.approx(model.featureImportances.toArray())
    # values between, beside and beyond those of the train rows, and some that are no numbers
    odd = [(a, b, c) for a in (-1e9, -0.0, 0.0, 3.5, 1e9, math.nan) for b in (-math.inf, 0.123, math.inf) for c in (0.0, 0.5, 1.0)]
    odd = spark.createDataFrame(odd, "a double, b double, c double")
    odd = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features", handleInvalid="keep").transform(odd)
    seen = rows.select("a", "b", "c", "features").unionByName(odd.repartition(2))
    PipelineModel([table]).write().save(place := new_path(spark, "saved"))
    out = "prediction" if label == "z" else "probability"
    value = (lambda df: df.select("a", "b", "c", (vector_to_array(out)[1] if label == "y" else F.col(out)).alias("p"), "prediction"))
    want = sorted(map(repr_of, value(model.transform(seen)).collect()))
    for same in (table, PipelineModel.load(place)):
        got = sorted(map(repr_of, value(same.transform(seen)).collect()))
        assert [g[0] for g in got] == [w[0] for w in want]
        assert [g[1:] for g in got] == [pytest.approx(w[1:]) for w in want]


def repr_of(row):
    return repr((row["a"] + 0.0, row["b"], row["c"])), row["p"], row["prediction"]


@pytest.mark.parametrize("settings", [tr.Boosting(3), tr.Boosting(3, leaves=6, subsample=0.5, by_level=0.7)])
def test_boosting_sums_feature_by_feature(settings, monkeypatch):
    """No array of a split is as long as lines times features, and the sums are those of all features at once."""
    draw = np.random.default_rng(5)
    bins = np.column_stack([draw.integers(0, 40, 300), draw.integers(0, 2, 300), draw.integers(0, 2, 300)])
    lines = tr.Lines(bins, np.ones(300), draw.integers(0, 2, 300).astype(float))
    cuts = [np.arange(1, 40) - 0.5, np.array([0.5]), np.array([0.5])]
    known = tr.Bins(cuts, [np.arange(len(c) + 1.0) for c in cuts], [True] * 3)
    asked, whole = [], tr.Lines.sums
    monkeypatch.setattr(tr.Lines, "sums", lambda self, keys, *rest: asked.append(len(keys)) or whole(self, keys, *rest))
    alone = [b.to_pylist() for b in tr.grow_boosted(lines, known, settings).packed()]
    assert asked and max(asked) <= 300
    together = tr.Lines(lines.bins, lines.n, lines.s, 0, lambda mine: [mine])
    assert [b.to_pylist() for b in tr.grow_boosted(together, known, settings).packed()] == alone


def test_lines_for_many_rows_fold_as_the_rows(spark):
    """A line that stands for several rows counts as often, for the bins and for the sums."""
    rows = spark.range(4000).select(
        F.array((F.col("id") % 700).cast("double"), (F.col("id") % 3).cast("double")).alias("x"), (F.col("id") % 2).cast("double").alias("y"))
    lines = rows.groupBy("x").agg(F.sum("y").alias("y"), F.count(F.lit(1)).alias("times"))
    bins, of_lines = tr.find_bins(rows, set(), 2, 64), tr.find_bins(lines, set(), 2, 64, "times")
    for one, other in ((bins.cuts, of_lines.cuts), (bins.values, of_lines.values)):
        assert all((a == b).all() for a, b in zip(one, other))
    got, want = (sorted(map(tuple, f.collect())) for f in (tr.fold(lines, "y", bins, "times"), tr.fold(rows, "y", bins)))
    assert got == want


@pytest.mark.parametrize(
    "settings",
    [tr.Forest(trees=6, features=2), tr.Forest(trees=6, features=3, criterion="entropy", min_leaf=4, bootstrap=False),
     tr.Forest(trees=6, features=1, random_cuts=True), tr.Forest(trees=6, features=4, random_cuts=True, min_leaf=3)],
)
def test_features_with_two_bins_are_not_summed_bin_by_bin(settings, data, monkeypatch):
    """A forest adds up what lies in their first bin, and grows the trees that sums of all bins give."""
    rng = np.random.default_rng(3)
    flags = rng.integers(0, 2, (600, 4)).astype(float)
    flags[:, 3] = flags[:, 2]  # equal gains: the first feature offered wins
    lines, bins = lines_of(np.concatenate([data[0][:, :2], flags], axis=1), data[1])
    shared = tr.Lines(lines.bins, lines.n, lines.s, gather=lambda mine: [mine])  # sums of all bins
    ours, theirs = (tr.grow_forest(some, bins, settings, list(range(6))).columns for some in (lines, shared))
    for name in theirs:
        assert np.array_equal(np.concatenate(ours[name]), np.concatenate(theirs[name]))

    summed, usual = [], tr.Lines.sums
    monkeypatch.setattr(tr.Lines, "sums", lambda self, keys, *rest: summed.append(len(keys)) or usual(self, keys, *rest))
    only_flags, bins = lines_of(flags, data[1])
    grown = tr.grow_forest(only_flags, bins, settings, [0])
    assert sum(map(len, grown.columns["id"])) > 1
    assert len(summed) == 1  # the root
