"""Decision trees grown level by level on folded rows.

A numeric feature is cut into bins, and rows with the same bins become one line with their number and the
sum of their labels: all that a split needs, however many rows there are. Tasks draw bootstrap
weights, random features and random thresholds from the seed, so trees do not depend on where they
grow. What is known of a node is a row of the model, not a place in a heap, so depth has no limit.

Up to ``LINES_PER_TASK`` lines, each task holds all of them and grows its own trees (boosting is one task
after another round by round). Beyond that the lines stay dealt out, and the tasks of a barrier
stage add up their sums per node, feature and bin before each split.

The result is written as one line per tree. A model of few nodes is read as MLlib's model: scoring, saving
and importances stay inside the JVM. One with more than ``NODES_ON_DRIVER`` stays a table (``tree_table``), so
that no process holds it whole.
"""

from __future__ import annotations

import base64
import functools
import heapq
import json
import math
import pickle
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.ml import classification as mlc
from pyspark.ml import regression as mlr
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.models.tree_table import PACKED, SCORING, TreeTable, leaf_values, packed, part_starts, sums_of_cells, unpacked, with_cells
from quarryline.session import new_path, remove

LINES_PER_TASK = 1 << 18
KEYS_PER_TASK = 1 << 21  # (tree, line, feature) places that one step looks at, about
MAX_BINS = 256
NODES_ON_DRIVER = 1 << 17  # of a model that MLlib holds; one with more stays a table
TINY = 1e-9  # a gain below this share of a node's score is rounding


# --- settings ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Forest:
    """``features`` is how many a node looks at; ``random_cuts`` draws one threshold for each of them."""

    trees: int = 500
    criterion: str = "gini"  # or entropy, variance
    max_depth: float = math.inf
    min_split: float = 2
    min_leaf: float = 1
    features: int = 1
    bootstrap: bool = True
    rate: float = 1.0  # rows drawn for a tree, as a share of all
    random_cuts: bool = False
    seed: int = 42


@dataclass(frozen=True)
class Boosting:
    """Second-order boosting: Newton leaves, L1 and L2 on them; by levels, or by leaves where ``leaves`` is set."""

    rounds: int = 500
    logistic: bool = True
    step: float = 0.3
    max_depth: float = 6
    leaves: int | None = None
    min_hessian: float = 1.0
    min_rows: float = 0.0
    subsample: float = 1.0
    by_tree: float = 1.0  # share of the features a tree may use
    by_level: float = 1.0
    l1: float = 0.0
    l2: float = 1.0
    seed: int = 42


# --- rows to lines -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Bins:
    """For each feature the upper ends of its bins but the last, and a value within each bin.

    ``exact`` says that a bin holds one value only.
    """

    cuts: list[np.ndarray]
    values: list[np.ndarray]
    exact: list[bool]


def find_bins(
    rows: DataFrame, indicators: set[int], width: int, max_bins: int = MAX_BINS, times: str | None = None
) -> Bins:
    """All cuts between neighbouring values, or cuts at quantiles where a feature has too many values.

    ``rows`` has the features as the array ``x``; ``indicators`` are known to be 0 or 1. With ``times`` a line stands
    for so many rows.
    """
    cuts, values = [np.array([0.5])] * width, [np.array([0.0, 1.0])] * width
    exact = [True] * width
    numeric = [i for i in range(width) if i not in indicators]
    if numeric:
        shares = [k / max_bins for k in range(1, max_bins)]
        parts = []
        for i in numeric:
            x = F.get("x", i)
            parts += [F.approx_count_distinct(x).alias(f"d{i}"), F.max(x).alias(f"m{i}")]
            parts += [F.percentile_approx(x, shares, 20_000).alias(f"q{i}")] if times is None else []
        found = rows.agg(*parts).first().asDict()
        few = [i for i in numeric if found[f"d{i}"] <= 2 * max_bins]  # so the sets stay small
        sets = rows.agg(*[F.collect_set(F.get("x", i)).alias(f"s{i}") for i in few]).first() if few else {}
        many = [i for i in numeric if i not in few or len(sets[f"s{i}"]) > max_bins]
        if times is not None and many:
            each = _each_row(rows, times, [F.get("x", i).alias(f"x{i}") for i in many])
            found |= each.agg(*[F.percentile_approx(f"x{i}", shares, 20_000).alias(f"q{i}") for i in many]).first().asDict()
        for i in numeric:
            known = np.array(sorted(sets[f"s{i}"])) if i in few else None
            if known is not None and len(known) <= max_bins:
                cuts[i], values[i] = (known[:-1] + known[1:]) / 2, known
            else:
                ends = np.unique(np.array(found[f"q{i}"] or [], float))
                top = found[f"m{i}"]
                ends = ends[ends < top] if top is not None else ends
                cuts[i], exact[i] = ends, False
                values[i] = np.append(ends, 0.0 if top is None else top)
    return Bins(cuts, values, exact)


def _each_row(lines: DataFrame, times: str, columns: list) -> DataFrame:
    """The columns of a line as often as it has rows, dealt out by blocks of them."""
    parts = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows, block = F.col(times).cast("long"), 1 << 16
    blocks = lines.filter(rows > 0).select(
        *columns, rows.alias("_rows"), F.explode(F.sequence(F.lit(0), F.floor((rows - 1) / block).cast("int"))).alias("_block")
    )
    here = F.least(F.lit(block), F.col("_rows") - F.col("_block").cast("long") * block).cast("int")
    dealt = blocks.withColumn("_here", here).repartition(parts)
    return dealt.withColumn("_row", F.explode(F.sequence(F.lit(1), F.col("_here")))).drop("_rows", "_block", "_here", "_row")


def fold(rows: DataFrame, label: str, bins: Bins, times: str | None = None) -> DataFrame:
    """(bins, n, s): rows with the same bins as one line, with the sum of their labels. With ``times`` a line
    already stands for so many rows, and its label is the sum of theirs."""
    cuts = bins.cuts
    schema = pa.schema([("bins", pa.binary()), ("n", pa.float64()), ("s", pa.float64())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(cuts))
            y, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "n"))
            code = np.empty(x.shape, np.uint16)
            for i, ends in enumerate(cuts):
                code[:, i] = np.searchsorted(ends, x[:, i], side="left")
            found, where = np.unique(code, axis=0, return_inverse=True)
            where = where.reshape(-1)
            lines = [pa.array([line.tobytes() for line in found], pa.binary())]
            lines += [pa.array(np.bincount(where, n)), pa.array(np.bincount(where, y))]
            yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(lines, schema)], schema=schema)

    many = F.lit(1.0) if times is None else F.col(times).cast("double")
    part = rows.select("x", F.col(label).cast("double").alias("y"), many.alias("n")).mapInArrow(place, "bins binary, n double, s double")
    return part.groupBy("bins").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))


@dataclass
class Lines:
    """A task's share of the lines. ``gather`` exchanges objects with the tasks that hold the others."""

    bins: np.ndarray
    n: np.ndarray
    s: np.ndarray
    share: int = 0
    gather: Callable[[object], list] | None = None

    @staticmethod
    def of(table: pa.Table, width: int, share: int = 0, gather=None) -> Lines:
        """Lines in the order of their bins, wherever they were folded."""
        data = b"".join(table.column("bins").to_pylist())
        bins = np.frombuffer(data, np.uint16).reshape(table.num_rows, width).astype(np.int64)
        order = np.lexsort(bins.T[::-1]) if len(bins) else np.arange(0)
        n, s = (table.column(c).to_numpy()[order] for c in ("n", "s"))
        return Lines(bins[order], n, s, share, gather)

    @functools.cached_property
    def codes(self) -> np.ndarray:
        """The bins in few bytes."""
        return np.ascontiguousarray(self.bins, np.uint16)

    @functools.cached_property
    def columns(self) -> np.ndarray:
        """The bins feature by feature."""
        return np.ascontiguousarray(self.bins.T)

    def sums(self, keys: np.ndarray, size: int, *weights: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The different keys below ``size`` in order, and the sums of the weights of each, over all tasks."""
        found, out = _sums(keys, size, weights)
        if self.gather is None:
            return found, out
        parts = self.gather((found, out))
        together = [np.concatenate([p[1][i] for p in parts]) for i in range(len(weights))]
        return _sums(np.concatenate([p[0] for p in parts]), size, together)

    def extremes(self, keys: np.ndarray, size: int, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The smallest and largest value of each key below ``size``, over all tasks."""
        low, high = np.full(size, 1 << 20, np.int64), np.full(size, -1, np.int64)
        np.minimum.at(low, keys, values)
        np.maximum.at(high, keys, values)
        if self.gather is None:
            return low, high
        parts = self.gather((low, high))
        return np.min([p[0] for p in parts], axis=0), np.max([p[1] for p in parts], axis=0)

    def generator(self, seed: int, tree: int) -> np.random.Generator:
        return np.random.Generator(np.random.Philox(key=[seed & 0xFFFFFFFF, tree << 20 | self.share]))


def _sums(keys: np.ndarray, size: int, weights) -> tuple[np.ndarray, list[np.ndarray]]:
    if size <= 4 * len(keys) + 1024:
        found = np.flatnonzero(np.bincount(keys, minlength=size))
        return found, [np.bincount(keys, w, size)[found] for w in weights]
    found, place = np.unique(keys, return_inverse=True)
    return found, [np.bincount(place, w, len(found)) for w in weights]


def _uniform(seed: int, *parts: np.ndarray) -> np.ndarray:
    """Numbers in [0, 1) from a seed and whole numbers (the finaliser of splitmix64, whose constants are fixed)."""
    value = np.uint64(seed & 0xFFFFFFFF)
    with np.errstate(over="ignore"):
        for part in parts:
            value = (value ^ np.asarray(part).astype(np.uint64)) + np.uint64(0x9E3779B97F4A7C15)
            value = (value ^ (value >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            value = (value ^ (value >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            value = value ^ (value >> np.uint64(31))
    return (value >> np.uint64(11)).astype(np.float64) / float(1 << 53)


# --- the best split of each node ---------------------------------------------------------------


@dataclass
class Splits:
    """One entry per node; ``gain`` is -inf where no split is allowed. ``left`` has the sums on the left, ``place`` is
    that of the feature in the offer."""

    gain: np.ndarray
    feature: np.ndarray
    bin: np.ndarray
    threshold: np.ndarray
    place: np.ndarray
    left: list[np.ndarray]

    @staticmethod
    def none(nodes: int, sums: int) -> Splits:
        return Splits(
            np.full(nodes, -np.inf), np.full(nodes, -1), np.full(nodes, -1), np.zeros(nodes), np.full(nodes, 1 << 20),
            [np.zeros(nodes) for _ in range(sums)],
        )

    def put(self, where: np.ndarray, other: Splits, at: np.ndarray | slice = slice(None)) -> None:
        """The entries of the other at its nodes ``at`` take the place of those at the nodes ``where``."""
        for name in ("gain", "feature", "bin", "threshold", "place"):
            getattr(self, name)[where] = getattr(other, name)[at]
        for mine, theirs in zip(self.left, other.left):
            mine[where] = theirs[at]


def _sums_by_feature(
    lines: Lines, node: np.ndarray, line: np.ndarray, weights: list[np.ndarray], features: np.ndarray, sizes: np.ndarray, nodes: int
) -> tuple[np.ndarray, list[np.ndarray]]:
    """The places (node, feature, bin) that are taken and the sums of the weights at each, as ``Lines.sums`` finds
    them: feature by feature, so that no array is as long as lines times features."""
    tables: list[list[np.ndarray]] = [[] for _ in range(1 + len(weights))]
    for f, size in zip(features, sizes):
        keys = node * size + lines.columns[f][line]
        for table, w in zip(tables, (None, *weights)):
            table.append(np.bincount(keys, w, nodes * size).reshape(nodes, size))
    held, *sums = [np.concatenate(table, axis=1).ravel() for table in tables]
    found = np.flatnonzero(held)
    return found, [s[found] for s in sums]


def _best_of_pairs(
    lines: Lines, bins: Bins, node: np.ndarray, line: np.ndarray, weights: list[np.ndarray], totals: list[np.ndarray],
    offered: np.ndarray, pairs: np.ndarray, score: Callable, allowed: Callable, draw: np.ndarray | None, in_order: bool,
) -> Splits:
    """``_best`` among the features with two bins, those at the ``pairs`` of the offer: what lies in the first bin is all
    that is added up."""
    nodes, many = offered.shape
    best = Splits.none(nodes, len(weights))
    left = [np.zeros((nodes, many)) for _ in weights]
    first = line * lines.codes.shape[1]
    for place in np.flatnonzero(pairs.any(axis=0)):
        code = lines.codes.ravel().take(first + offered[:, place].take(node))
        below = np.flatnonzero((code == 0) & pairs[:, place].take(node))
        of = node[below]
        for sums, w in zip(left, weights):
            sums[:, place] = np.bincount(of, w[below], nodes)
    whole = [t[:, None] for t in totals]
    right = [t - a for t, a in zip(whole, left)]
    gain = score(left) + score(right) - score(whole)
    fits = pairs & allowed(left) & allowed(right) & (gain > TINY * np.abs(score(whole)) + 1e-12)
    place = np.argmax(fits if in_order else np.where(fits, gain, -np.inf), axis=1)
    chosen = np.flatnonzero(fits.any(axis=1))
    place = place[chosen]
    best.gain[chosen], best.bin[chosen], best.place[chosen] = gain[chosen, place], 0, place
    best.feature[chosen] = feature = offered[chosen, place]
    cut = np.array([c[0] if len(c) else 0.0 for c in bins.cuts])[feature]
    if draw is not None:
        low, high = (np.array([v[k] if len(v) == 2 else 0.0 for v in bins.values])[feature] for k in (0, 1))
        cut = np.where(np.array(bins.exact)[feature], low + draw[chosen, place] * (high - low), cut)
    best.threshold[chosen] = cut
    for out, sums in zip(best.left, left):
        out[chosen] = sums[chosen, place]
    return best


def _best(
    lines: Lines, bins: Bins, node: np.ndarray, line: np.ndarray, weights: list[np.ndarray],
    totals: list[np.ndarray], offered: np.ndarray, score: Callable, allowed: Callable, draw: np.ndarray | None, in_order: bool = False, alike: bool = False,
    pairs: np.ndarray | None = None,
) -> Splits:
    """The best cut of each node among the features ``offered`` to it (nodes x features).

    ``node`` and ``line`` pair nodes with lines, ``weights`` are summed. With ``draw`` (uniform, like
    ``offered``) each feature has one cut, drawn between its ends within the node. ``in_order`` takes the
    first feature offered that can be cut; ``alike`` says that all nodes are offered the same. Features at the
    ``pairs`` of the offer are left out.
    """
    nodes, many = offered.shape
    best = Splits.none(nodes, len(weights))
    # Each feature of a node has as many places as bins: an indicator two, not as many as the widest.
    sizes = np.array([len(c) + 1 for c in bins.cuts])[offered.ravel()]
    if pairs is not None:
        sizes[pairs.ravel()] = 0
    one_by_one = alike and draw is None and lines.gather is None and sizes.sum() <= 4 * len(line) * many + 1024
    if one_by_one:
        cell, code, repeated = None, None, []
    elif pairs is None:
        cell = node[:, None] * many + np.arange(many)
        code = lines.bins[line[:, None], offered[node]]
        repeated = [np.repeat(w, many) for w in weights]
    else:
        held = [np.flatnonzero(~pairs[:, place].take(node)) for place in range(many)]
        rows, place = np.concatenate(held), np.repeat(np.arange(many), [len(r) for r in held])
        cell = node[rows] * many + place
        code = lines.bins[line[rows], offered.ravel()[cell]]
        repeated = [w[rows] for w in weights]
        if not len(rows):
            return best
    if draw is None:
        begins = np.cumsum(sizes) - sizes
        if one_by_one:
            keys, sums = _sums_by_feature(lines, node, line, weights, offered[0], sizes[:many], nodes)
        else:
            keys, sums = lines.sums((begins[cell] + code).ravel(), int(sizes.sum()), *repeated)
        if not len(keys):
            return best
        cells = np.repeat(np.arange(nodes * many), sizes)[keys]
        at = keys - begins[cells]
        starts = np.flatnonzero(np.diff(cells, prepend=-1))
        reps = np.diff(np.append(starts, len(cells)))
        left = []
        for s in sums:
            run = np.cumsum(s)
            left.append(run - np.repeat(run[starts] - s[starts], reps))
        last = np.zeros(len(cells), bool)
        last[np.append(starts[1:], len(cells)) - 1] = True
        threshold = None
    else:
        low, high = lines.extremes(cell.ravel(), nodes * many, code.ravel())
        feature = offered.ravel()
        at, threshold = np.zeros(nodes * many, np.int64), np.zeros(nodes * many)
        for f in np.unique(feature):
            mine = np.flatnonzero((feature == f) & (high > low))
            first, end = bins.values[f][low[mine]], bins.values[f][high[mine]]
            cut = first + draw.ravel()[mine] * (end - first)
            at[mine] = np.clip(np.searchsorted(bins.values[f], cut, side="right") - 1, low[mine], high[mine] - 1)
            threshold[mine] = cut if bins.exact[f] else bins.cuts[f][at[mine]]
        below = (code <= at[cell]).ravel()
        keys, found = lines.sums(cell.ravel()[below], nodes * many, *[w[below] for w in repeated])
        cells, at, threshold = keys, at[keys], threshold[keys]
        left, last = found, ~(high > low)[keys]
    of = cells // many
    whole = [t[of] for t in totals]
    right = [t - a for t, a in zip(whole, left)]
    gain = score(left) + score(right) - score(whole)
    fits = allowed(left) & allowed(right) & ~last & (gain > TINY * np.abs(score(whole)) + 1e-12)
    if not fits.any():
        return best
    if in_order:
        earliest = np.full(nodes, nodes * many)
        np.minimum.at(earliest, of[fits], cells[fits])
        fits &= cells == earliest[of]
    gain = np.where(fits, gain, -np.inf)
    first = np.flatnonzero(np.diff(of, prepend=-1))
    top = np.maximum.reduceat(gain, first)
    is_top = np.flatnonzero((gain == np.repeat(top, np.diff(np.append(first, len(of))))) & fits)
    chosen, which = np.unique(of[is_top], return_index=True)
    where = is_top[which]  # of equal gains the first feature offered, then the lowest cut
    best.gain[chosen], best.bin[chosen] = gain[where], at[where]
    best.place[chosen] = cells[where] % many
    best.feature[chosen] = offered[chosen, best.place[chosen]]
    if threshold is None:
        best.threshold[chosen] = [bins.cuts[f][b] for f, b in zip(best.feature[chosen], at[where])]
    else:
        best.threshold[chosen] = threshold[where]
    for out, sums in zip(best.left, left):
        out[chosen] = sums[where]
    return best


# --- forests -----------------------------------------------------------------------------------


def _impurity_score(criterion: str) -> Callable[[list[np.ndarray]], np.ndarray]:
    """A node's weight times its purity, up to a constant: the more the better."""

    def by_log(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
        return part * np.log2(np.where(part > 0, part / np.where(whole > 0, whole, 1), 1))

    def score(sums: list[np.ndarray]) -> np.ndarray:
        w, v = sums
        if criterion == "entropy":
            return by_log(np.maximum(v, 0), w) + by_log(np.maximum(w - v, 0), w)
        square = v * v + (w - v) ** 2 if criterion == "gini" else v * v
        return square / np.where(w > 0, w, 1)

    return score


class Nodes:
    """The nodes of some trees, numbered from 0 within each, parents before their children."""

    def __init__(self, classify: bool, criterion: str):
        self.classify, self.criterion = classify, criterion
        self.columns: dict[str, list] = {
            c: [] for c in ("tree", "id", "w", "v", "gain", "left", "right", "feature", "threshold", "value")
        }

    def add(self, **columns) -> None:
        for name, values in columns.items():
            self.columns[name].append(np.asarray(values))

    def sums(self, x: np.ndarray) -> np.ndarray:
        """For each row of features the sum over the trees of what their leaves say."""
        across, out = np.ascontiguousarray(x.T, dtype=float), np.zeros(len(x))
        for batch in self.packed():
            line = batch.to_pylist()[0]
            out += leaf_values(across, *[unpacked(line, c) for c in ("feature", "threshold", "below", "says")])
        return out

    def packed(self, trial_id: int = 0) -> Iterator[pa.RecordBatch]:
        """The nodes as one line per tree."""
        if self.columns["tree"]:
            columns = {k: np.concatenate(v) for k, v in self.columns.items()}
            yield from packed(columns, self.classify, trial_id)

    def add_packed(self, line: dict) -> None:
        """The nodes of a line that ``packed`` made."""
        n, left = line["n_nodes"], unpacked(line, "below")
        self.add(
            tree=np.full(n, line["tree"]), id=np.arange(n), left=left, right=np.where(left >= 0, left + 1, -1),
            **{c: unpacked(line, c) for c in ("w", "v", "gain", "feature", "threshold", "value")},
        )

    def batches(self) -> Iterator[pa.RecordBatch]:
        """The nodes as MLlib writes them."""
        if not self.columns["tree"]:
            return
        c = {k: np.concatenate(v) for k, v in self.columns.items()}
        w = np.maximum(c["w"], 0)
        share = np.where(w > 0, c["v"] / np.where(w > 0, w, 1), 0)
        impurity = np.zeros(len(w))
        if self.criterion == "gini":
            impurity = 2 * share * (1 - share)
        elif self.criterion == "entropy":
            impurity = -sum(np.where(p > 0, p * np.log2(np.where(p > 0, p, 1)), 0) for p in (share, 1 - share))
        stats = np.stack([w - c["v"], c["v"]] if self.classify else [w, c["v"], np.zeros(len(w))], axis=1)
        inner = c["left"] >= 0
        cut = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(inner)]), pa.int32()), pa.array(c["threshold"][inner], pa.float64())
        )
        split = pa.StructArray.from_arrays(
            [pa.array(np.where(inner, c["feature"], -1), pa.int32()), cut, pa.array(np.full(len(w), -1), pa.int32())],
            ["featureIndex", "leftCategoriesOrThreshold", "numCategories"],
        )
        size = stats.shape[1]
        listed = pa.ListArray.from_arrays(
            pa.array(np.arange(len(w) + 1) * size, pa.int32()), pa.array(stats.ravel(), pa.float64())
        )
        value = (share > 0.5).astype(float) if self.classify else c["value"]
        gain = np.where(inner, c["gain"] / np.where(w > 0, w, 1), -1.0)
        node = pa.StructArray.from_arrays(
            [pa.array(c["id"], pa.int32()), pa.array(value, pa.float64()), pa.array(impurity), listed,
             pa.array(w.astype(np.int64)), pa.array(gain), pa.array(c["left"], pa.int32()),
             pa.array(c["right"], pa.int32()), split],
            ["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "split"],
        )
        table = pa.table([pa.array(c["tree"], pa.int32()), node], names=["treeID", "nodeData"])
        yield from table.to_batches(max_chunksize=50_000)


NODES = (
    "treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, "
    "rawCount: bigint, gain: double, leftChild: int, rightChild: int, split: struct<featureIndex: int, "
    "leftCategoriesOrThreshold: array<double>, numCategories: int>>"
)


def grow_forest(lines: Lines, bins: Bins, settings: Forest, trees: list[int]) -> Nodes:
    """Some trees of a forest, all of them level by level at once."""
    classify = settings.criterion != "variance"
    score = _impurity_score(settings.criterion)
    width, many = len(bins.cuts), min(settings.features, len(bins.cuts))
    drawn = [_bootstrap(lines, settings, classify, t) for t in trees]
    line = np.concatenate([np.flatnonzero(w > 0) for w, _ in drawn])
    node = np.concatenate([np.full(np.count_nonzero(w > 0), i) for i, (w, _) in enumerate(drawn)])
    w, v = (np.concatenate([d[i][d[0] > 0] for d in drawn]) for i in (0, 1))
    found, sums = lines.sums(node, len(trees), w, v)
    totals = [np.zeros(len(trees)) for _ in sums]
    for total, s in zip(totals, sums):
        total[found] = s
    tree = np.array(trees)
    number, used = np.zeros(len(trees), np.int64), np.ones(len(trees), np.int64)  # ids and how many are taken
    slot = np.arange(len(trees))
    # Features with two bins have one cut. Counts of labels are the same however they are added up; the shares of a
    # barrier stage add up everything in one exchange.
    two = np.array([len(c) == 1 for c in bins.cuts]) if classify and lines.gather is None else np.zeros(width, bool)
    out, depth = Nodes(classify, settings.criterion), 0

    def allowed(part: list[np.ndarray]) -> np.ndarray:
        return part[0] >= settings.min_leaf

    while len(tree):
        open_ = totals[0] >= max(settings.min_split, 2 * settings.min_leaf)
        open_ &= depth < settings.max_depth
        if classify:
            open_ &= (totals[1] > 0) & (totals[1] < totals[0])
        ids = np.arange(width)
        order = np.argsort(_uniform(settings.seed, tree[:, None], number[:, None], ids), axis=1, kind="stable")
        best = Splits.none(len(tree), 2)
        # As many features as asked for, in a random order; where none can be cut, the first other one that can.
        for at, end in ((0, many), (many, width)):
            ask = np.flatnonzero(open_ & ~np.isfinite(best.gain))
            if not len(ask) or at == end:
                break
            new = np.full(len(tree), -1)
            new[ask] = np.arange(len(ask))
            mine = new[node] >= 0
            offered = order[ask, at:end]
            draw = None
            if settings.random_cuts:
                draw = _uniform(settings.seed + 1, tree[ask, None], number[ask, None], offered)
            pairs = two[offered]
            asked = lines, bins, new[node][mine], line[mine], [w[mine], v[mine]], [t[ask] for t in totals], offered
            got = _best(*asked, score, allowed, draw, in_order=at > 0, pairs=pairs if pairs.any() else None)
            if pairs.any():
                other = _best_of_pairs(*asked, pairs, score, allowed, draw, in_order=at > 0)
                earlier = other.place < got.place
                better = earlier if at > 0 else (other.gain > got.gain) | ((other.gain == got.gain) & earlier)
                got.put(better, other, better)
            best.put(ask, got)
        split = np.isfinite(best.gain)
        # children are numbered after all nodes of their tree so far
        nth = np.cumsum(split) - split
        begin = np.zeros(len(trees), np.int64)
        counts = np.bincount(slot[split], minlength=len(trees))
        begin[1:] = np.cumsum(counts)[:-1]
        left = np.where(split, used[slot] + 2 * (nth - begin[slot]), -1)
        used += 2 * counts
        value = np.where(totals[0] > 0, totals[1] / np.where(totals[0] > 0, totals[0], 1), 0)
        out.add(
            tree=tree, id=number, w=totals[0], v=totals[1], gain=np.where(split, best.gain, 0), left=left,
            right=np.where(split, left + 1, -1), feature=best.feature, threshold=best.threshold, value=value,
        )
        keep = split[node]
        node, line, w, v = node[keep], line[keep], w[keep], v[keep]
        goes_right = lines.codes.ravel().take(line * width + best.feature.take(node)) > best.bin.take(node)
        node = 2 * nth.take(node) + goes_right
        totals = [
            np.stack([a[split], t[split] - a[split]], axis=1).ravel() for a, t in zip(best.left, totals)
        ]
        number = np.stack([left[split], left[split] + 1], axis=1).ravel()
        tree, slot = np.repeat(tree[split], 2), np.repeat(slot[split], 2)
        depth += 1
    return out


def _bootstrap(lines: Lines, settings: Forest, classify: bool, tree: int) -> tuple[np.ndarray, np.ndarray]:
    """Weight and label sum of each line in a tree: Poisson counts of its rows."""
    if not settings.bootstrap:
        return lines.n, lines.s
    draw = lines.generator(settings.seed, tree)
    if classify:
        ones = draw.poisson(settings.rate * lines.s).astype(float)
        return ones + draw.poisson(settings.rate * np.maximum(lines.n - lines.s, 0)), ones
    w = draw.poisson(settings.rate * lines.n).astype(float)
    return w, w * lines.s / lines.n


# --- boosting ----------------------------------------------------------------------------------


def grow_boosted(lines: Lines, bins: Bins, settings: Boosting) -> Nodes:
    """A start value as a tree of one node, then a tree for each round."""
    _, (n, s) = lines.sums(np.zeros(len(lines.n), np.int64), 1, lines.n, lines.s)
    n, s = (float(a[0]) if len(a) else 0.0 for a in (n, s))
    mean = s / n if n else 0.0
    if settings.logistic:
        mean = min(max(mean, 1e-6), 1 - 1e-6)
    start = math.log(mean / (1 - mean)) if settings.logistic else mean
    half = 0.5 if settings.logistic else 1.0  # MLlib doubles the margin of a classifier
    out = Nodes(False, "variance")
    none = {"gain": [0.0], "left": [-1], "right": [-1], "feature": [-1], "threshold": [0.0]}
    out.add(tree=[0], id=[0], w=[n], v=[s], value=[start * half], **none)
    margin = np.full(len(lines.n), start)
    for r in range(settings.rounds):
        margin += _grow_round(lines, bins, settings, r, margin, half, out)
    return out


def _soft(g: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0) if l1 else g


def _subset(seed: int, share: float, of: np.ndarray, *parts: int) -> np.ndarray:
    """A random part of the features, at least one."""
    if share >= 1:
        return of
    many = max(1, int(share * len(of)))
    draws = _uniform(seed, *[np.full(len(of), p) for p in parts], of)
    return np.sort(of[np.argsort(draws, kind="stable")[:many]])


def _derivatives(lines: Lines, settings: Boosting, margin: np.ndarray, r: int) -> tuple[np.ndarray, ...]:
    """Gradient, hessian and number of rows of each line, of all rows or of a random part."""
    n, s = lines.n, lines.s
    if settings.subsample < 1:
        draw = lines.generator(settings.seed + 2, r)
        if settings.logistic:
            ones = draw.binomial(np.round(lines.s).astype(np.int64), settings.subsample)
            s = ones.astype(float)
            n = s + draw.binomial(np.round(lines.n - lines.s).astype(np.int64), settings.subsample)
        else:
            n = draw.binomial(lines.n.astype(np.int64), settings.subsample).astype(float)
            s = n * lines.s / lines.n
    if settings.logistic:
        p = 1 / (1 + np.exp(-margin))
        return n * p - s, np.maximum(n * p * (1 - p), 1e-16 * n), n
    return n * margin - s, n, n


def _grow_round(
    lines: Lines, bins: Bins, settings: Boosting, r: int, margin: np.ndarray, half: float, out: Nodes
) -> np.ndarray:
    """Add the tree of a round to ``out``; returns what it adds to the margin of each line."""
    g, h, n = _derivatives(lines, settings, margin, r)
    weights = [h, g, n]
    l1, l2 = settings.l1, settings.l2
    columns = _subset(settings.seed + 3, settings.by_tree, np.arange(len(bins.cuts)), r)

    def score(part: list[np.ndarray]) -> np.ndarray:
        below = part[0] + l2
        return np.where(below > 0, _soft(part[1], l1) ** 2 / np.where(below > 0, below, 1), 0)

    def allowed(part: list[np.ndarray]) -> np.ndarray:
        return (part[0] >= settings.min_hessian) & (part[2] >= max(settings.min_rows, TINY))

    def leaf(part) -> float:
        below = part[0] + l2
        return float(-settings.step * _soft(np.float64(part[1]), l1) / below) if below > 0 else 0.0

    def look(parts: list[tuple[int, np.ndarray, list[float]]], depth: int) -> Splits:
        """The best split of each (id, lines, sums)."""
        some = _subset(settings.seed + 4, settings.by_level, columns, r, depth)
        node = np.concatenate([np.full(len(where), i) for i, (_, where, _) in enumerate(parts)])
        line = np.concatenate([where for _, where, _ in parts])
        totals = [np.array([sums[k] for _, _, sums in parts]) for k in range(3)]
        offered = np.broadcast_to(some, (len(parts), len(some)))
        return _best(lines, bins, node, line, [a[line] for a in weights], totals, offered, score, allowed, None, alike=True)

    everything = np.arange(len(lines.n))
    _, whole = lines.sums(np.zeros(len(everything), np.int64), 1, *weights)
    root = (0, everything, [float(a[0]) if len(a) else 0.0 for a in whole])
    added = np.zeros(len(everything))
    nodes: dict[int, tuple] = {}

    def divide(part, best: Splits, i: int) -> list[tuple]:
        """The children of a node, and the node itself written down."""
        number, where, sums = part
        left = len(nodes)
        nodes[left] = nodes[left + 1] = None
        nodes[number] = (sums, best.gain[i], left, int(best.feature[i]), float(best.threshold[i]))
        goes_left = lines.bins[where, best.feature[i]] <= best.bin[i]
        one = [float(a[i]) for a in best.left]
        other = [a - b for a, b in zip(sums, one)]
        return [(left, where[goes_left], one), (left + 1, where[~goes_left], other)]

    def close(part) -> None:
        number, where, sums = part
        nodes[number] = (sums, 0.0, -1, -1, 0.0)
        added[where] = leaf(sums)

    nodes[0] = None
    if settings.leaves is None:
        level, depth = [root], 0
        while level:
            if depth >= settings.max_depth:
                for part in level:
                    close(part)
                break
            best, below = look(level, depth), []
            for i, part in enumerate(level):
                if np.isfinite(best.gain[i]):
                    below += divide(part, best, i)
                else:
                    close(part)
            level, depth = below, depth + 1
    else:
        queue: list[tuple] = []  # (-gain, id, part, splits, place): the best leaf first

        def offer(parts: list[tuple]) -> None:
            best = look(parts, 0)
            for i, part in enumerate(parts):
                if np.isfinite(best.gain[i]):
                    heapq.heappush(queue, (-best.gain[i], part[0], part, best, i))
                else:
                    close(part)

        offer([root])
        many = 1
        while queue and many < settings.leaves:
            _, _, part, best, i = heapq.heappop(queue)
            offer(divide(part, best, i))
            many += 1
        for _, _, part, _, _ in queue:
            close(part)
    order = range(len(nodes))
    left = np.array([nodes[i][2] for i in order])
    out.add(
        tree=np.full(len(nodes), r + 1), id=np.arange(len(nodes)), w=[nodes[i][0][0] for i in order],
        v=[nodes[i][0][1] for i in order], gain=[nodes[i][1] for i in order], left=left,
        right=np.where(left >= 0, left + 1, -1), feature=[nodes[i][3] for i in order],
        threshold=[nodes[i][4] for i in order], value=[leaf(nodes[i][0]) * half for i in order],
    )
    return added


# --- fitting on Spark --------------------------------------------------------------------------


def _exchange(context: BarrierTaskContext) -> Callable[[object], list]:
    def gather(mine: object) -> list:
        sent = context.allGather(base64.b64encode(pickle.dumps(mine)).decode())
        return [pickle.loads(base64.b64decode(part)) for part in sent]

    return gather


@dataclass
class Prepared:
    """Train rows as lines, ready for any number of fits."""

    bins: Bins
    lines: DataFrame
    n_lines: int
    path: str

    @property
    def width(self) -> int:
        return len(self.bins.cuts)


def width_of(rows: DataFrame, features: str = "features") -> int:
    about = rows.schema[features].metadata.get("ml_attr", {})
    width = about.get("num_attrs") or sum(len(a) for a in about.get("attrs", {}).values())
    return width or len(rows.select(features).first()[0])


def prepare(
    train: DataFrame, label: str, max_bins: int = MAX_BINS, features: str = "features", times: str | None = None
) -> Prepared:
    """With ``times`` a line stands for so many rows, and its label is the sum of theirs."""
    spark = train.sparkSession
    about = train.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    indicators = {a["idx"] for a in about.get("binary", [])}
    held = [] if times is None else [times]
    rows = train.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias(label), *held)
    width = width_of(train, features)
    bins = find_bins(rows, indicators, width, max_bins, times)
    path = new_path(spark, "lines")
    fold(rows, label, bins, times).write.parquet(path)
    lines = spark.read.parquet(path)
    return Prepared(bins, lines, lines.count(), path)


def fit_trees(
    train: DataFrame, label: str, settings: Forest | Boosting, max_bins: int = MAX_BINS,
    lines_per_task: int = LINES_PER_TASK,
):
    """A fitted model of the trees of the settings: MLlib's, or a table of trees where the nodes are many."""
    spark = train.sparkSession
    ready = prepare(train, label, max_bins)
    path = new_path(spark, "model")
    groups = _groups(ready, settings, lines_per_task)
    if ready.n_lines <= lines_per_task:
        _grow_apart(spark, ready, [(0, settings, group) for group in groups]).write.parquet(f"{path}/trees")
    else:
        tasks = -(-ready.n_lines // lines_per_task)
        for group in groups:
            dealt = ready.lines.repartition(tasks, "bins")
            grown = dealt.mapInArrow(_together(ready.bins, ready.width, settings, group), PACKED, barrier=True)
            grown.write.mode("append").parquet(f"{path}/trees")
    remove(spark, ready.path)
    trees = spark.read.schema(PACKED).parquet(f"{path}/trees")
    size = trees.agg(F.sum("n_nodes")).first()[0] or 0
    boosted = isinstance(settings, Boosting)
    classify = settings.logistic if boosted else settings.criterion != "variance"
    if size > NODES_ON_DRIVER:
        about = {
            "width": ready.width, "trees": settings.rounds + 1 if boosted else settings.trees, "nodes": size,
            "starts": part_starts(trees), "forest": not boosted, "classify": classify,
            "ends": {str(i): cuts.tolist() for i, cuts in _ends(ready.bins, [settings]).items()},
        }
        return TreeTable(path, about)
    criterion = "variance" if boosted else settings.criterion

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for line in batch.to_pylist():
                found = Nodes(classify and not boosted, criterion)
                found.add_packed(line)
                yield from found.batches()

    trees.mapInArrow(nodes, NODES).write.parquet(f"{path}/data")
    model = _as_mllib(spark, path, settings, ready.width, label)
    remove(spark, path)
    return model


def _grow_apart(spark: SparkSession, ready: Prepared, jobs: list[tuple]) -> DataFrame:
    """The trees of each (trial, settings, group), each job grown by a task that holds all lines."""
    table = Lines.of(ready.lines.toArrow(), ready.width)  # no more than a task may hold
    held = spark.sparkContext.broadcast((table, ready.bins, jobs))

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines, bins, todo = held.value
        for batch in batches:
            for number in batch.column("id").to_pylist():
                trial_id, settings, group = todo[number]
                yield from _grown(lines, bins, settings, group).packed(trial_id)

    return spark.range(0, len(jobs), 1, len(jobs)).mapInArrow(grow, PACKED)


def _ends(bins: Bins, settings: list[Forest | Boosting]) -> dict[int, np.ndarray]:
    """The features that are cut at the ends of bins only. A random cut of a feature with few values lies anywhere."""
    anywhere = any(isinstance(s, Forest) and s.random_cuts for s in settings)
    return {i: np.unique(cuts) for i, cuts in enumerate(bins.cuts) if not (anywhere and bins.exact[i])}


@dataclass
class GrownTrials:
    """The trees of the trials of a fold, written below a path, and the places where they cut."""

    trials: list[tuple[int, Forest | Boosting]]
    ends: dict[int, np.ndarray]
    width: int
    trees: DataFrame

    def placed(self, cases: DataFrame) -> DataFrame:
        """Cases with the features ``x`` by the cell they fall into."""
        return with_cells(cases, F.col("x"), self.ends, self.width, "cell").drop("x")

    def scores(self, cells: DataFrame) -> DataFrame:
        """(trial_id, cell, score) of different cells: slices of them meet the trees."""
        sums = sums_of_cells(self.trees, part_starts(self.trees), cells, "cell", self.ends)
        forests = {t: s.trees for t, s in self.trials if isinstance(s, Forest)}
        logistic = [t for t, s in self.trials if isinstance(s, Boosting) and s.logistic]
        counts = F.create_map(*[F.lit(v) for pair in {-1: 1, **forests}.items() for v in pair])
        score = (
            F.when(F.col("trial_id").isin(list(forests)), F.col("said") / counts[F.col("trial_id")])
            .when(F.col("trial_id").isin(logistic), 1 / (1 + F.exp(-2 * F.col("said"))))
            .otherwise(F.col("said"))
        )
        return sums.select("trial_id", "cell", score.alias("score"))


def grow_trials(
    train: DataFrame, label: str, trials: list[tuple[int, Forest | Boosting]], path: str, max_bins: int = MAX_BINS,
    times: str | None = None,
) -> GrownTrials | None:
    """The trees of all trials, grown on ``train`` at once; no model is put together. ``times`` is that of ``prepare``.

    None where the lines are too many for a task; ``fit_trees`` does without that.
    """
    spark = train.sparkSession
    ready = prepare(train, label, max_bins, times=times)
    if ready.n_lines > LINES_PER_TASK:
        remove(spark, ready.path)
        return None
    jobs = [(t, s, group) for t, s in trials for group in _groups(ready, s, LINES_PER_TASK)]
    jobs.sort(key=lambda job: isinstance(job[1], Forest))  # the longest first
    _grow_apart(spark, ready, jobs).select(*SCORING).write.parquet(path)
    remove(spark, ready.path)
    return GrownTrials(trials, _ends(ready.bins, [s for _, s in trials]), ready.width, spark.read.parquet(path))


def score_trials(
    train: DataFrame, label: str, trials: list[tuple[int, Forest | Boosting]], x: DataFrame,
    max_bins: int = MAX_BINS, path: str | None = None,
) -> DataFrame | None:
    """(trial_id, x, score) of the rows of ``x`` by trees grown on ``train``: the trials of a fold at once."""
    grown = grow_trials(train, label, trials, path or new_path(train.sparkSession, "trees"), max_bins)
    if grown is None:
        return None
    keyed = with_cells(x.select("x"), F.col("x"), grown.ends, grown.width, "cell")
    scores = grown.scores(keyed.select("cell").distinct())
    return keyed.join(scores, "cell").select("trial_id", "x", "score")


def score_cases(grown: GrownTrials, placed: DataFrame) -> DataFrame:
    """The cases that ``GrownTrials.placed`` gave, once for each trial, with trial_id and score."""
    return placed.join(grown.scores(placed.select("cell").distinct()), "cell").drop("cell")


def _together(bins: Bins, width: int, settings: Forest | Boosting, group: list[int]):
    """Each task holds its share of the lines; all choose the same splits, the first one tells them."""

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = BarrierTaskContext.get()
        schema = pa.schema([("bins", pa.binary()), ("n", pa.float64()), ("s", pa.float64())])
        table = pa.Table.from_batches([b.cast(schema) for b in batches], schema=schema)
        share = context.partitionId()
        mine = Lines.of(table, width, share, _exchange(context))
        nodes = _grown(mine, bins, settings, group)
        if share == 0:
            yield from nodes.packed()

    return grow


def _grown(lines: Lines, bins: Bins, settings: Forest | Boosting, group: list[int]) -> Nodes:
    if isinstance(settings, Boosting):
        return grow_boosted(lines, bins, settings)
    return grow_forest(lines, bins, settings, group)


def _groups(ready: Prepared, settings: Forest | Boosting, lines_per_task: int) -> list[list[int]]:
    """Trees that grow side by side within a task; boosting is one group."""
    if isinstance(settings, Boosting):
        return [[0]]
    n = min(max(ready.n_lines, 1), lines_per_task)
    cores = ready.lines.sparkSession.sparkContext.defaultParallelism
    size = max(1, min(KEYS_PER_TASK // (n * settings.features), -(-settings.trees // cores)))
    return [list(range(at, min(at + size, settings.trees))) for at in range(0, settings.trees, size)]


def _as_mllib(spark: SparkSession, path: str, settings: Forest | Boosting, width: int, label: str):
    """The model whose nodes lie under the path, with the descriptions that MLlib's reader expects."""
    boosted = isinstance(settings, Boosting)
    classify = settings.logistic if boosted else settings.criterion != "variance"
    kind = f"{'GBT' if boosted else 'RandomForest'}{'Classification' if classify else 'Regression'}Model"
    package = "org.apache.spark.ml.classification" if classify else "org.apache.spark.ml.regression"
    trees = settings.rounds + 1 if boosted else settings.trees
    impurity = "variance" if boosted else settings.criterion
    about = {"timestamp": int(time.time() * 1000), "sparkVersion": spark.version}
    whole = about | {
        "class": f"{package}.{kind}", "uid": f"{kind}_{path[-12:]}", "paramMap": {"labelCol": label},
        "defaultParamMap": {"impurity": impurity, "featuresCol": "features"},
        "numFeatures": width, "numTrees": trees,
    }
    whole["paramMap"]["maxIter" if boosted else "numTrees"] = trees
    if classify and not boosted:
        whole["numClasses"] = 2
    single = "Classification" if classify and not boosted else "Regression"
    each = about | {
        "class": f"org.apache.spark.ml.{single.lower()}.DecisionTree{single}Model", "uid": "tree",
        "paramMap": {}, "defaultParamMap": {"impurity": impurity},
    }
    spark.createDataFrame([(json.dumps(whole),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    numbered = spark.range(0, trees, 1, 1).select(
        F.col("id").cast("int").alias("_1"), F.lit(json.dumps(each)).alias("_2"), F.lit(1.0).alias("_3")
    )
    numbered.write.parquet(f"{path}/treesMetadata")
    return getattr(mlc if classify else mlr, kind).load(path)

