"""Exact ranks, running totals and order statistics without a one-task sort of the table.

Two shapes of work are covered:

* ``order_statistics`` / ``cut_points`` find a few exact values of the sorted order. The rows are
  counted per equal-width bin; the bins that hold a wanted rank are split again until what is left
  is one value or few enough rows to sort.
* ``running`` attaches a cumulative sum or maximum to every row. The same counts give value ranges
  of similar size; a table with one line per range carries the totals of the ranges before.

Every pass is a count per bin: partial counts are combined map-side, the result has a bounded
number of lines, and nothing grows with the number of input partitions. A value that many rows
share (a third of the table, say) is one line in a count, and ``running`` spreads its rows over
ranges of the tie-break column.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_TO_SORT = 1_000_000  # an interval with more rows is divided again, one with fewer is sorted
BINS = 1024
LARGEST = 1.7976931348623157e308


@dataclass(frozen=True)
class Found:
    """The value at a 1-based rank, with the rows strictly below it and the rows equal to it."""

    rank: int
    value: object
    below: int
    ties: int


@dataclass(frozen=True)
class Wanted:
    """A column (NULLs are left out) and the ranks to look up, given its exact row count.

    ``bounds`` that are known beforehand save the pass that finds the lowest and highest value.
    """

    column: Column
    ranks: Callable[[int], Sequence[int]]
    bounds: tuple[float, float] | None = None


@dataclass(frozen=True)
class Interval:
    """Rows with values from ``low`` to ``high``, both present; ``below`` rows come before them."""

    low: object
    high: object
    below: int
    rows: int

    @property
    def single(self) -> bool:
        return self.low == self.high

    @property
    def ends(self) -> tuple[float, float]:
        low, high = float(self.low), float(self.high)
        return max(low, -LARGEST), min(high, LARGEST)

    def divisible(self) -> bool:
        """False when the values differ by less than a double can tell."""
        low, high = self.ends
        return high / 2 - low / 2 > 0

    def holds(self, rank: int) -> bool:
        return self.below < rank <= self.below + self.rows


Intervals = dict[int, list[Interval]]  # per spec, disjoint and ascending


def _number(value: Column) -> Column:
    """The value as a finite double, in the same order."""
    return F.greatest(F.least(value.cast("double"), F.lit(LARGEST)), F.lit(-LARGEST))


class _Columns:
    """Specs that are columns of one table."""

    def __init__(self, df: DataFrame, columns: Sequence[Column]):
        self.df = df.select(*[c.alias(f"v{i}") for i, c in enumerate(columns)])
        self.n = len(columns)

    def whole(self) -> dict[int, Interval]:
        """One interval with all rows of each spec, from one aggregate over all columns."""
        measures = []
        for i in range(self.n):
            present = F.when(~F.isnan(f"v{i}"), F.col(f"v{i}"))
            measures += [
                F.min(present).alias(f"low{i}"),
                F.max(present).alias(f"high{i}"),
                F.count(present).alias(f"n{i}"),
            ]
        seen = self.df.agg(*measures).first()
        return {
            i: Interval(seen[f"low{i}"], seen[f"high{i}"], 0, seen[f"n{i}"])
            for i in range(self.n)
            if seen[f"n{i}"]
        }

    def inside(self, intervals: Intervals) -> DataFrame:
        """(spec, place, value) of the rows inside the intervals, ``place`` counting them from 0."""
        marked = self.df
        for i, parts in intervals.items():
            marked = _mark(marked, f"v{i}", parts, f"p{i}")
        fields = {
            i: [F.col(f"p{i}").alias("place"), F.col(f"v{i}").alias("value")] for i in intervals
        }
        return self._stacked(marked, fields).filter("place IS NOT NULL")

    @staticmethod
    def _stacked(df: DataFrame, fields: dict[int, list[Column]]) -> DataFrame:
        # also for one spec: filters then see the value, and do not compute its expression again
        entries = [F.struct(F.lit(i).alias("spec"), *columns) for i, columns in fields.items()]
        rows = df.select(F.inline(F.array(*entries)))
        return rows.filter("value IS NOT NULL AND NOT isnan(value)")


class _Labelled:
    """A long table (spec, value) where each row belongs to one of many specs."""

    def __init__(self, df: DataFrame, n: int):
        self.df, self.n = df.filter("spec IS NOT NULL AND value IS NOT NULL"), n

    def whole(self) -> dict[int, Interval]:
        lines = (
            self.df.groupBy("spec")
            .agg(
                F.min("value").alias("low"), F.max("value").alias("high"), F.count("value").alias("n")
            )
            .collect()  # one line per spec
        )
        return {line["spec"]: Interval(line["low"], line["high"], 0, line["n"]) for line in lines}

    def inside(self, intervals: Intervals) -> DataFrame:
        lists = [
            F.array(
                *[
                    F.struct(F.lit(p.ends[0]).alias("low"), F.lit(p.ends[1]).alias("high"))
                    for p in intervals.get(i, [])
                ]
            ).cast("array<struct<low: double, high: double>>")
            for i in range(self.n)
        ]
        x = _number(F.col("value"))
        hit = F.transform(
            F.get(F.array(*lists), F.col("spec")), lambda p: (p["low"] <= x) & (x <= p["high"])
        )
        place = (F.array_position(hit, True) - 1).cast("int")
        return (
            self.df.filter(F.col("spec").isin(list(intervals)))
            .select("spec", place.alias("place"), "value")
            .filter("place >= 0")
        )


def _mark(df: DataFrame, column: str, parts: Sequence[Interval], output: str) -> DataFrame:
    """Add the number of the interval that holds the value, NULL outside all of them."""
    edges = [e for p in parts for e in (p.ends[0], math.nextafter(p.ends[1], math.inf))]
    edges[-1] = min(edges[-1], LARGEST)
    splits = sorted({-math.inf, *edges, math.inf})
    first = [splits.index(p.ends[0]) for p in parts]
    marked = Bucketizer(
        splits=splits, inputCol="_x", outputCol="_b", handleInvalid="keep"
    ).transform(df.withColumn("_x", _number(F.col(column))))
    bucket = F.col("_b").cast("int")
    if len(parts) == 1:
        place = F.when(bucket == first[0], 0)
    else:
        numbers = [cell for k, f in enumerate(first) for cell in (F.lit(f), F.lit(k))]
        place = F.try_element_at(F.create_map(*numbers), bucket)
    high = [p.ends[1] for p in parts]
    if high[-1] == LARGEST:  # the last bucket has no edge after it
        place = F.when(F.col("_x") == LARGEST, len(parts) - 1).otherwise(place)
    return marked.withColumn(output, place).drop("_x", "_b")


def _divide(source: _Columns | _Labelled, intervals: Intervals, bins: int) -> Intervals:
    """Split every interval into at most ``bins`` equal-width bins, with exact counts."""
    flat = [(i, k, p.ends) for i, parts in intervals.items() for k, p in enumerate(parts)]
    lookup = F.create_map(
        *[
            cell
            for i, k, (low, high) in flat
            for cell in (
                F.lit((i << 32) + k),
                F.struct(F.lit(low / 2).alias("low"), F.lit(high / 2 - low / 2).alias("width")),
            )
        ]
    )
    place = F.shiftleft(F.col("spec").cast("bigint"), 32) + F.col("place")
    placed = source.inside(intervals).withColumn("ends", F.element_at(lookup, place))
    # halves keep the width of the widest interval finite
    position = (_number(F.col("value")) / 2 - F.col("ends.low")) / F.col("ends.width")
    counted = (
        placed.select(
            "spec",
            "place",
            "value",
            F.least(F.floor(position * bins), F.lit(bins - 1)).cast("int").alias("bin"),
        )
        .groupBy("spec", "place", "bin")
        .agg(F.min("value").alias("low"), F.max("value").alias("high"), F.count("value").alias("n"))
        .collect()  # at most ``bins`` lines per interval
    )
    before: dict[tuple[int, int], int] = {}
    parts: Intervals = defaultdict(list)
    for line in sorted(counted, key=lambda r: (r["spec"], r["place"], r["bin"])):
        at = (line["spec"], line["place"])
        below = before.get(at, intervals[at[0]][at[1]].below)
        parts[at[0]].append(Interval(line["low"], line["high"], below, line["n"]))
        before[at] = below + line["n"]
    return parts


def _locate(
    source: _Columns | _Labelled,
    ranks: Sequence[Callable[[int], Sequence[int]]],
    bounds: Sequence[tuple[float, float]] | None = None,
) -> list[tuple[int, list[Found]]]:
    """(row count, wanted order statistics) of every spec."""
    if bounds is None:
        pending: Intervals = {i: [p] for i, p in source.whole().items()}
    else:
        everything = {i: [Interval(low, high, 0, 0)] for i, (low, high) in enumerate(bounds)}
        pending = _divide(source, everything, BINS)
    sizes = {i: parts[-1].below + parts[-1].rows for i, parts in pending.items()}
    wanted = {i: sorted(set(ranks[i](n))) for i, n in sizes.items()}
    answers: dict[tuple[int, int], Found] = {}
    to_sort: Intervals = defaultdict(list)
    while pending:
        too_big: Intervals = defaultdict(list)
        for i, parts in pending.items():
            for p in parts:
                inside = [r for r in wanted[i] if p.holds(r)]
                if inside and p.single:
                    answers |= {(i, r): Found(r, p.low, p.below, p.rows) for r in inside}
                elif inside and (p.rows <= ROWS_TO_SORT or not p.divisible()):
                    to_sort[i].append(p)
                elif inside:
                    too_big[i].append(p)
        pending = _divide(source, too_big, BINS) if too_big else {}
    if to_sort:
        answers |= _sort_inside(source, to_sort, wanted)
    return [
        (sizes[i], [answers[i, r] for r in ranks[i](sizes[i])]) if i in sizes else (0, [])
        for i in range(source.n)
    ]


def _sort_inside(
    source: _Columns | _Labelled, intervals: Intervals, wanted: dict[int, list[int]]
) -> dict[tuple[int, int], Found]:
    """Rank the distinct values of small intervals and pick the wanted ones."""
    for parts in intervals.values():
        parts.sort(key=lambda p: p.below)
    places = F.create_map(
        *[
            cell
            for i, parts in intervals.items()
            for k, p in enumerate(parts)
            for cell in (
                F.lit((i << 32) + k),
                F.array(*[F.lit(r - p.below).cast("bigint") for r in wanted[i] if p.holds(r)]),
            )
        ]
    )
    values = source.inside(intervals).groupBy("spec", "place", "value").agg(
        F.count(F.lit(1)).alias("ties")
    )
    order = Window.partitionBy("spec", "place").orderBy("value")
    upto = F.sum("ties").over(order.rowsBetween(Window.unboundedPreceding, 0))
    place = F.shiftleft(F.col("spec").cast("bigint"), 32) + F.col("place")
    picked = (
        values.withColumn("upto", upto)
        .withColumn("ranks", F.element_at(places, place))
        .filter("exists(ranks, r -> r <= upto AND r > upto - ties)")
    )
    answers = {}
    for line in picked.collect():  # at most one line per wanted rank
        i = line["spec"]
        below = intervals[i][line["place"]].below + line["upto"] - line["ties"]
        for r in wanted[i]:
            if below < r <= below + line["ties"]:
                answers[i, r] = Found(r, line["value"], below, line["ties"])
    return answers


def order_statistics(df: DataFrame, wanted: dict[str, Wanted]) -> dict[str, tuple[int, list[Found]]]:
    """Exact order statistics of several columns of one type: ``{name: (n, [Found, ...])}``."""
    source = _Columns(df, [w.column for w in wanted.values()])
    bounds = [w.bounds for w in wanted.values()]
    known = bounds if None not in bounds else None
    return dict(zip(wanted, _locate(source, [w.ranks for w in wanted.values()], known)))


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]
) -> dict[str, list[float | None]]:
    """Quantiles with linear interpolation between neighbours, NULLs left out."""

    def neighbours(n: int) -> list[int]:
        spots = [p * (n - 1) for p in probabilities]
        return [int(k) + 1 for s in spots for k in (math.floor(s), math.ceil(s))]

    wanted = {c: Wanted(F.col(c).cast("double"), neighbours) for c in columns}
    result = {}
    for c, (n, found) in order_statistics(df, wanted).items():
        values: list[float | None] = []
        for k, p in enumerate(probabilities):
            if not n:
                values.append(None)
                continue
            low, high = found[2 * k].value, found[2 * k + 1].value
            spot = p * (n - 1)
            values.append(low + (high - low) * (spot - math.floor(spot)))
        result[c] = values
    return result


@dataclass(frozen=True)
class Cut:
    """A place in the order (value, key): rows up to and including it come first."""

    value: object
    key: object | None  # None: every row with this value comes first

    def reached_by(self, value: Column, key: Column) -> Column:
        """True for rows at or before the cut."""
        if self.key is None:
            return value <= F.lit(self.value)
        return (value < F.lit(self.value)) | (
            (value == F.lit(self.value)) & (key <= F.lit(self.key))
        )


def cut_points(
    df: DataFrame,
    orders: dict[str, Column],
    key: Column,
    ranks: Callable[[int], Sequence[int]],
    bounds: tuple[float, float] | None = None,
) -> dict[str, tuple[int, list[Cut]]]:
    """Exact cuts after the given ranks, for several orders (value, key).

    ``key`` is numeric and unique; it is looked at only where a cut goes through equal values.
    """
    located = order_statistics(
        df, {name: Wanted(value, ranks, bounds) for name, value in orders.items()}
    )
    # tied values that a cut goes through: (order, value) -> ranks among the ties
    split: dict[tuple[str, object], list[int]] = {}
    for name, (_, found) in located.items():
        for f in found:
            if f.rank - f.below < f.ties:
                split.setdefault((name, f.value), []).append(f.rank - f.below)
    keys = _keys_among_ties(df, orders, key, split) if split else {}
    return {
        name: (n, [Cut(f.value, keys.get((name, f.value, f.rank - f.below))) for f in found])
        for name, (n, found) in located.items()
    }


def _keys_among_ties(
    df: DataFrame,
    orders: dict[str, Column],
    key: Column,
    split: dict[tuple[str, object], list[int]],
) -> dict[tuple[str, object, int], object]:
    """The key at each wanted rank among the rows that share a value."""
    entries = []
    for name in orders:
        numbers = [
            cell
            for spec, (order, value) in enumerate(split)
            if order == name
            for cell in (F.lit(value), F.lit(spec))
        ]
        if numbers:
            spec = F.try_element_at(F.create_map(*numbers), orders[name])
            entries.append(F.struct(spec.alias("spec"), key.alias("value")))
    source = _Labelled(df.select(F.inline(F.array(*entries))), len(split))
    located = _locate(source, [lambda _, r=tuple(ranks): r for ranks in split.values()])
    return {
        (name, value, f.rank): f.value
        for (name, value), (_, found) in zip(split, located)
        for f in found
    }


# --- running totals ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Ranges:
    """Split points of similar-sized value ranges, and the values that fill a range alone."""

    splits: list[float]
    hot: list


def _ranges(df: DataFrame, columns: Sequence[str], pieces: int) -> list[Ranges]:
    """Ranges of each column with about a ``pieces``-th of its rows each."""
    source = _Columns(df, [F.col(c) for c in columns])
    whole = source.whole()
    limit = {i: p.rows / pieces for i, p in whole.items()}
    leaves: dict[int, list[Interval]] = defaultdict(list)
    pending: Intervals = {}
    for i, p in whole.items():
        (pending.setdefault(i, []) if p.divisible() else leaves[i]).append(p)
    bins = max(64, 4 * pieces)
    while pending:
        heavy: Intervals = defaultdict(list)
        for i, parts in _divide(source, pending, bins).items():
            for p in parts:
                small = p.rows <= limit[i] or not p.divisible()
                (leaves if small else heavy)[i].append(p)
        pending, bins = heavy, 16  # at most ``pieces`` intervals are heavy
    return [_similar_sizes(leaves[i], limit.get(i, 0)) for i in range(len(columns))]


def _similar_sizes(leaves: list[Interval], limit: float) -> Ranges:
    """Different integers that are one double stay together: only a single value can be hot."""
    splits, hot, filled = [], [], math.inf
    for leaf in sorted(leaves, key=lambda p: p.ends):
        if leaf.rows > limit and leaf.single:
            hot.append(leaf.low)
        if filled + leaf.rows > limit:
            splits.append(leaf.ends[0])
            filled = 0
        filled += leaf.rows
    return Ranges(sorted(set(splits)), sorted(set(hot)))


def _bucket(df: DataFrame, column: str, splits: list[float], output: str) -> DataFrame:
    if not splits:  # no values
        return df.withColumn(output, F.lit(0.0))
    return Bucketizer(
        splits=[-math.inf, *splits, math.inf],
        inputCol="_x",
        outputCol=output,
        handleInvalid="keep",
    ).transform(df.withColumn("_x", _number(F.col(column)))).drop("_x")


def running(
    df: DataFrame,
    order: str,
    measures: dict[str, tuple[str, Column]],
    *,
    tie: str | None = None,
    by: Sequence[str] = (),
    descending: bool = False,
    pieces: int | None = None,
) -> DataFrame:
    """Add cumulative measures (inclusive of the current row) in the order (order, tie).

    ``measures`` maps an output name to ``("sum" | "max", column)``. ``order`` is numeric;
    ``tie`` is numeric, ascending and unique among equal ``order`` values, or None when ``order``
    is itself unique within ``by``. Rows whose order is NULL come last. ``pieces`` is the number of ranges, by default that of the
    shuffle partitions. Rows are compared by the column itself; a double only picks the range.
    """
    combine = {"sum": F.sum, "max": F.max}
    value = -F.col(order) if descending else F.col(order)
    pieces = pieces or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    work = df.withColumn("_value", value)
    sort = [F.col("_value").asc_nulls_last()]
    if tie is not None:
        work = work.withColumn("_tie", F.col(tie))
        sort.append(F.col(tie))
    found = _ranges(work, ["_value"] if tie is None else ["_value", "_tie"], pieces)
    upto = (Window.unboundedPreceding, Window.currentRow)
    ranges = found[0]
    work = _bucket(work, "_value", ranges.splits, "_range")
    # inside [s, next) a hot s comes first; it gets an even number, the other values an odd one
    spread = F.col("_value").isin(ranges.hot) if ranges.hot else F.lit(False)
    work = work.withColumn(
        "_range",
        F.when(F.col("_value").isNull(), F.lit(2.0 * len(ranges.splits) + 9))
        .when(spread, 2 * F.col("_range"))
        .otherwise(2 * F.col("_range") + 1),
    )
    if tie is None:
        work = work.withColumn("_tie_range", F.lit(0.0))
    else:
        work = _bucket(work, "_tie", found[1].splits, "_tie_range").withColumn(
            "_tie_range",
            F.when(spread | F.col("_value").isNull(), F.col("_tie_range")).otherwise(0.0),
        )

    place = [*by, "_range", "_tie_range"]
    subtotals = work.groupBy(*place).agg(
        *[combine[kind](c).alias(f"_{out}") for out, (kind, c) in measures.items()]
    )
    earlier = (
        Window.partitionBy(*by)
        .orderBy("_range", "_tie_range")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = subtotals.select(
        *[F.col(c).alias(f"_at_{c}") for c in place],
        *[
            combine[kind](f"_{out}").over(earlier).alias(f"_start_{out}")
            for out, (kind, _) in measures.items()
        ],
    )
    joined = work.join(starts, [F.col(c).eqNullSafe(F.col(f"_at_{c}")) for c in place])
    inside = Window.partitionBy(*place).orderBy(*sort).rowsBetween(*upto)
    totals = {}
    for out, (kind, c) in measures.items():
        local = combine[kind](c).over(inside)
        start = F.col(f"_start_{out}")
        totals[out] = (
            F.greatest(local, start) if kind == "max" else F.coalesce(start, F.lit(0)) + local
        )
    return joined.withColumns(totals).select(*df.columns, *totals)


def ranked(
    df: DataFrame,
    order: str,
    tie: str,
    *,
    by: Sequence[str] = (),
    descending: bool = True,
    name: str = "rank",
    pieces: int | None = None,
) -> DataFrame:
    """Row number in the order (order, tie), per group; rows without a value get no rank."""
    counted = running(
        df, order, {name: ("sum", F.lit(1))}, tie=tie, by=by, descending=descending, pieces=pieces
    )
    return counted.withColumn(name, F.when(F.col(order).isNotNull(), F.col(name)))
