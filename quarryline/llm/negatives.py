"""Mine hard negatives, with scores bounded by stored angles before they are computed.

Components become integers, and every row stores its norm and its angles to a few reference directions
(the mean directions of the largest labels). The angle between two rows is at least the difference of
their angles to a direction, and at most their sum or what that lacks to a full turn. So each direction
gives an interval for the cosine; times the norms, widened by more than all rounding, it bounds the integer
score. Only rows whose interval reaches into what is asked get their integer inner product.

Anchors are the queries: shards of them meet strips of rows, and each strip tells its best few rows.
A first round finds the positives of each anchor, a second one the negatives in the windows that the
positives' scores open.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarryline.llm.common import tidy, written

SCALE = 256
POSITIVES, NEGATIVES = 5, 5
LOW, HIGH = 80, 100  # a negative's score lies between these percentages of the positive's
DIRECTIONS = 8
STRIP, SHARD = 32_768, 4_096  # rows and anchors that meet in one task
TILE_ROWS, TILE_ANCHORS = 4_096, 128
SLACK = 4e-6  # radians, and of a cosine: more than single precision loses
NO_ID = np.iinfo(np.int64).max  # a row without id comes after all others of its score
LARGEST = np.iinfo(np.int64).max


def _numbers(vectors: pa.Array, wide: int) -> np.ndarray:
    """Rows of whole numbers as doubles; shorter vectors are filled with zeros."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    flat = np.floor(SCALE * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    lengths = np.diff(vectors.offsets.to_numpy())
    if (lengths == wide).all():
        return flat.reshape(len(vectors), wide)
    out = np.zeros((len(vectors), wide))
    out[np.repeat(np.arange(len(vectors)), lengths), _places(lengths)] = flat
    return out


def _places(lengths: np.ndarray) -> np.ndarray:
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)


def _norms(numbers: np.ndarray) -> np.ndarray:
    return np.sqrt((numbers * numbers).sum(axis=1))


def _angles(numbers: np.ndarray, norms: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Angles to the directions, in single precision; a zero vector has none and its score is zero."""
    with np.errstate(all="ignore"):
        cosines = numbers @ directions.T / np.where(norms > 0, norms, 1)[:, None]
    return np.arccos(np.clip(np.nan_to_num(cosines), -1, 1)).astype(np.float32)


def bounds(
    mine: np.ndarray, theirs: np.ndarray, my_norms: np.ndarray, their_norms: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the scores of each anchor (angles, norms) with each row."""
    apart = np.zeros((len(mine), len(theirs)), np.float32)
    turn = np.full((len(mine), len(theirs)), np.pi, np.float32)
    for k in range(mine.shape[1]):
        a, b = mine[:, k : k + 1], theirs[:, k]
        np.maximum(apart, np.abs(a - b), out=apart)
        both = a + b
        np.minimum(turn, np.minimum(both, np.float32(2 * np.pi) - both), out=turn)
    product = my_norms[:, None] * their_norms
    upper = np.cos(np.maximum(apart - np.float32(SLACK), 0)) + SLACK
    lower = np.cos(np.minimum(turn + np.float32(SLACK), np.float32(np.pi))) - SLACK
    return product * lower - 1, product * upper + 1


def scores(mine: np.ndarray, theirs: np.ndarray, largest: float) -> np.ndarray:
    """Exact inner products, given the largest product of norms; beyond a long they are its limit."""
    if largest < 1 << 23:
        return (mine.astype(np.float32) @ theirs.astype(np.float32).T).astype(np.int64)
    if largest < 1 << 52:
        return (mine @ theirs.T).astype(np.int64)
    whole = [[[int(x) for x in row] for row in side] for side in (mine, theirs)]
    exact = np.array([[sum(x * y for x, y in zip(a, b)) for b in whole[1]] for a in whole[0]], dtype=object)
    return np.clip(exact.reshape(len(mine), len(theirs)), -LARGEST, LARGEST).astype(np.int64)


class _Best:
    """The best few (score, id) of a query: higher scores first, then smaller ids."""

    def __init__(self, size: int):
        self.size, self.scores, self.ids = size, np.empty(0, np.int64), np.empty(0, np.int64)

    @property
    def least(self) -> float:
        """What a score must reach to count."""
        return self.scores[-1] if len(self.scores) == self.size else -math.inf

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores) > 2 * self.size:
            enough = np.partition(scores, -self.size)[-self.size]
            scores, ids = scores[scores >= enough], ids[scores >= enough]
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        first = np.lexsort((ids, -scores))[: self.size]
        self.scores, self.ids = scores[first], ids[first]


def _side(table: pa.Table, wide: int) -> dict[str, np.ndarray]:
    """The rows of a strip or a shard as arrays."""

    def matrix(name: str, kind) -> np.ndarray:
        data = b"".join(table.column(name).to_pylist())
        return np.frombuffer(data, kind).reshape(table.num_rows, -1 if table.num_rows else 0)

    numbers = matrix("numbers", np.int16 if table.num_rows and len(table.column("numbers")[0].as_py()) == 2 * wide else np.float64)
    return {
        "id": table.column("id").fill_null(NO_ID).to_numpy(),
        "label": table.column("label").to_numpy(),
        "numbers": numbers.astype(np.float64),
        "angles": matrix("angles", np.float32),
        "norm": table.column("norm").to_numpy(),
    }


def _search(
    rows: dict[str, np.ndarray], anchors: dict[str, np.ndarray], same_label: bool,
    queries: list[list[tuple[float, float, _Best]]], size: int,
) -> None:
    """Offer the rows of a strip to the queries (low, high, best) of each anchor of a shard."""
    order = np.lexsort((rows["angles"][:, 0], rows["label"]))
    rows = {k: v[order] for k, v in rows.items()}
    largest = float(rows["norm"].max() * anchors["norm"].max()) if len(order) else 0.0
    for at in range(0, len(order), TILE_ROWS):
        tile = {k: v[at : at + TILE_ROWS] for k, v in rows.items()}
        labels = np.unique(tile["label"])
        if same_label:
            fits = np.isin(anchors["label"], labels)
        else:
            fits = np.ones(len(anchors["id"]), bool) if len(labels) > 1 else anchors["label"] != labels[0]
        fits &= np.fromiter(map(bool, queries), bool, len(queries))
        who = np.flatnonzero(fits)
        for first in range(0, len(who), TILE_ANCHORS):
            some = who[first : first + TILE_ANCHORS]
            low, high = bounds(anchors["angles"][some], tile["angles"], anchors["norm"][some], tile["norm"])
            allowed = (anchors["label"][some, None] == tile["label"]) == same_label
            allowed &= anchors["id"][some, None] != tile["id"]
            asked = np.zeros(allowed.shape, bool)
            for i, a in enumerate(some):
                for start, end, best in queries[a]:
                    asked[i] |= (high[i] >= max(start, best.least)) & (low[i] <= end)
            asked &= allowed
            mine, theirs = asked.any(axis=1), asked.any(axis=0)
            if not mine.any():
                continue
            found = scores(anchors["numbers"][some[mine]], tile["numbers"][theirs], largest)
            ids = tile["id"][theirs]
            for line, i in zip(found, np.flatnonzero(mine)):
                reach = asked[i][theirs]
                for start, end, best in queries[some[i]]:
                    take = reach & (line >= max(start, best.least)) & (line <= end)
                    if take.any():
                        best.add(line[take], ids[take])


FOUND = "anchor long, of int, score long, id long"
_FOUND = pa.schema([("anchor", pa.int64()), ("of", pa.int32()), ("score", pa.int64()), ("id", pa.int64())])


def _found(anchors: pa.Table, queries: list[list[tuple[float, float, _Best]]]) -> pa.Table:
    out: dict[str, list] = {n: [] for n in _FOUND.names}
    for anchor, mine in zip(anchors.column("anchor").to_pylist(), queries):
        for of, (_, _, best) in enumerate(mine):
            for score, number in zip(best.scores.tolist(), best.ids.tolist()):
                line = (anchor, of, score, None if number == NO_ID else number)
                for name, value in zip(out, line):
                    out[name].append(value)
    return pa.table([pa.array(out[f.name], f.type) for f in _FOUND], schema=_FOUND)


def _meeting(wide: int, windows: bool, size: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """What a shard finds in a strip: positives without ``windows``, else negatives within them."""

    def meet(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        if windows:
            opened = [[(w["low"], w["high"]) for w in line] for line in anchors.column("windows").to_pylist()]
        else:
            opened = [[(-math.inf, math.inf)]] * anchors.num_rows
        queries = [[(low, high, _Best(size)) for low, high in line] for line in opened]
        if rows.num_rows and anchors.num_rows:
            _search(_side(rows, wide), _side(anchors, wide), not windows, queries, size)
        return _found(anchors, queries)

    return meet


def _prepared(vectors: DataFrame, wide: int, small: bool, directions: np.ndarray) -> DataFrame:
    """(id, label, is_anchor, numbers, angles, norm, near) of each row that takes part."""
    kinds = (np.int16 if small else np.float64), np.float32
    out = "id long, label long, is_anchor boolean, numbers binary, angles binary, norm double, near float"
    schema = pa.schema(
        [("id", pa.int64()), ("label", pa.int64()), ("is_anchor", pa.bool_()), ("numbers", pa.binary()),
         ("angles", pa.binary()), ("norm", pa.float64()), ("near", pa.float32())]
    )

    def prepare(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            numbers = _numbers(batch.column("vector"), wide)
            norms = _norms(numbers)
            angles = _angles(numbers, norms, directions)
            lines = [
                pa.array([line.tobytes() for line in matrix.astype(kind)], pa.binary())
                for matrix, kind in zip((numbers, angles), kinds)
            ]
            columns = [batch.column(n).cast(schema.field(n).type) for n in ("id", "label", "is_anchor")]
            near = pa.array(angles.min(axis=1) if len(numbers) else [], pa.float32())
            yield pa.RecordBatch.from_arrays([*columns, *lines, pa.array(norms, pa.float64()), near], schema=schema)

    return vectors.mapInArrow(prepare, out)


def _directions(vectors: DataFrame, wide: int) -> np.ndarray:
    """Unit vectors: the mean directions of the labels with the most rows.

    They only decide how much is left out before scoring, never what is found.
    """
    most = vectors.groupBy("label").count().orderBy(F.desc("count"), "label").limit(DIRECTIONS)
    labels = [r["label"] for r in most.collect()]
    parts = vectors.filter(F.col("label").isin(labels)).select("label", F.posexplode("vector").alias("at", "x"))
    sums = parts.groupBy("label", "at").agg(F.sum(F.floor(SCALE * F.col("x").cast("double")).cast("double")).alias("sum"))
    out = np.zeros((max(1, len(labels)), wide))
    for r in sums.collect():  # at most DIRECTIONS x components
        out[labels.index(r["label"]), r["at"]] = r["sum"]
    size = np.sqrt((out * out).sum(axis=1, keepdims=True))
    out = np.where(size > 0, out / np.where(size > 0, size, 1), 0)
    if wide:
        out[(size == 0)[:, 0], 0] = 1
    return out


def _takes_part(vector: Column, label: Column) -> Column:
    """A label, and components that are finite numbers and stay so when scaled."""
    fine = F.forall(vector, lambda x: x.isNotNull() & (F.abs(SCALE * x.cast("double")) <= F.lit(1.7e308)))
    return label.isNotNull() & vector.isNotNull() & F.coalesce(fine, F.lit(False))


@tidy
def hard_negatives(
    table: DataFrame, anchors: Column, key: str = "vec_id", vector: str = "embedding", label: Column | str = "label"
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), all of whole numbers.

    ``anchors`` says which rows ask. A row's score is the inner product of floor(256 x) with the
    anchor; higher ones come first, then smaller ids. An anchor's positives are its first five other rows of its
    label; for each come the first five rows of other labels whose score lies between 80 and 100 percent of the
    positive's. Rows with a null label or vector, or a component that is null or not finite (scaled
    too), take no part. Shorter vectors are filled with zeros, an empty one scores zero. Rows with the
    anchor's id are no partners of it; equal anchors ask once; other repeated rows count as often as
    they come. A row without id comes after all others of its score and asks nothing unless ``anchors``
    says so. Scores beyond a long are its limit. Other columns do not matter. No rows, no lines.
    """
    spark = table.sparkSession
    named = F.col(label) if isinstance(label, str) else label
    rows = table.select(
        F.col(key).cast("long").alias("id"),
        named.cast("long").alias("label"),
        F.coalesce(anchors, F.lit(False)).alias("is_anchor"),
        F.col(vector).alias("vector"),
    ).filter(_takes_part(F.col("vector"), F.col("label")))
    facts = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("is_anchor").alias("asking"),
        F.max(F.size("vector")).alias("wide"),
        F.max(F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double"))))).alias("top"),
    ).first()
    wide, small = facts["wide"] or 0, SCALE * (facts["top"] or 0) < 32_000
    strips, shards = (max(1, -(-facts[n] // size)) for n, size in (("n", STRIP), ("asking", SHARD)))
    ready = _prepared(rows, max(wide, 1), small, _directions(rows, max(wide, 1)))
    # Neighbours in label and angle share a strip; equal rows are told apart by where they were read.
    dealt = ready.withColumn("read", F.monotonically_increasing_id()).repartitionByRange(
        strips, "label", "near", "id", "read"
    )
    stored = written(dealt.drop("read").withColumn("strip", F.spark_partition_id()), "strips")
    asking = stored.filter("is_anchor").dropDuplicates(["id", "label", "numbers"])
    asking = asking.withColumn("anchor", F.xxhash64("id", "label", "numbers"))
    asking = asking.withColumn("shard", F.pmod(F.col("anchor"), F.lit(shards)).cast("int"))
    held = ["id", "label", "numbers", "angles", "norm"]
    cells = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    meet = stored.select("strip", *held).select("*", cells)
    where = stored.groupBy("strip").agg(F.lit(1).alias("one")).select("strip", cells)

    def told(queries: DataFrame, windows: bool, size: int) -> DataFrame:
        """The best rows of each query, from the best of each strip."""
        sent = where.join(queries, "shard").withColumnsRenamed({"strip": "to", "shard": "part"})
        found = meet.groupBy("strip", "shard").cogroup(sent.groupBy("to", "part"))
        each = found.applyInArrow(_meeting(max(wide, 1), windows, size), FOUND)
        ahead = Window.partitionBy("anchor", "of").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
        return each.withColumn("rank", F.row_number().over(ahead)).filter(F.col("rank") <= size)

    positives = written(told(asking.select("shard", "anchor", *held), False, POSITIVES), "positives")
    whole = T.DecimalType(38, 0)
    low = F.ceil(F.col("score").cast(whole) * LOW / 100).cast("long")
    high = F.floor(F.col("score").cast(whole) * HIGH / 100).cast("long")
    opened = positives.filter("score >= 0").groupBy("anchor").agg(
        F.sort_array(F.collect_list(F.struct("rank", low.alias("low"), high.alias("high")))).alias("windows")
    )
    asked = asking.join(opened, "anchor").select("shard", "anchor", *held, "windows")
    negatives = told(asked, True, NEGATIVES).select(
        "anchor", (F.col("of") + 1).alias("place"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    return (
        negatives.join(
            positives.select(
                "anchor", F.col("rank").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")
            ),
            ["anchor", "place"],
        )
        .join(asking.select("anchor", F.col("id").alias("anchor_id")), "anchor")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
