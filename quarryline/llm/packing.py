"""Pack tokenised documents into sequences by best-fit decreasing.

Pieces of equal length are interchangeable, so the packing follows from the number of pieces of each
length: at most ``capacity`` numbers, however many documents there are. The plan goes from the
longest to the shortest length; a segment tree over the remaining capacities finds the tightest
open bin, and all bins alike are filled in one step. The steps say where the k-th piece of a length
goes, so the pieces themselves are only numbered within their length and looked up, in parallel.
"""

from __future__ import annotations

import heapq
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Tokenizer

from quarryline.llm.common import LONGEST_CACHED, LOWER, Remembered, written

CAPACITY = 4096
END_ID = 1
CACHED_WORDS = 1_000_000
MARKS = (b".", b",", b";", b":", b"!", b"?")


class WordIds(Remembered):
    """Ids of a word as little-endian 32-bit bytes, remembered within a worker.

    The tokenizer lower-cases and never joins text across white space, so a text has the ids of its
    words. Texts with one of its special tokens in them are left to the tokenizer as a whole.
    """

    def __init__(self, path: str):
        super().__init__(CACHED_WORDS)
        self.tokenizer = Tokenizer.from_file(path)
        specials = self.tokenizer.get_added_tokens_decoder().values()
        self.specials = [t.content.encode() for t in specials]

    def _ids(self, text: str) -> bytes:
        return np.array(
            self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4"
        ).tobytes()

    def learn(self, words: set[bytes]) -> None:
        """Look up new words together and tell their ids apart by place."""
        stems = {self._stem(w) for w in words if len(w) <= LONGEST_CACHED}
        new = [w for w in stems if w not in self]
        if len(self) + len(words) > self.bound:
            self.clear()
        for at in range(0, len(new), 1000):
            part = [w.decode("utf-8", "replace") for w in new[at : at + 1000]]
            found = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ends = np.cumsum([len(w) + 1 for w in part])
            starts = [a for a, _ in found.offsets]
            cuts = [0, *np.searchsorted(starts, ends).tolist()]
            ids = np.array(found.ids, "<u4")
            self.update((w, ids[a:b].tobytes()) for w, a, b in zip(new[at:], cuts, cuts[1:]))

    @staticmethod
    def _stem(word: bytes) -> bytes:
        """The word without one mark after a letter a-z, which is a token of its own."""
        return word[:-1] if word[-1:] in MARKS and word[-2:-1].isalpha() else word

    def __missing__(self, word: bytes) -> bytes:
        stem = self._stem(word)
        if stem is word:
            value = self._ids(word.decode("utf-8", "replace"))
        else:
            value = self[stem] + self[word[-1:]]
        return self.keep(word, value)

    def of(self, text: str) -> bytes:
        self.touch()
        data = text.encode("utf-8", "replace")
        if any(s in data for s in self.specials):
            return self._ids(data.decode())
        words = data.translate(LOWER).split()
        missing = {w for w in words if w not in self}
        if missing:
            self.learn(missing)
        return b"".join(map(self.__getitem__, words))


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[dict[int, np.ndarray], int]:
    """Best-fit decreasing for so many pieces of each length.

    Returns the steps of each length and the number of bins. A step (first, per_bin, bin, offset)
    says: from the first-th piece on, ``per_bin`` pieces each go to bin, bin + 1, ... from the offset.
    The result is that of placing the pieces one by one in the tightest open bin, longest first.
    """
    leaves = 1 << capacity.bit_length()
    tree = np.zeros(2 * leaves, dtype=np.int64)  # open bins below each node, by remaining capacity
    tree = tree.tolist()
    open_bins: dict[int, list[tuple[int, int]]] = defaultdict(list)  # remaining -> (bin, how many)
    steps: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    n_bins = 0

    def change(remaining: int, by: int) -> None:
        node = remaining + leaves
        while node:
            tree[node] += by
            node >>= 1

    def tightest(length: int) -> int:
        """The smallest remaining capacity of at least ``length`` with an open bin, or -1."""
        node = length + leaves
        if tree[node]:
            return length
        while node > 1 and (node & 1 or not tree[node + 1]):
            node >>= 1
        if node <= 1:
            return -1
        node += 1
        while node < leaves:
            node = 2 * node if tree[2 * node] else 2 * node + 1
        return node - leaves

    def put(remaining: int, first: int, many: int) -> None:
        if many and remaining:
            heapq.heappush(open_bins[remaining], (first, many))
            change(remaining, many)

    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError("a piece must have between one token and a full sequence")
        done, left = 0, counts[length]
        while left:
            remaining = tightest(length)
            if remaining < 0:
                remaining, first = capacity, n_bins
                many = -(-left // (capacity // length))
                n_bins += many
            else:
                first, many = heapq.heappop(open_bins[remaining])
                change(remaining, -many)
            per_bin = remaining // length
            used = min(many, -(-left // per_bin))
            placed = min(left, used * per_bin)
            steps[length].append((done, per_bin, first, capacity - remaining))
            short = placed - (used - 1) * per_bin  # pieces in the last bin used
            put(remaining - per_bin * length, first, used - 1)
            put(remaining - short * length, first + used - 1, 1)
            put(remaining, first + used, many - used)
            done, left = done + placed, left - placed
    return {k: np.array(v, dtype=np.int64) for k, v in steps.items()}, n_bins


def pieces(
    docs: DataFrame,
    tokenizer: str,
    text: str = "text",
    carry: Sequence[str] = ("doc_id",),
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """(row, piece, start, length, ids_crc32): a document's ids and the end id, cut if too long."""
    read = docs.select(F.struct(*carry).alias("row"), F.col(text).alias("text"))
    out = T.StructType(
        [read.schema["row"]]
        + T.StructType.fromDDL(
            "piece int, start long, length long, ids_crc32 long"
        ).fields
    )
    end = np.array([end_id], "<u4").tobytes()

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, schema = word_ids(tokenizer), to_arrow_schema(out)
        for batch in rows:
            found: dict[str, list] = {n: [] for n in schema.names if n != "row"}
            of: list[int] = []
            for i, value in enumerate(batch.column("text")):
                ids = known.of(value.as_py() or "") + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    of.append(i)
                    found["piece"].append(k)
                    found["start"].append(at // 4)
                    found["length"].append(len(part) // 4)
                    found["ids_crc32"].append(zlib.crc32(part))
            columns = [batch.column("row").take(pa.array(of, pa.int64())).cast(schema.field("row").type)]
            columns += [pa.array(found[n], schema.field(n).type) for n in schema.names[1:]]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return read.mapInArrow(cut, out)


def pack(
    docs: DataFrame,
    tokenizer: str,
    text: str = "text",
    carry: Sequence[str] = ("doc_id",),
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: row (the carried columns), piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text has one piece with the end id alone. Very long texts have many pieces; only
    texts longer than a sequence are cut. Which of several pieces of one length goes where is free;
    repeated rows get places of their own. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    cut = written(pieces(docs, tokenizer, text, carry, capacity, end_id), "pieces")
    # Number the pieces of a length: within groups of the length, then the groups one after another.
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut.withColumn("part", F.pmod(F.xxhash64("ids_crc32", "row", "piece"), F.lit(spread)))
    within = Window.partitionBy("length", "part").orderBy("ids_crc32", "piece")
    before = (
        Window.partitionBy("length")
        .orderBy("part")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    groups = dealt.groupBy("length", "part").count()
    counts = {r["length"]: r["n"] for r in groups.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    steps, _ = plan(counts, capacity)
    starts = groups.select(
        "length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first")
    )
    ranked = (
        dealt.withColumn("rank", F.row_number().over(within) - 1)
        .join(starts, ["length", "part"])
        .withColumn("rank", F.col("first") + F.col("rank"))
        .select(*cut.columns, "rank")
    )
    out = T.StructType(
        cut.schema.fields + T.StructType.fromDDL("sequence_id long, offset long").fields
    )
    return ranked.mapInArrow(_placed(spark.sparkContext.broadcast(steps), out), out)


def _placed(steps, out: T.StructType) -> Callable:
    """Looks the places up; the steps are bounded by the capacity, whatever the number of pieces."""

    def place(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, schema = steps.value, to_arrow_schema(out)
        for batch in rows:
            lengths = batch.column("length").to_numpy()
            ranks = batch.column("rank").to_numpy(zero_copy_only=False)
            bins, offsets = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
            for length in np.unique(lengths):
                mine = np.flatnonzero(lengths == length)
                of = table[length]
                step = of[np.searchsorted(of[:, 0], ranks[mine], side="right") - 1]
                nth = ranks[mine] - step[:, 0]
                bins[mine] = step[:, 2] + nth // step[:, 1]
                offsets[mine] = step[:, 3] + nth % step[:, 1] * length
            columns = [batch.column(n).cast(schema.field(n).type) for n in schema.names[:-2]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(bins), pa.array(offsets)], schema=schema)

    return place
