"""N-gram Jaccard join by PartEnum signatures.

A document is the set of its distinct word shingles. Sets whose Jaccard similarity reaches the
threshold differ in few shingles, relative to their sizes. Sizes are cut into bands; for a band, the
domain of the shingles (their hashes) is divided into groups of ``PARTS`` partitions, so many that
two similar sets differ by at most one shingle in at least one group. There they agree on all
partitions but one, so one of the ``PARTS`` signatures that leave out one partition is the same. Sets
sign for their own band and the next, which finds partners of either band.

A signature over no shingle at all says nothing and is left out, unless a set has so many of them
that a similar set could be missed; ``Bands`` has room for a few.

Sets that share a signature are compared in full. Equal sets are one node from the start; within a
large group of sets only a hub is compared with the others. What is in different components
afterwards is compared across them, but for sets that share too few shingles with all the others
to be similar to any. Before texts are compared, a sketch of each set tells pairs that differ in
too much; all these bounds are exact. Links are joined to components by contraction.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quarryline.llm.common import WORD_HASHES, mixed, tidy, words_of, written

WORDS = 5
PERCENT = 80
PARTS = 3
SMALL_RUN = 12  # sets that share a signature, up to which all are compared with each other
PER_BUCKET = 1_000_000  # signatures or shingles that are sorted together
BATCH = 512  # sets that are signed together
FILTER_WORDS = 1 << 16  # the most words of 64 bits that are broadcast to tell which texts a join needs
U = np.uint64
SKETCH = [f"s{i}" for i in range(16)]  # columns of 64 bits
GOLDEN = U(0x9E3779B97F4A7C15)
ODD = U(0xD6E8FEB86659FD93)


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; of a shorter text, the whole sequence is one.

    Among m different shingles two share a hash with a probability of m^2 / 2^65.
    """
    found = words_of(text)
    if not found:
        return np.empty(0, U)
    hashes = WORD_HASHES.of(found)
    wide = min(words, len(hashes))
    total = np.full(len(hashes) - wide + 1, U(wide))
    for i in range(wide):
        total = total * GOLDEN + hashes[i : len(hashes) - wide + 1 + i]
    return np.unique(mixed(total))


def similar(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def sketch_of(found: np.ndarray) -> np.ndarray:
    """A bit for each of 1024 classes of shingles: whether the set has an odd number of the class.

    A shingle that only one of two sets has changes one bit, so sketches differ in at most as many
    bits as the sets in shingles.
    """
    odd = np.bincount((mixed(found + GOLDEN) >> U(54)).astype(np.int64), minlength=1024) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def _may_be_similar(a: Sequence[Column], b: Sequence[Column], percent: int) -> Column:
    """False only for sets (size, then the sketch) that differ in too much to be similar."""
    (n_a, *bits_a), (n_b, *bits_b) = a, b
    differ = sum((F.bit_count(x.bitwiseXOR(y)) for x, y in zip(bits_a, bits_b)), F.lit(0))
    close = 100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)
    return close & ((100 + percent) * differ <= (100 - percent) * (n_a + n_b))


class Bands:
    """Size bands and how each of them divides the domain."""

    def __init__(self, percent: int = PERCENT):
        self.percent = percent
        self.last: list[int] = []  # the largest size of each band

    def differ(self, sizes):
        """The most shingles by which similar sets of so many shingles in all can differ."""
        return sizes * (100 - self.percent) // (100 + self.percent)

    def upto(self, size: int) -> None:
        while not self.last or self.last[-1] < size:
            first = self.last[-1] + 1 if self.last else 1
            self.last.append(first * 100 // self.percent)

    def of(self, sizes: np.ndarray) -> np.ndarray:
        if len(sizes):
            self.upto(2 * int(sizes.max()) + 2)
        return np.searchsorted(self.last, sizes)

    def groups(self, band: np.ndarray) -> np.ndarray:
        """Groups for a band: one more than similar sets can differ in by two shingles each, and
        a few besides, for groups in which a set has partitions without shingles."""
        last = np.array(self.last, dtype=np.int64)[band]
        return self.differ(2 * last) // 2 + 1 + np.where(last > 8, 1 + last // 200, 0)


def sign(sets: list[np.ndarray], bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """(signatures, index of the set): all signatures of the sets."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    features = np.concatenate(sets) if sets else np.empty(0, U)
    own = bands.of(sizes)
    signatures, owners = [], []
    low, value = features >> U(32), mixed(features ^ ODD)
    for band in (own, own + 1):
        groups = bands.groups(band)
        cells = groups * PARTS
        first = np.concatenate([[0], np.cumsum(cells)])
        cell = (low * np.repeat(cells, sizes).astype(U)) >> U(32)
        slot = np.repeat(first[:-1], sizes) + cell.astype(np.int64)
        total = np.zeros(first[-1], U)
        np.add.at(total, slot, value)
        held = np.bincount(slot, minlength=first[-1])
        n_groups = int(groups.sum())
        owner = np.repeat(np.arange(len(sets)), groups)
        group = np.arange(n_groups) - np.repeat(np.cumsum(groups) - groups, groups)
        total, held = total.reshape(n_groups, PARTS), held.reshape(n_groups, PARTS)
        salt = mixed(band[owner].astype(U) * GOLDEN + group.astype(U) * ODD)
        rest = held.sum(axis=1, keepdims=True) - held  # shingles of the signature without a part
        # Groups in which a set and a similar one agree for sure, against groups with an empty part.
        largest = np.minimum(np.array(bands.last)[band], sizes * 100 // bands.percent)
        sure = groups - bands.differ(sizes + largest) // 2
        hollow = np.bincount(owner, weights=(rest == 0).any(axis=1), minlength=len(sets))
        all_of = (hollow >= sure)[owner]
        for left_out in range(PARTS):
            kept = [p for p in range(PARTS) if p != left_out]
            code = salt + U(left_out)
            for p in kept:
                code = mixed(code * GOLDEN + total[:, p])
            use = (rest[:, left_out] > 0) | all_of
            signatures.append(code[use])
            owners.append(owner[use])
    return np.concatenate(signatures), np.concatenate(owners)


def _prepared(docs: DataFrame, id_type: T.DataType, words: int) -> DataFrame:
    """(uid, row, id, n, node, packed, sketch): the set of each document by size and hash; its text,
    packed, and its sketch with the first document of an input task that has the set."""
    out = T.StructType(
        [
            T.StructField("uid", T.LongType()),
            docs.schema["row"],
            T.StructField("id", id_type),
            *T.StructType.fromDDL("n long, node long, packed binary").fields,
            *[T.StructField(c, T.LongType()) for c in SKETCH],
        ]
    )
    blank = [None] * len(SKETCH)

    def prepare(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, seen = to_arrow_schema(out), set()
        pack = zstandard.ZstdCompressor(level=3).compress
        uid = TaskContext.get().partitionId() << 33
        for batch in rows:
            sizes, nodes, packed, sketches = [], [], [], []
            for value in batch.column("text"):
                text = value.as_py()
                found = shingles(text, words)
                node = int(node_of(found)) if len(found) else None
                new = node is not None and node not in seen
                if new:
                    seen.add(node)
                sizes.append(len(found))
                nodes.append(node)
                packed.append(pack(text.encode()) if new else None)
                sketches.append(sketch_of(found).tolist() if new else blank)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(uid, uid + len(sizes)), pa.int64()),
                    batch.column("row").cast(schema.field("row").type),
                    batch.column("id").cast(schema.field("id").type),
                    pa.array(sizes, pa.int64()),
                    pa.array(nodes, pa.int64()),
                    pa.array(packed, pa.binary()),
                    *[pa.array(bits, pa.int64()) for bits in (zip(*sketches) if sketches else [()] * len(SKETCH))],
                ],
                schema=schema,
            )
            uid += len(sizes)

    return docs.mapInArrow(prepare, out)


def node_of(found: np.ndarray) -> np.int64:
    """64 bits that stand for a set."""
    position = np.arange(len(found), dtype=U)
    return mixed(np.array([np.sum(mixed(found + position * GOLDEN), dtype=U) + U(len(found))])).view(
        np.int64
    )[0]


def _signed(docs: DataFrame, words: int, percent: int, buckets: int) -> DataFrame:
    """(bucket, codes, nodes): the signatures of the sets, packed by bucket."""
    out = T.StructType.fromDDL("bucket int, codes binary, nodes binary")

    def signed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, seen, bands = to_arrow_schema(out), set(), Bands(percent)
        waiting: list[np.ndarray] = []
        nodes: list[np.int64] = []

        def flush() -> Iterator[pa.RecordBatch]:
            codes, owners = sign(waiting, bands)
            owner_nodes = np.array(nodes, np.int64)[owners]
            waiting.clear()
            nodes.clear()
            yield from _by_bucket(codes, owner_nodes, buckets, schema)

        for batch in rows:
            for value in batch.column("text"):
                found = shingles(value.as_py(), words)
                if not len(found) or (node := node_of(found)) in seen:
                    continue
                seen.add(node)
                waiting.append(found)
                nodes.append(node)
                if len(waiting) >= BATCH or sum(map(len, waiting[-8:])) > 100_000:
                    yield from flush()
        if waiting:
            yield from flush()

    return docs.mapInArrow(signed, out)


def _shared(signed: DataFrame) -> DataFrame:
    """Pairs (a, b) to compare, and the members (run, a) of large runs of sets with one signature."""
    out = T.StructType.fromDDL("run long, a long, b long")

    def find(key: tuple, blobs: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(out)
        codes, nodes = [], []
        for blob in blobs:
            codes += [np.frombuffer(x.as_buffer(), np.uint32) for x in blob.column("codes")]
            nodes += [np.frombuffer(x.as_buffer(), np.int64) for x in blob.column("nodes")]
        code, node = np.concatenate(codes), np.concatenate(nodes)
        order = np.argsort(code, kind="stable")
        code, node = code[order], node[order]
        again = np.flatnonzero(code[1:] == code[:-1])
        inside = np.zeros(len(code), bool)
        inside[again] = inside[again + 1] = True
        code, node = code[inside], node[inside]
        order = np.lexsort((node, code))
        code, node = code[order], node[order]
        new = np.ones(len(code), bool)
        new[1:] = (code[1:] != code[:-1]) | (node[1:] != node[:-1])
        code, node = code[new], node[new]
        start = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else []
        length = np.diff(np.append(start, len(code))).astype(np.int64)
        start = np.asarray(start, np.int64)
        left, right = [], []
        for size in range(2, SMALL_RUN + 1):
            grid = node[start[length == size][:, None] + np.arange(size)]
            for i in range(size):
                for j in range(i + 1, size):
                    left.append(grid[:, i])
                    right.append(grid[:, j])
        large = np.flatnonzero(length > SMALL_RUN)
        runs, members = [], []
        for r in large:
            own = node[start[r] : start[r] + length[r]]
            # One of three orders of the nodes, so that a set meets several hubs.
            hub = own[np.argmin(mixed(own.view(U) + U(int(code[start[r]]) % 3) * GOLDEN))]
            others = own[own != hub]
            left.append(np.minimum(others, hub))
            right.append(np.maximum(others, hub))
            runs.append(np.full(len(own), key[0].as_py() << 32 | int(code[start[r]]), np.int64))
            members.append(own)
        if left:
            pairs = np.unique(np.stack([np.concatenate(left), np.concatenate(right)]), axis=1)
            yield from _rows(schema, np.full(pairs.shape[1], -1), pairs[0], pairs[1])
        if members:
            run, member = np.concatenate(runs), np.concatenate(members)
            yield from _rows(schema, run, member, np.zeros(len(run), np.int64))

    def in_bucket(key: tuple, blobs: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return find(key, blobs)

    return signed.groupBy("bucket").applyInArrow(in_bucket, out)


def _rows(schema: pa.Schema, run, a, b) -> Iterator[pa.RecordBatch]:
    columns = [pa.array(x, pa.int64()) for x in (run, a, b)]
    yield from pa.table(columns, schema=schema).to_batches(max_chunksize=100_000)


def _perhaps_in(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """The texts without most of those whose node is not among ``nodes``, before a join shuffles them.

    A node sets one of 2^22 bits, and texts whose bit is not set leave. No more than ``FILTER_WORDS`` words
    are broadcast, however many nodes there are; with more nodes more of the other texts pass. Join the rest
    by an inner join: Spark moves a semi join before the filter.
    """
    word, bit = F.col("node").bitwiseAND(FILTER_WORDS - 1), F.shiftrightunsigned("node", 58).cast("int")
    masks = F.array(*[F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)])
    bits = nodes.groupBy(word.alias("_word")).agg(F.bit_or(F.get(masks, bit)).alias("_bits"))
    found = texts.join(F.broadcast(bits), word == F.col("_word"))
    return found.filter(F.getbit("_bits", bit) == 1).select(*texts.columns)


def _verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar; ``texts`` has each of their nodes once."""
    sides = [
        texts.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in ("n", *SKETCH)])
        for side in "ab"
    ]
    possible = pairs.join(sides[0], "a").join(sides[1], "b")
    columns = [[F.col(f"{c}_{side}") for c in ("n", *SKETCH)] for side in "ab"]
    possible = written(
        possible.filter(_may_be_similar(*columns, percent)).select("a", "b"), "join-possible"
    )
    compared = _perhaps_in(
        texts.select("node", "packed"), possible.select(F.explode(F.array("a", "b")).alias("node"))
    )
    left = compared.select(F.col("node").alias("a"), F.col("packed").alias("t_a"))
    right = compared.select(F.col("node").alias("b"), F.col("packed").alias("t_b"))
    out = T.StructType.fromDDL("a long, b long")

    def compare(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress

        @lru_cache(maxsize=64)
        def set_of(packed: bytes) -> np.ndarray:
            return shingles(unpack(packed).decode(), words)

        for batch in rows:
            good = [
                similar(set_of(x.as_py()), set_of(y.as_py()), percent)
                for x, y in zip(batch.column("t_a"), batch.column("t_b"))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).filter(pa.array(good, pa.bool_())) for c in ("a", "b")], names=["a", "b"]
            )

    return possible.join(left, "a").join(right, "b").mapInArrow(compare, out)


def _shared_shingles(texts: DataFrame, words: int, buckets: int) -> DataFrame:
    """(node, n_shared): the most shingles of each set that another of these sets has too.

    Shingles meet by their bucket and 32 bits; where two different ones agree in them, the count is
    too large, never too small.
    """
    out = T.StructType.fromDDL("bucket int, codes binary, nodes binary")

    def dealt(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(out)
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in rows:
            sets = [shingles(unpack(x.as_py()).decode(), words) for x in batch.column("packed")]
            nodes = np.repeat(batch.column("node").to_numpy(), [len(s) for s in sets])
            codes = np.concatenate(sets) if sets else np.empty(0, U)
            yield from _by_bucket(codes, nodes, buckets, schema)

    def count(table: pa.Table) -> pa.Table:
        codes = np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in table["codes"]])
        nodes = np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in table["nodes"]])
        _, of, times = np.unique(codes, return_inverse=True, return_counts=True)
        found, n = np.unique(nodes[times[of] > 1], return_counts=True)
        return pa.table({"node": found, "n": n})

    parts = texts.select("node", "packed").mapInArrow(dealt, out)
    return (
        parts.groupBy("bucket")
        .applyInArrow(count, "node long, n long")
        .groupBy("node")
        .agg(F.sum("n").alias("n_shared"))
    )


def _by_bucket(
    codes: np.ndarray, nodes: np.ndarray, buckets: int, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    """The lower half of each code with its node, packed by the bucket that the upper half names.

    In a bucket the codes of a node lie together, so that the repeated nodes take little room.
    """
    place = ((codes >> U(32)) * U(buckets)) >> U(32)
    order = np.lexsort((nodes, place))
    place, codes, nodes = place[order], codes[order].astype(np.uint32), nodes[order].astype(np.int64)
    edges = [0, *(np.flatnonzero(np.diff(place)) + 1).tolist(), len(codes)] if len(codes) else [0]
    yield pa.RecordBatch.from_pydict(
        {
            "bucket": [int(place[a]) for a in edges[:-1]],
            "codes": [codes[a:b].tobytes() for a, b in zip(edges, edges[1:])],
            "nodes": [nodes[a:b].tobytes() for a, b in zip(edges, edges[1:])],
        },
        schema=schema,
    )


def _in_question(still: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The members (run, node, component) that may still be similar to one of another component.

    A set can only have in common with others what it shares with any of them. Members that share
    too little for the smallest set of the run leave it, runs with one component left are done, and
    as those that stay share less without the others, this is repeated while many leave.
    """
    nodes = still.select("node")
    held = written(_perhaps_in(texts, nodes).join(nodes.distinct(), "node"), "join-held")
    buckets = max(8, (held.agg(F.sum("n")).first()[0] or 0) // PER_BUCKET)
    left = still.count()
    while left:
        of_open = held.join(still.select("node").distinct(), "node", "left_semi")
        counts = _shared_shingles(of_open, words, buckets)
        sized = still.join(held.select("node", "n").join(counts, "node"), "node")
        least = sized.groupBy("run").agg(F.min("n").alias("least"))
        # Sets of x and y shingles that are similar have at least percent / (100 + percent) of x + y.
        smallest = F.greatest("least", F.ceil(F.col("n") * percent / 100))
        able = sized.join(least, "run").filter(
            (100 + percent) * F.col("n_shared") >= percent * (F.col("n") + smallest)
        )
        able = able.select("run", "node", "component")
        still = written(able.join(_mixed_runs(able), "run", "left_semi"), "join-open")
        before, left = left, still.count()
        if left > 0.9 * before:  # the rest is compared in full
            break
    return still


def _mixed_runs(members: DataFrame) -> DataFrame:
    return (
        members.groupBy("run")
        .agg(F.min("component").alias("first"), F.max("component").alias("last"))
        .filter("first < last")
        .select("run")
    )


def components(links: DataFrame) -> DataFrame:
    """(node, component) of the nodes of links (a, b); a component is called by its smallest node.

    Each round moves every node to the smallest of its neighbours and itself, follows that once more
    and contracts the links. Of the nodes that still have links at least half go, each round.
    """
    links = written(links, "links")
    labels = written(
        links.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("component", F.col("node")),
        "labels",
    )
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = written(
            both.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("to")), "steps"
        )
        jump = step.select(F.col("a").alias("to"), F.col("to").alias("further"))
        step = written(
            step.join(jump, "to", "left").select("a", F.coalesce("further", "to").alias("to")), "steps"
        )
        labels = written(
            labels.join(step, F.col("component") == F.col("a"), "left").select(
                "node", F.coalesce("to", "component").alias("component")
            ),
            "labels",
        )
        links = written(
            links.join(step, "a")
            .select(F.col("to").alias("from_a"), "b")
            .join(step, F.col("b") == F.col("a"))
            .select(F.least("from_a", "to").alias("a"), F.greatest("from_a", "to").alias("b"))
            .filter("a < b")
            .distinct(),
            "links",
        )
    return labels


@tidy
def join_components(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    carry: Sequence[str] = ("doc_id",),
    words: int = WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """One row per document: row (the carried columns), n_shingles, component_id, leader.

    Documents link when the Jaccard similarity of their shingle sets is at least ``percent`` / 100;
    ``component_id`` is the smallest id reachable by links, and ``leader`` marks one row of each
    component, of those with that id. A null or empty text has no shingle, links with nothing and
    leads itself. A missing id never names a component that has another one. Repeated rows are
    equal sets. An empty table gives an empty one; columns that are not carried do not matter.
    """
    spark = docs.sparkSession
    read = docs.select(
        F.struct(*carry).alias("row"), F.col(key).alias("id"), F.col(text).alias("text")
    )
    prepared = written(_prepared(read, docs.schema[key].dataType, words), "join-sets")
    total = prepared.filter("packed is not null").agg(F.sum("n")).first()[0] or 0
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(4 * parts, total // PER_BUCKET)
    shared = written(_shared(_signed(read.select("text"), words, percent, buckets)), "join-shared")
    texts = prepared.filter("packed is not null").select("node", "n", "packed", *SKETCH)
    pairs = written(shared.filter("run = -1").select("a", "b").distinct(), "join-pairs")
    members = shared.filter("run <> -1").select("run", F.col("a").alias("node"))
    # The texts that are compared, fetched once.
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node"))
    wanted = written(ends.unionByName(members.select("node")).distinct(), "join-wanted")
    texts = _perhaps_in(texts, wanted).join(wanted, "node")
    texts = written(texts.dropDuplicates(["node"]), "join-texts")
    links = written(_verified(pairs, texts, words, percent), "join-links")
    labels = components(links)
    named = members.join(labels, "node", "left").select(
        "run", "node", F.coalesce("component", "node").alias("component")
    )
    still = written(named.join(_mixed_runs(named), "run", "left_semi"), "join-open")
    still = _in_question(still, texts, words, percent)
    if not still.isEmpty():
        still = written(still.join(texts.drop("packed"), "node"), "join-open")
        other = still.select(
            F.col("run").alias("of_run"),
            F.col("node").alias("other"),
            F.col("component").alias("of_other"),
            *[F.col(c).alias(f"{c}_other") for c in ("n", *SKETCH)],
        )
        columns = [[F.col(f"{c}{end}") for c in ("n", *SKETCH)] for end in ("", "_other")]
        across = written(
            still.join(
                other,
                (F.col("run") == F.col("of_run"))
                & (F.col("component") < F.col("of_other"))
                & _may_be_similar(*columns, percent),
            )
            .select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
            .distinct()
            .join(pairs, ["a", "b"], "left_anti"),
            "join-across",
        )
        links = links.unionByName(_verified(across, texts, words, percent))
        labels = components(links)
    grouped = prepared.drop("packed", *SKETCH).join(labels, "node", "left").withColumn(
        "of", F.coalesce("component", "node")
    )
    order = F.struct(F.col("id").isNull().alias("missing"), "id", "uid")
    leaders = grouped.filter("of is not null").groupBy("of").agg(F.min(order).alias("first"))
    return grouped.join(leaders, "of", "left").select(
        "row",
        F.col("n").alias("n_shingles"),
        F.when(F.col("of").isNull(), F.col("id")).otherwise(F.col("first.id")).alias("component_id"),
        F.coalesce(F.col("first.uid") == F.col("uid"), F.lit(True)).alias("leader"),
    )
