"""Exact deduplication by Grace hashing.

Each input task first folds its own copies, so that a text leaves it once, however many rows hold it.
These records are partitioned by a hash of their content; a bucket is read once into an
open-addressing table that compares complete texts. When the table has no room, records that are
not in it are spilled to the shared folder, and the next round partitions the spilled ones again,
by another hash, until nothing is spilled. Memory is bounded by the table, not by the bucket, and
a text that fills a bucket with copies takes the room of one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quarryline.llm.common import SPACE, tidy, written

ROOM = 32 << 20  # bytes of text that a table holds
ROWS_OUT = 2_000


class Table:
    """Open addressing with linear probing; entries are equal when their whole content is."""

    def __init__(self, room: int):
        self.room = room
        self.slots = [-1] * 1024
        self.digests: list[bytes] = []
        self.contents: list[bytes] = []
        self.used = 0

    def find(self, digest: bytes, content: bytes) -> tuple[int, int]:
        """(entry or -1, the slot where the search ended)."""
        mask = len(self.slots) - 1
        slot = int.from_bytes(digest[8:16], "little") & mask
        while (entry := self.slots[slot]) >= 0:
            if self.digests[entry] == digest and self.contents[entry] == content:
                return entry, slot
            slot = (slot + 1) & mask
        return -1, slot

    def has_room(self, content: bytes) -> bool:
        return not self.contents or self.used + len(content) <= self.room

    def add(self, digest: bytes, content: bytes, slot: int) -> int:
        self.slots[slot] = len(self.contents)
        self.digests.append(digest)
        self.contents.append(content)
        self.used += len(content) + 200  # what an entry takes besides
        if 2 * len(self.contents) > len(self.slots):
            self._grow()
        return len(self.contents) - 1

    def _grow(self) -> None:
        mask = 4 * len(self.slots) - 1
        self.slots = [-1] * (mask + 1)
        for entry, digest in enumerate(self.digests):
            slot = int.from_bytes(digest[8:16], "little") & mask
            while self.slots[slot] >= 0:
                slot = (slot + 1) & mask
            self.slots[slot] = entry


def normal_text(text: Column) -> Column:
    """White space runs become one space; null becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def _before(a: tuple, b: tuple) -> bool:
    """Whether (id, row) a comes before b; a missing id comes last."""
    return (a[0] is None, a[:1] if a[0] is not None else (), a[1]) < (
        b[0] is None,
        b[:1] if b[0] is not None else (),
        b[1],
    )


_RECORD = "rep long, best_id {id}, best long, n long, digest binary, text binary"


def _fold(docs: DataFrame, id_type: str, room: int) -> DataFrame:
    """Rows (uid, rep, row) for each document, and a record for each text of an input task."""
    out = T.StructType(
        [
            T.StructField("uid", T.LongType()),
            T.StructField("rep", T.LongType()),
            T.StructField("row", docs.schema["row"].dataType),
            *T.StructType.fromDDL(_RECORD.format(id=id_type)).fields[1:],
        ]
    )

    def fold(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(out)
        uid = TaskContext.get().partitionId() << 33
        table, groups = Table(room), []

        def records() -> Iterator[pa.RecordBatch]:
            for at in range(0, len(groups), ROWS_OUT):
                part = groups[at : at + ROWS_OUT]
                yield _batch(
                    schema,
                    len(part),
                    rep=[g[0] for g in part],
                    best_id=[g[1][0] for g in part],
                    best=[g[1][1] for g in part],
                    n=[g[2] for g in part],
                    digest=table.digests[at : at + ROWS_OUT],
                    text=table.contents[at : at + ROWS_OUT],
                )

        for batch in rows:
            reps, first = [], uid
            for doc_id, value in zip(batch.column("id").to_pylist(), batch.column("text")):
                content = value.as_py().encode()
                digest = hashlib.sha256(content).digest()
                entry, slot = table.find(digest, content)
                if entry < 0:
                    if not table.has_room(content):
                        yield from records()
                        table, groups = Table(room), []
                        slot = table.find(digest, content)[1]
                    table.add(digest, content, slot)
                    groups.append([uid, (doc_id, uid), 1])
                    reps.append(uid)
                else:
                    group = groups[entry]
                    group[2] += 1
                    if _before((doc_id, uid), group[1]):
                        group[1] = (doc_id, uid)
                    reps.append(group[0])
                uid += 1
            yield _batch(
                schema, len(reps), uid=list(range(first, uid)), rep=reps, row=batch.column("row")
            )
        yield from records()

    return docs.mapInArrow(fold, out)


def _batch(schema: pa.Schema, rows: int, **columns) -> pa.RecordBatch:
    arrays = []
    for field in schema:
        values = columns.get(field.name)
        if values is None:
            arrays.append(pa.nulls(rows, field.type))
        elif isinstance(values, pa.Array):
            arrays.append(values.cast(field.type))
        else:
            arrays.append(pa.array(values, field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _resolve(records: DataFrame, id_type: str, room: int, level: int, buckets: int) -> DataFrame:
    """One round: (rep, keep_id, keep, group_size, digest), and the spilled records with their text."""
    out = T.StructType.fromDDL(
        f"{_RECORD.format(id=id_type)}, keep_id {id_type}, keep long, group_size long"
    )

    def resolve(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(out)
        table, groups = Table(room), []
        for batch in rows:
            spilled = []
            heads = zip(*[batch.column(c).to_pylist() for c in ("rep", "best_id", "best", "n", "digest")])
            for i, (rep, best_id, best, n, digest) in enumerate(heads):
                content = batch.column("text")[i].as_py()
                entry, slot = table.find(digest, content)
                if entry >= 0:
                    group = groups[entry]
                    group[0].append(rep)
                    group[2] += n
                    if _before((best_id, best), group[1]):
                        group[1] = (best_id, best)
                elif table.has_room(content):
                    table.add(digest, content, slot)
                    groups.append([[rep], (best_id, best), n])
                else:
                    spilled.append(i)
            if spilled:
                part = batch.take(pa.array(spilled, pa.int64()))
                yield _batch(
                    schema, len(spilled), **{n: part.column(n) for n in part.schema.names if n in schema.names}
                )
        for at in range(0, len(groups), ROWS_OUT):
            part = [(r, g, d) for g, d in zip(groups[at : at + ROWS_OUT], table.digests[at:]) for r in g[0]]
            yield _batch(
                schema,
                len(part),
                rep=[r for r, _, _ in part],
                digest=[d for _, _, d in part],
                keep_id=[g[1][0] for _, g, _ in part],
                keep=[g[1][1] for _, g, _ in part],
                group_size=[g[2] for _, g, _ in part],
            )

    def in_bucket(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return resolve(rows)

    bucket = F.pmod(F.xxhash64("digest", F.lit(level)), F.lit(buckets))
    return records.groupBy(bucket.alias("bucket")).applyInArrow(in_bucket, out)


@tidy
def deduplicate(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    carry: Sequence[str] = ("doc_id",),
    room: int = ROOM,
) -> DataFrame:
    """One row per document: row (the carried columns), keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after ``normal_text``. Of equal texts the row with the smallest
    id stays, a missing id coming last; of repeated rows one stays. ``text_sha256`` is that of the
    normalised text. A text larger than ``room`` has a table of its own. An empty table gives an
    empty one; columns that are not carried do not matter.
    """
    spark = docs.sparkSession
    id_type = docs.schema[key].dataType.simpleString()
    read = docs.select(
        F.struct(*carry).alias("row"), F.col(key).alias("id"), normal_text(F.col(text)).alias("text")
    )
    folded = written(_fold(read, id_type, room), "dedup-folded")
    records = folded.filter("text is not null").drop("uid", "row")
    found: DataFrame | None = None
    level = 0
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    while True:
        size = records.agg(F.sum(F.length("text"))).first()[0] or 0
        buckets = max(4 * parts, 2 * -(-size // room))
        done = written(_resolve(records, id_type, room, level, buckets), f"dedup-level-{level}")
        resolved = done.filter("text is null").select("rep", "keep_id", "keep", "group_size", "digest")
        found = resolved if found is None else found.unionByName(resolved)
        records = done.filter("text is not null").drop("keep_id", "keep", "group_size")
        if records.isEmpty():
            break
        level += 1
    return (
        folded.filter("text is null")
        .select("uid", "rep", "row")
        .join(found, "rep")
        .select(
            "row",
            "keep_id",
            "group_size",
            (F.col("uid") == F.col("keep")).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )
    )
