"""SpotSigs fingerprints.

A spot signature is a common word (the anchor) with the chain of the next ``CHAIN`` content words,
``DISTANCE`` content words apart. Running prose is full of anchors, lists and menus are not, and a
changed passage changes only the signatures that reach into it. The start of a text is an anchor
too, so that every text with a word has a signature. So is one content word in ``SPOTS``, by its hash,
which lays signatures over lists, menus, code and languages without listed words as well; it stays a
content word of other chains. The fingerprint is the set of a text's signatures; likeness is the
Jaccard similarity of two sets.

Sizes alone bound the similarity: ``likeness`` with ``at_least`` compares no sets whose lengths cannot
reach it. ``with_edits`` returns every likeness, so it asks for no least one and prunes nothing; it
compares a document with its edit and its next one, and no partitions with each other.
``partition_of`` numbers the lengths so that sets that can reach a similarity lie in the same
partition or in neighbouring ones.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import math
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quarryline.llm.common import Remembered, mixed, words_of

CHAIN = 2
DISTANCE = 1
SIMILAR = 0.8
# Common words of four languages; they carry grammar rather than content.
ANCHORS = frozenset(
    """
    a an and are as at be by for from in is it of on or that the this to was were with
    das dem den der des die ein eine für im ist mit nicht sich und von zu
    au dans de du en est et la le les pas pour que qui sur un une
    con del el es los las no para por se su y
    """.encode().split()
)
U = np.uint64
GOLDEN = U(0x9E3779B97F4A7C15)
ANCHOR_BIT, SPOT_BIT = 1, 2
SPOTS = 4  # one content word in so many is an anchor
MARKS = b".,;:!?\"'()"
NO_LETTERS = re.compile(r"^[\W\d_]+|[\W\d_]+$")  # at the ends of a word


def _listed(word: bytes) -> bytes | None:
    """The common word that this one is, whatever its case and the marks and digits around it."""
    bare = NO_LETTERS.sub("", word.decode("utf-8", "surrogatepass").lower())
    bare = bare.encode("utf-8", "surrogatepass")
    return bare if bare in ANCHORS else None


class SpotHashes(Remembered):
    """62-bit hashes of words without marks around them; the lowest bits say common word and
    content word that is an anchor."""

    def __missing__(self, word: bytes) -> int:
        common = _listed(word)
        value = xxhash.xxh3_64_intdigest(common or word.strip(MARKS) or word)
        kind = ANCHOR_BIT if common else SPOT_BIT * (value % SPOTS == 0)
        return self.keep(word, value & ~(ANCHOR_BIT | SPOT_BIT) | kind)


SPOT_HASHES = SpotHashes()


def signatures(text: str | None, chain: int = CHAIN, distance: int = DISTANCE) -> np.ndarray:
    """Sorted 32-bit hashes of the distinct spot signatures."""
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint32)
    SPOT_HASHES.touch()
    hashes = np.empty(len(words) + 1, U)
    hashes[0] = ANCHOR_BIT
    hashes[1:] = np.fromiter(map(SPOT_HASHES.__getitem__, words), U, len(words))
    anchor = (hashes & U(ANCHOR_BIT)).astype(bool)
    content = hashes[~anchor]
    at = np.flatnonzero(hashes & U(ANCHOR_BIT | SPOT_BIT))
    following = np.cumsum(~anchor)[at]  # content words up to the anchor
    padded = np.concatenate([content, np.zeros(chain * distance + 1, U)])  # past the end: nothing
    code = hashes[at]
    for i in range(chain):
        code = mixed(code * GOLDEN + padded[np.minimum(following + i * distance, len(content))])
    # A common word with no content word after it says nothing, but for the start of a text.
    use = (following < len(content)) | ~anchor[at]
    use[0] = True
    if not len(content):  # only common words: their sequence is the signature
        code[0] = U(xxhash.xxh3_64_intdigest(b" ".join(words)))
    return np.unique((code[use] >> U(32)).astype(np.uint32))


def fingerprint(found: np.ndarray) -> str:
    """The signatures as text; the same for equal sets only."""
    return base64.b64encode(found.astype("<u4").tobytes()).decode()


def signatures_of(fingerprint_text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint_text), "<u4")


@lru_cache(maxsize=8)
def _edges(similarity: float, upto: int) -> list[int]:
    """The first length of each partition: the longest partner of a partition's first length, and
    one more, begins the next."""
    edges = [1]
    while edges[-1] <= upto:
        edges.append(int(edges[-1] / similarity + 1e-9) + 1)
    return edges


def partition_of(length: int, similarity: float = SIMILAR) -> int:
    """Sets that reach the similarity lie in the same or in neighbouring partitions."""
    upto = 1 << max(10, length.bit_length())
    return bisect.bisect_right(_edges(similarity, upto), length)


def likeness(a: np.ndarray, b: np.ndarray, at_least: float = 0.0) -> float:
    """Jaccard similarity of sorted sets; 0 if it is below ``at_least``, 1 for two empty sets."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if min(len(a), len(b)) < at_least * max(len(a), len(b)):
        return 0.0
    if at_least and abs(partition_of(len(a), at_least) - partition_of(len(b), at_least)) > 1:
        return 0.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    value = common / (len(a) + len(b) - common)
    return value if value >= at_least else 0.0


def edited(text: str, following: str) -> str:
    """The last half (rounded down) replaced by as much of the beginning of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _ranged(rows: DataFrame, bounds: Sequence) -> DataFrame:
    """The rows with the ``range`` of their id: how many bounds are not above it, 0 for a missing one."""
    splits = [-math.inf, *sorted({float(b) for b in bounds}), math.inf]
    if len(splits) < 3:
        return rows.withColumn("range", F.lit(0))
    finder = Bucketizer(splits=splits, inputCol="place", outputCol="found", handleInvalid="keep")
    found = finder.transform(rows.withColumn("place", F.col("id").cast("double")))
    place = F.when(F.col("id").isNull(), 0).otherwise(F.col("found").cast("int"))
    return found.withColumn("range", place).drop("place", "found")


def with_edits(
    docs: DataFrame, key: str = "doc_id", text: str = "text", carry: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """Fingerprints of each text, of its edited text, and how like they are.

    One row per document: row (the carried columns), n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next, partition. The next document is the one with the
    next smaller id, and the one with the largest id after the smallest; rows with one id are in
    the order of a hash of their text, a missing id is the smallest. A null or empty text has an empty
    fingerprint, and two empty ones are alike. A document alone is its own next. An empty table gives
    an empty one; columns that are not carried do not matter.

    Documents are dealt to ranges of ids and read in order there, so a text travels once. Each range
    also gets the last document of the range before.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    read = docs.select(
        F.struct(*carry).alias("row"),
        F.col(key).alias("id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).withColumn("tie", F.xxhash64("text"))
    share = [F.lit(i / parts) for i in range(1, parts)]
    bounds = docs.agg(F.percentile_approx(key, F.array(*share), 10_000)).first()[0] if share else []
    dealt = _ranged(read, bounds or [])
    last = dealt.groupBy("range").agg(F.max(F.struct("id", "tie")).alias("last"))
    by_range = Window.partitionBy(F.lit(0)).orderBy("range")  # one row for each range
    whole = by_range.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    borders = (
        last.withColumn("from", F.coalesce(F.lag("last").over(by_range), F.last("last").over(whole)))
        .select(F.col("range").alias("to"), "from.*")
        .select("to", F.col("id").alias("from_id"), F.col("tie").alias("from_tie"))
    )
    guests = (
        read.join(F.broadcast(borders), F.col("id").eqNullSafe(F.col("from_id")) & (F.col("tie") == F.col("from_tie")))
        .dropDuplicates(["to"])
        .select("row", "id", "text", "tie", F.col("to").alias("range"), F.lit(0).alias("own"))
    )
    ordered = (
        dealt.withColumn("own", F.lit(1))
        .unionByName(guests)
        .repartition(parts, "range")
        .sortWithinPartitions("range", "own", F.col("id").asc_nulls_first(), "tie")
        .select("row", "text", "own")
    )
    out = T.StructType(
        [
            docs.select(F.struct(*carry).alias("row")).schema["row"],
            *T.StructType.fromDDL(
                "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
                " near_edited double, near_next double, partition int"
            ).fields,
        ]
    )

    def compare(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(out)
        following, following_set = "", signatures("")
        for batch in rows:
            found: dict[str, list] = {n: [] for n in schema.names if n != "row"}
            own = np.array(batch.column("own").to_pylist(), dtype=bool)
            for is_own, value in zip(own, batch.column("text")):
                text = value.as_py()
                its = signatures(text)
                if is_own:
                    new = edited(text, following)
                    new_set = signatures(new)
                    found["n_chars"].append(len(text))
                    found["edited_sha256"].append(hashlib.sha256(new.encode()).hexdigest())
                    found["fingerprint"].append(fingerprint(its))
                    found["edited_fingerprint"].append(fingerprint(new_set))
                    found["near_edited"].append(likeness(its, new_set))
                    found["near_next"].append(likeness(its, following_set))
                    found["partition"].append(partition_of(len(its)) if len(its) else 0)
                following, following_set = text, its
            columns = [batch.column("row").filter(pa.array(own)).cast(schema.field("row").type)]
            columns += [pa.array(found[f.name], f.type) for f in list(schema)[1:]]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return ordered.mapInArrow(compare, out)
