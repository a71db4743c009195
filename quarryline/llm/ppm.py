"""Score texts by prediction by partial matching.

The model is a trie of byte contexts up to ``ORDER`` long, with counts of the symbols that followed
them in the training texts. A symbol is coded in the longest context seen before; if it did not occur
there, an escape leads to the context one shorter, in which the symbols of the longer one are excluded
because the escape has ruled them out. The escape is estimated from the different symbols of the
context: each gives it ``DISCOUNT`` of its count. After the shortest context all other symbols are
equally likely. The code length of a text is the sum over its bytes and its end. Texts are taken as
their words in lower case with one space between.

A pretrained model gives a symbol the same code length wherever the same ``ORDER`` bytes precede it. So
texts are worked on in blocks: a block lists its different (context, symbol) strings with their
training counts, the lists of all blocks meet by the end of the context, where the branches of the trie
lie complete, and each block gets back the code lengths of the strings it listed. Counts of words, for
the baseline, go the same way. What travels are different strings of blocks, never single bytes, and
neither trie nor vocabulary has to fit anywhere as a whole, but for the contexts of two bytes, which
are at most 2^24.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

from quarryline.llm.common import WORD_HASHES, mixed, tidy, words_of, written

ORDER = 5
DISCOUNT = 0.3  # what each different symbol of a context gives to its escape
SHARED_ORDER = 2  # contexts up to this length are known to all
BITS, END, START = 9, 256, 257  # symbols are bytes, the end, and what precedes a text
SYMBOLS = 257
BLOCK_BYTES = 6 << 20
END_TOKEN = np.uint64(0x9AE16A3B2F90404F)  # stands for the end among the hashes of words
WORDS, GRAMS, SHORT = 0, 1, 2


@dataclass(frozen=True)
class Level:
    """The trie's nodes with contexts of one length, in the order of their codes."""

    grams: np.ndarray  # context and symbol
    counts: np.ndarray
    contexts: np.ndarray
    totals: np.ndarray  # of each context
    kinds: np.ndarray  # different symbols of each context
    ruled_out: np.ndarray  # what its symbols count for in the context one shorter

    @staticmethod
    def of(grams: np.ndarray, counts: np.ndarray, length: int, lower: Level | None) -> Level:
        """From counts of strings at least that long; each string's end is what counts here."""
        grams, of = np.unique(grams & mask(length), return_inverse=True)
        counts = np.bincount(of, weights=counts, minlength=len(grams))
        contexts, of = np.unique(grams >> BITS, return_inverse=True)
        n = len(contexts)
        ruled_out = np.zeros(n)
        if lower is not None and n:
            shorter = lower.counts[np.searchsorted(lower.grams, grams & mask(length - 1))]
            ruled_out = np.bincount(of, weights=shorter, minlength=n)
        return Level(
            grams,
            counts,
            contexts,
            np.bincount(of, weights=counts, minlength=n),
            np.bincount(of, minlength=n).astype(float),
            ruled_out,
        )


def mask(length: int) -> int:
    return (1 << BITS * (length + 1)) - 1


def _place(sorted_values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the wanted values are, and whether they are there."""
    if not len(sorted_values):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(sorted_values, wanted), len(sorted_values) - 1)
    return at, sorted_values[at] == wanted


def levels_of(grams: np.ndarray, counts: np.ndarray, lengths: range, lower: Level | None) -> list[Level]:
    """Levels of the given lengths, ascending, on top of ``lower``."""
    found = []
    for length in lengths:
        lower = Level.of(grams, counts, length, lower)
        found.append(lower)
    return found


def log10_probabilities(grams: np.ndarray, levels: Sequence[Level]) -> np.ndarray:
    """Of the last symbol of each string, given the ones before it; levels from order 0 upwards."""
    value = np.zeros(len(grams))
    still = np.ones(len(grams), bool)  # not coded yet
    gone_total, gone_kinds = np.zeros(len(grams)), np.zeros(len(grams))  # excluded symbols
    for length in range(len(levels) - 1, -1, -1):
        level = levels[length]
        wanted = grams & mask(length)
        node, known = _place(level.contexts, wanted >> BITS)
        entry, seen = _place(level.grams, wanted)
        known &= still
        if known.any():
            total = level.totals[node] - gone_total
            kinds = level.kinds[node] - gone_kinds
            coded = known & seen
            value[coded] += np.log10((level.counts[entry[coded]] - DISCOUNT) / total[coded])
            # When all symbols of the context are excluded, the escape is certain and costs nothing.
            escaped = known & ~seen & (kinds > 0)
            value[escaped] += np.log10(DISCOUNT * kinds[escaped] / total[escaped])
            still &= ~coded
            gone_total = np.where(known, level.ruled_out[node], 0.0)
            gone_kinds = np.where(known, level.kinds[node], 0.0)
    rest = SYMBOLS - (len(levels[0].grams) if levels else 0)
    value[still] -= math.log10(max(rest, 1))
    return value


def gram_codes(streams: Sequence[bytes], order: int = ORDER) -> np.ndarray:
    """Codes of each byte of the texts, and of their ends, with the symbols before it."""
    pad = np.full(order, START, np.int16)
    end = np.array([END], np.int16)
    parts = []
    for stream in streams:
        parts += [pad, np.frombuffer(stream, np.uint8).astype(np.int16), end]
    symbols = np.concatenate(parts) if parts else np.empty(0, np.int16)
    n = max(len(symbols) - order, 0)
    codes = np.zeros(n, np.int64)
    for j in range(order + 1):
        codes <<= BITS
        codes |= symbols[j : j + n]
    return codes[symbols[order:] != START] if n else codes


@dataclass
class Block:
    """The texts of a block by what occurs in them."""

    sizes: np.ndarray  # symbols of each text
    of_gram: np.ndarray  # for each symbol, the place of its string
    grams: np.ndarray  # different strings
    tokens: np.ndarray  # tokens of each text
    of_word: np.ndarray
    words: np.ndarray  # hashes of different tokens

    @staticmethod
    def of(streams: Sequence[bytes], order: int) -> Block:
        of_gram, grams = pd.factorize(gram_codes(streams, order))
        split = [s.split() for s in streams]
        hashes = [np.append(WORD_HASHES.of(w), END_TOKEN) for w in split]
        of_word, words = pd.factorize(np.concatenate(hashes) if hashes else np.empty(0, np.uint64))
        return Block(
            np.array([len(s) + 1 for s in streams], np.int64),
            of_gram,
            grams,
            np.array([len(h) for h in hashes], np.int64),
            of_word,
            words,
        )

    def lists(self, parts: int, order: int) -> Iterator[tuple[int, int, np.ndarray]]:
        """(kind, part, places in the list of that kind), in a fixed order."""
        shown = self.grams >> BITS
        branch = mixed((shown & mask(SHARED_ORDER)).astype(np.uint64))
        for kind, keys, by in ((WORDS, self.words, self.words), (GRAMS, self.grams, branch)):
            part = (by % np.uint64(parts)).astype(np.int64)
            place = np.lexsort((keys, part))
            cuts = np.flatnonzero(np.diff(part[place])) + 1
            for own in np.split(place, cuts) if len(place) else []:
                yield kind, int(part[own[0]]), own


def _listed(docs: DataFrame, order: int, block_bytes: int, parts: int) -> DataFrame:
    """Texts (block, row, packed) and lists (block, kind, part, keys, counts) of the blocks."""
    out = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("row", docs.schema["row"].dataType),
            *T.StructType.fromDDL(
                "packed binary, kind int, part int, keys binary, counts binary"
            ).fields,
        ]
    )

    def listed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(out)
        pack = zstandard.ZstdCompressor(level=3).compress
        block = TaskContext.get().partitionId() << 33
        streams: list[bytes] = []
        learns: list[bool] = []

        def lists() -> Iterator[pa.RecordBatch]:
            found = Block.of(streams, order)
            learning = np.array(learns, bool)
            counts = {
                WORDS: _weights(found.of_word, found.tokens, learning, len(found.words)),
                GRAMS: _weights(found.of_gram, found.sizes, learning, len(found.grams)),
            }
            keys = {WORDS: found.words, GRAMS: found.grams}
            made = [
                (kind, part, keys[kind][own], counts[kind][own])
                for kind, part, own in found.lists(parts, order)
            ]
            short, of = np.unique(found.grams & mask(SHARED_ORDER), return_inverse=True)
            n = np.bincount(of, weights=counts[GRAMS], minlength=len(short)).astype(np.int64)
            part = (mixed(short.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
            made += [(SHORT, int(p), short[part == p], n[part == p]) for p in np.unique(part)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block] * len(made), pa.int64()),
                    pa.nulls(len(made), schema.field("row").type),
                    pa.nulls(len(made), pa.binary()),
                    pa.array([m[0] for m in made], pa.int32()),
                    pa.array([m[1] for m in made], pa.int32()),
                    pa.array([_packed(m[2].view(np.int64), ascending=True) for m in made], pa.binary()),
                    pa.array([_packed(m[3].astype(np.int64)) for m in made], pa.binary()),
                ],
                schema=schema,
            )

        size = 0
        for batch in rows:
            start = 0
            for i, (text, learn) in enumerate(zip(batch.column("text"), batch.column("learns").to_pylist())):
                stream = b" ".join(words_of(text.as_py()))
                streams.append(stream)
                learns.append(learn)
                size += len(stream) + 1
                if size >= block_bytes or i == batch.num_rows - 1:
                    n = i + 1 - start
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([block] * n, pa.int64()),
                            batch.column("row").slice(start, n).cast(schema.field("row").type),
                            pa.array([pack(s) for s in streams[len(streams) - n :]], pa.binary()),
                            *[pa.nulls(n, schema.field(c).type) for c in ("kind", "part", "keys", "counts")],
                        ],
                        schema=schema,
                    )
                    start = i + 1
                if size >= block_bytes:
                    yield from lists()
                    block, size = block + 1, 0
                    streams.clear()
                    learns.clear()
        if streams:
            yield from lists()

    return docs.mapInArrow(listed, out)


def _packed(values: np.ndarray, ascending: bool = False) -> bytes:
    """Numbers byte by byte, lowest bytes first, and compressed; ascending ones by their steps."""
    if ascending and len(values):
        values = np.diff(values, prepend=values.dtype.type(0))
    columns = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=3).compress(columns.tobytes())


def _unpacked(data: bytes, kind: type, ascending: bool = False) -> np.ndarray:
    columns = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    values = np.ascontiguousarray(columns.reshape(size, len(columns) // size).T).view(kind).ravel()
    return np.cumsum(values, dtype=kind) if ascending else values


def _weights(places: np.ndarray, sizes: np.ndarray, learning: np.ndarray, n: int) -> np.ndarray:
    """How often each entry occurs in the texts that are learned from."""
    return np.bincount(places[np.repeat(learning, sizes)], minlength=n).astype(np.int64)


def _keys(table: pa.Table) -> list[np.ndarray]:
    return [_unpacked(v.as_py(), np.int64, ascending=True) for v in table["keys"]]


def _counts(table: pa.Table) -> np.ndarray:
    return np.concatenate([_unpacked(v.as_py(), np.int64) for v in table["counts"]])


def _short_contexts(lists: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Strings of ``SHARED_ORDER`` + 1 symbols that were learned, with their counts: at most 2^25."""

    def merge(table: pa.Table) -> pa.Table:
        grams, of = np.unique(np.concatenate(_keys(table)), return_inverse=True)
        counts = np.bincount(of, weights=_counts(table))
        return pa.table({"gram": grams[counts > 0], "n": counts[counts > 0].astype(np.int64)})

    merged = (
        lists.filter(F.col("kind") == SHORT)
        .select("part", "keys", "counts")
        .groupBy("part")
        .applyInArrow(merge, "gram long, n long")
        .toPandas()
        .sort_values("gram")
    )
    return merged["gram"].to_numpy(np.int64), merged["n"].to_numpy(np.float64)


TOTALS = -1  # the block that gets the totals of the words
_RETURNED_ARROW = pa.schema(
    [
        ("block", pa.int64()),
        ("kind", pa.int32()),
        ("part", pa.int32()),
        ("entries", pa.binary()),
        ("tokens", pa.int64()),
        ("different", pa.int64()),
    ]
)


def _returned(lists: DataFrame, order: int, short: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(block, kind, part, entries): what each list asked for, in its order; for the block ``TOTALS``
    a line from each part of the words, with the training tokens and how many are different."""
    shared = lists.sparkSession.sparkContext.broadcast(short)

    def merge(table: pa.Table) -> pa.Table:
        kind = table["kind"][0].as_py()
        listed, counts = _keys(table), _counts(table)
        places, keys = pd.factorize(np.concatenate(listed))
        total = np.bincount(places, weights=counts, minlength=len(keys))
        if kind == WORDS:
            entries = total.astype(np.int64)
            tokens, different = int(entries.sum()), int((entries > 0).sum())
        else:
            low = levels_of(*shared.value, range(SHARED_ORDER + 1), None)
            learned = total > 0
            high = levels_of(
                keys[learned], total[learned], range(SHARED_ORDER + 1, order + 1), low[-1]
            )
            entries = log10_probabilities(keys, low + high).astype(np.float32)
            tokens = different = 0
        edges = np.cumsum([0, *map(len, listed)])
        made = {
            "block": table["block"].to_pylist(),
            "kind": table["kind"].to_pylist(),
            "part": table["part"].to_pylist(),
            "entries": [_packed(entries[places[a:b]]) for a, b in zip(edges, edges[1:])],
            "tokens": [0] * len(listed),
            "different": [0] * len(listed),
        }
        if kind == WORDS:
            for name, value in zip(made, (TOTALS, kind, made["part"][0], None, tokens, different)):
                made[name].append(value)
        return pa.table(
            [pa.array(made[f.name], f.type) for f in _RETURNED_ARROW], schema=_RETURNED_ARROW
        )

    return (
        lists.filter(F.col("kind") != SHORT)
        .select("block", "kind", "part", "keys", "counts")
        .groupBy("kind", "part")
        .applyInArrow(merge, from_arrow_schema(_RETURNED_ARROW))
    )


@tidy
def score(
    docs: DataFrame,
    learns: Column,
    text: str = "text",
    carry: Sequence[str] = ("doc_id",),
    order: int = ORDER,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document: row (the carried columns), n_tokens, n_known, train_tokens, base_score, score.

    ``learns`` marks the rows the model and the baseline learn from. A null or empty text has the
    end as its only token. With nothing to learn from, all symbols are equally likely and the
    baseline knows no token (its counts are 0 of 0; its score is 0). Repeated rows count as often as
    they occur. Texts are scored whole; a block has at least one. An empty table gives an empty one;
    columns that are not carried do not matter. Words are told apart by 64-bit hashes.
    """
    if not SHARED_ORDER < order or BITS * (order + 1) > 63:
        raise ValueError("a string of order + 1 symbols must fit 63 bits")
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    read = docs.select(
        F.struct(*carry).alias("row"), F.col(text).alias("text"), F.coalesce(learns, F.lit(False)).alias("learns")
    )
    listed = written(_listed(read, order, block_bytes, parts), "ppm-lists")
    lists = listed.filter("packed is null").drop("row", "packed")
    answers = _returned(lists, order, _short_contexts(lists))
    out = T.StructType(
        [
            T.StructField("row", read.schema["row"].dataType),
            *T.StructType.fromDDL("n_tokens long, n_known long, base double, score double").fields,
            *T.StructType.fromDDL("tokens long, different long").fields,
        ]
    )

    def totals(answers: pa.Table, schema: pa.Schema) -> pa.Table:
        sums = {n: sum(answers[n].to_pylist()) for n in ("tokens", "different")}
        return pa.table(
            [pa.array([sums.get(f.name)], f.type) for f in schema], schema=schema
        )

    def scored(texts: pa.Table, answers: pa.Table) -> pa.Table:
        schema = to_arrow_schema(out)
        if not len(texts):
            return totals(answers, schema)
        unpack = zstandard.ZstdDecompressor().decompress
        block = Block.of([unpack(p.as_py()) for p in texts["packed"]], order)
        entries = {
            (k, p): e.as_py()
            for k, p, e in zip(answers["kind"].to_pylist(), answers["part"].to_pylist(), answers["entries"])
        }
        lengths = np.zeros(len(block.grams), np.float32)
        seen = np.zeros(len(block.words), np.int64)
        for kind, part, own in block.lists(parts, order):
            if kind == GRAMS:
                lengths[own] = _unpacked(entries[kind, part], np.float32)
            else:
                seen[own] = _unpacked(entries[kind, part], np.int64)
        base = np.log10(seen + 0.1)
        first = np.cumsum(block.sizes) - block.sizes
        first_token = np.cumsum(block.tokens) - block.tokens
        known = (seen > 0).astype(np.int64)
        nothing = pa.nulls(len(block.tokens), pa.int64())
        return pa.table(
            [
                texts["row"].combine_chunks().cast(schema.field("row").type),
                pa.array(block.tokens),
                pa.array(np.add.reduceat(known[block.of_word], first_token)),
                pa.array(np.add.reduceat(base[block.of_word], first_token)),
                pa.array(np.add.reduceat(lengths[block.of_gram], first, dtype=np.float64)),
                nothing,
                nothing,
            ],
            schema=schema,
        )

    texts = listed.filter("packed is not null").select("block", "row", "packed")
    done = written(
        texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(scored, out), "ppm-scored"
    )
    # The totals are known with the last block; in the baseline they are the same for all tokens.
    of_words = done.filter("tokens is not null").select("tokens", "different").first()
    train_tokens, different = of_words or (0, 0)
    every = F.lit(float(np.log10(train_tokens + 0.1 * (different + 1)))) if train_tokens else None
    base = F.lit(0.0) if every is None else F.col("base") - F.col("n_tokens") * every
    return done.filter("tokens is null").select(
        "row",
        "n_tokens",
        "n_known",
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        "score",
    )
