"""Count tokens, with huge documents encoded as overlapping chunks that are spliced again.

A document longer than a chunk is cut into chunks that overlap, which are dealt out and encoded with
offsets wherever they land. Two neighbours are spliced at a place in their overlap where both have a
token boundary and which is *proven* stable: the text after it has the same tokens whatever comes
before. Where an overlap holds no such place, it is widened, in the end over whole neighbours, and only
these chunks are encoded again.

The proof of a place rests on the vocabulary and on the classes of the two characters beside it. No
entry of the vocabulary has the two symbols next to each other inside it (bytes for byte-level merges,
characters for pieces), so no merge ever joins them. Besides, either the right one is white space and the
left one is not, or both are letters in normal form: there the division into words before any merge does
not depend on how far the text goes back. Supported are byte-level BPE in ``.json`` files of the tokenizers
library whose words hold no inner white space, and sentencepiece models without normalisation.
"""

from __future__ import annotations

import itertools
import os
import unicodedata
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Tokenizer

from quarryline.llm.common import written

CHUNK = 32_768  # characters of a chunk; longer documents are cut
OVERLAP = 1_024  # characters that neighbours share at first
WIDER = 8  # an overlap without a stable place grows by this factor
PLACES = 4  # stable places told about an overlap
WHITE = " \t\n\x0b\x0c\r"
WORD_END = "</w>"
META = "▁"  # stands for a blank in the vocabulary of sentencepiece
BATCH_CHARS = 1 << 18
KNOWN_WORDS, KNOWN_BYTES = 500_000, 64  # words whose counts a worker remembers twice over, and their length


def _byte_symbols() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable Latin-1 ones for
    themselves, the other bytes in their order from code point 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class _JsonEncoder:
    """A file of the tokenizers library: offsets count characters."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        symbols = _byte_symbols()
        special = self.tokenizer.get_added_tokens_decoder()
        self.specials = [t.content for t in special.values()]
        self.joined: set[tuple[int, int]] = set()
        for entry, number in self.tokenizer.get_vocab().items():
            if number not in special:
                data = [symbols[c] for c in entry.removesuffix(WORD_END)]
                self.joined.update(zip(data, data[1:]))
        white = set(WHITE.encode())
        self.apart = not white & {b for pair in self.joined for b in pair} and not self._count([WHITE])[0]
        self.known: dict[bytes, int] = {}
        self.older: dict[bytes, int] = {}

    def _count(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def count(self, texts: list[str]) -> list[int]:
        """Where white space has no tokens and joins nothing, all places beside it are stable: a text
        has the tokens of its words, and the library is asked once for words that come again."""
        if not self.apart:
            return self._count(texts)
        split = [t.encode().split() for t in texts]
        if len(self.known) > KNOWN_WORDS:  # words that did not come again since are forgotten
            self.known, self.older = {}, self.known
        missing = {w for w in itertools.chain(*split) if w not in self.known}
        again = {w: self.older[w] for w in missing if w in self.older}
        new = list(missing - again.keys())
        self.known.update(again)
        self.known.update(zip(new, self._count([w.decode() for w in new])))
        numbers = [sum(map(self.known.__getitem__, words)) for words in split]
        for word in new:
            if len(word) > KNOWN_BYTES:
                del self.known[word]
        return numbers

    def bounds(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        found = self.tokenizer.encode(text, add_special_tokens=False).offsets
        both = np.array(found, np.int64).reshape(-1, 2)
        return both[:, 0], both[:, 1]

    def never_joined(self, left: str, right: str) -> bool:
        return all(
            (a.encode()[-1], b.encode()[0]) not in self.joined
            for a, b in ((left, right), (left.lower(), right.lower()))
        )


class _PieceEncoder:
    """A sentencepiece model: offsets count bytes and are turned into characters."""

    specials: list[str] = []

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        entries = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.joined = {pair for entry in entries for pair in zip(entry, entry[1:])}

    def count(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.model.encode(texts, num_threads=1)]

    def bounds(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        data = np.frombuffer(text.encode(), np.uint8)
        chars = np.flatnonzero((data & 0xC0) != 0x80)  # where each character begins
        pieces = self.model.encode(text, return_type="proto").pieces
        ends = [np.array([getattr(p, side) for p in pieces], np.int64) for side in ("begin", "end")]
        return np.searchsorted(chars, ends[0], "right") - 1, np.searchsorted(chars, ends[1], "left")

    def never_joined(self, left: str, right: str) -> bool:
        return (left, META if right == " " else right) not in self.joined


@lru_cache(maxsize=2)
def encoder(path: str) -> _JsonEncoder | _PieceEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return _PieceEncoder(path) if path.endswith(".model") else _JsonEncoder(path)


@lru_cache(maxsize=1)
def _joining() -> frozenset[str]:
    """Characters that may merge with one before them in the canonical composed form."""
    pairs = (unicodedata.decomposition(chr(c)).split() for c in range(0x110000))
    seconds = {chr(int(p[1], 16)) for p in pairs if len(p) == 2 and not p[0].startswith("<")}
    jamo = {chr(c) for low, high in ((0x1161, 0x1176), (0x11A8, 0x11C3)) for c in range(low, high)}
    return frozenset(seconds | jamo)


def _normal(left: str, right: str) -> bool:
    """Neither character changes, joins the other or joins what lies before it when composed."""
    return (
        not any(unicodedata.combining(c) or c in _joining() for c in (left, right))
        and unicodedata.is_normalized("NFC", left + right)
    )


def stable_places(known: _JsonEncoder | _PieceEncoder, text: str, low: int, high: int) -> list[int]:
    """The first places from ``low`` to ``high`` before which no token and no proof reaches back."""
    found: list[int] = []
    for place in range(max(low, 1), min(high, len(text))):
        left, right = text[place - 1], text[place]
        if not (right in WHITE and left not in WHITE or left.isalpha() and right.isalpha()):
            continue
        if not known.never_joined(left, right) or not _normal(left, right):
            continue
        if any(_covers(text, s, place) for s in known.specials):
            continue
        found.append(place)
        if len(found) == PLACES:
            break
    return found


def _covers(text: str, special: str, place: int) -> bool:
    """The special string lies on both sides of the place."""
    reach = len(special) - 1
    return special in text[max(0, place - reach) : place + reach]


def count_tokens(
    docs: DataFrame,
    tokenizer: str,
    text: str = "text",
    carry: Sequence[str] = ("doc_id",),
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """(row, n_bytes, n_tokens): as many tokens as the library gives for the whole text.

    ``row`` holds the carried columns (which must be groupable; names may clash with any used here),
    ``n_bytes`` the text's bytes in UTF-8. A null text counts as the empty one, which has no tokens;
    repeated rows come back as often; missing ids are kept; an empty table gives an empty one. Texts up to
    a chunk are encoded where they are read, longer ones never within one task, unless a text has no
    stable place at all. Neither begin nor end nor padding is added; strings of special tokens inside a
    text are what the library takes them for.
    """
    if not 0 < overlap <= chunk:
        raise ValueError("the overlap is between one character and a chunk")
    value = F.coalesce(F.col(text), F.lit(""))
    read = docs.select(F.struct(*carry).alias("row"), value.alias("text"))
    read = read.withColumn("n_bytes", F.octet_length("text").cast("long"))
    row = read.schema["row"]
    long = read.filter(F.length("text") > chunk).withColumn("key", F.xxhash64("text"))
    short = read.filter(F.length("text") <= chunk).mapInArrow(_counter(tokenizer, row), _schema(row, COUNTED))
    last = F.ceil(F.length("text") / chunk).cast("int") - 1
    piece = lambda n: F.struct(
        n.alias("no"), n.alias("last"), F.lit(overlap).alias("left"), F.lit(overlap).alias("right")
    )
    first = long.withColumn("pieces", F.transform(F.sequence(F.lit(0), last), piece))
    found = written(_encoded(first, tokenizer, row, chunk), "token-chunks")
    while True:
        state = _spliced(found)
        again = F.col("fails") | F.coalesce(F.lag("fails").over(_order()), F.lit(False))
        marked = state.withColumn("again", again)
        if not marked.filter("again").take(1):
            break
        found = written(_widened(marked, long, tokenizer, row, chunk, overlap), "token-chunks")
    share = F.coalesce(
        F.element_at(F.map_from_arrays("right_at", "right_before"), F.col("place")), F.col("n")
    ) - F.coalesce(F.element_at(F.map_from_arrays("left_at", "left_before"), F.col("start")), F.lit(0))
    whole = (
        state.withColumn("start", F.lag("place").over(_order()))
        .groupBy("row", "key")
        .agg(
            F.first("n_bytes").alias("n_bytes"),
            F.sum(share).alias("n_tokens"),
            F.max("copies").alias("copies"),
        )
        .select("row", "n_bytes", "n_tokens", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    )
    return short.unionByName(whole.select("row", "n_bytes", "n_tokens"))


COUNTED = "n_bytes long, n_tokens long"
PIECE = "key long, n_bytes long, no int, last int, left int, right int"
FACTS = "n long, left_at array<long>, left_before array<long>, right_at array<long>, right_before array<long>"


def _order():
    """The chunks of a text one after another."""
    return Window.partitionBy("row", "key").orderBy("no")


def _schema(row: T.StructField, more: str) -> T.StructType:
    return T.StructType([row, *T.StructType.fromDDL(more).fields])


def _counter(tokenizer: str, row: T.StructField):
    """Counts whole texts, some hundred thousand characters at a time."""
    schema = to_arrow_schema(_schema(row, COUNTED))

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(tokenizer)
        for batch in rows:
            numbers: list[int] = []
            waiting: list[str] = []
            size = 0
            for value in batch.column("text"):
                waiting.append(value.as_py())
                size += len(waiting[-1])
                if size >= BATCH_CHARS:
                    numbers += known.count(waiting)
                    waiting, size = [], 0
            numbers += known.count(waiting)
            columns = [batch.column("row").cast(schema.field("row").type), batch.column("n_bytes")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(numbers, pa.int64())], schema=schema)

    return count


def _cutter(row: T.StructField, chunk: int):
    """The wanted chunks of each text, each with the overlap to its right."""
    schema = to_arrow_schema(_schema(row, f"{PIECE}, text string"))

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                text = one.column("text")[0].as_py()
                pieces = one.column("pieces")[0].as_py()
                for at in range(0, len(pieces), 64):
                    part = pieces[at : at + 64]
                    same = pa.array([0] * len(part), pa.int64())
                    columns = [one.column(n).take(same) for n in ("row", "key", "n_bytes")]
                    columns[0] = columns[0].cast(schema.field("row").type)
                    columns += [
                        pa.array([p[n] for p in part], pa.int32()) for n in ("no", "last", "left", "right")
                    ]
                    ends = [(p["no"] * chunk, (p["last"] + 1) * chunk + p["right"]) for p in part]
                    columns.append(pa.array([text[a:b] for a, b in ends], schema.field("text").type))
                    yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return cut


def _teller(tokenizer: str, row: T.StructField, chunk: int):
    """Encodes chunks; says how many tokens lie before the stable places of both overlaps."""
    schema = to_arrow_schema(_schema(row, f"{PIECE}, {FACTS}"))
    names = T.StructType.fromDDL(FACTS).names

    def tell(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(tokenizer)
        for batch in rows:
            facts: dict[str, list] = {f: [] for f in names}
            for text, no, last, left, right in zip(
                *(batch.column(c).to_pylist() for c in ("text", "no", "last", "left", "right"))
            ):
                begin, after = no * chunk, (last + 1 - no) * chunk
                starts, ends = known.bounds(text)
                facts["n"].append(len(starts))
                for side, low, wide in (("left", 0, left if no else 0), ("right", after, right)):
                    # a place counts where the tokens beside it meet there
                    at = stable_places(known, text, low + 1, low + wide)
                    before = np.searchsorted(starts, at, "left").tolist()
                    met = [(p, b) for p, b in zip(at, before) if not b or ends[b - 1] <= p]
                    facts[f"{side}_at"].append([begin + p for p, _ in met])
                    facts[f"{side}_before"].append([b for _, b in met])
            columns = [batch.column(n).cast(schema.field(n).type) for n in schema.names[:7]]
            columns += [pa.array(facts[n], schema.field(n).type) for n in facts]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return tell


def _encoded(long: DataFrame, tokenizer: str, row: T.StructField, chunk: int) -> DataFrame:
    """One line per chunk of each different long text, with the number of its copies."""
    parts = int(long.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = long.select("row", "key", "n_bytes", "text", "pieces").mapInArrow(
        _cutter(row, chunk), _schema(row, f"{PIECE}, text string")
    )
    # Chunks go where there is room: the parts of one document to many tasks.
    dealt = cut.repartition(parts, "key", "no")
    told = dealt.mapInArrow(_teller(tokenizer, row, chunk), _schema(row, f"{PIECE}, {FACTS}"))
    rest = [c for c in told.columns if c not in ("row", "key", "no")]
    return (
        told.groupBy("row", "key", "no")
        .agg(F.first(F.struct(*rest)).alias("rest"), F.count(F.lit(1)).alias("copies"))
        .select("row", "key", "no", "rest.*", "copies")
    )


def _spliced(found: DataFrame) -> DataFrame:
    """The first place that a chunk and the next have in common, and whether there is none."""
    common = F.array_intersect("right_at", F.lead("left_at").over(_order()))
    return found.withColumn("place", F.array_min(common)).withColumn(
        "fails", F.lead("no").over(_order()).isNotNull() & F.col("place").isNull()
    )


def _widened(
    marked: DataFrame, long: DataFrame, tokenizer: str, row: T.StructField, chunk: int, overlap: int
) -> DataFrame:
    """Chunks beside a failed splice encoded again with a wider overlap; the others as they are.

    An overlap that already covers the next chunk takes it in, so every splice is found in the end.
    """
    absorbs = F.col("fails") & (F.col("right") >= chunk)
    own = F.coalesce(F.lag(absorbs).over(_order()), F.lit(False))
    wider = marked.select(
        "*",
        F.when(F.col("fails"), F.least(F.lit(chunk), F.col("right") * WIDER)).otherwise(F.col("right")).alias("wide"),
        F.sum(F.when(own, 0).otherwise(1)).over(_order()).alias("unit"),
    ).withColumn("reach", F.coalesce(F.lag("wide").over(_order()), F.lit(overlap)))
    units = (
        wider.filter("again")
        .groupBy("row", "key", "unit")
        .agg(
            F.struct(
                F.min("no").alias("no"),
                F.max("last").alias("last"),
                F.min_by("reach", "no").alias("left"),
                F.max_by("wide", "no").alias("right"),
            ).alias("piece"),
        )
        .groupBy("row", "key")
        .agg(F.collect_list("piece").alias("pieces"))
        .toDF("row_", "key_", "pieces")
    )
    same = F.col("row").eqNullSafe(F.col("row_")) & (F.col("key") == F.col("key_"))
    once_more = _encoded(long.join(units, same), tokenizer, row, chunk)
    kept = marked.filter(~F.col("again")).select(*once_more.columns)
    return kept.unionByName(once_more)
