"""Group spelling variants: words one edit apart, found by pivotal bigrams.

Bigrams are ordered from rare to frequent. The prefix of a word is its first three bigrams in that order
(with all bigrams as rare as the third), its pivots are two of them that do not overlap, chosen by dynamic
programming for the least total frequency. One edit spoils at most one of two disjoint bigrams. So of two
words one edit apart, the one whose prefix ends earlier in the order has a pivot in the prefix of the
other, moved by no place if the words are equally long, or by at most the added character. Pivots are joined
with prefixes by bigram, length and place; the words of the pairs found are compared.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarryline.llm.common import batches, tidy, written

RUN = re.compile(r"[A-Za-zÀ-ÿ]+")
MIN_LENGTH, MIN_COUNT = 6, 5
FORM_RATIO = 5  # a form is at least so many times as frequent
DROP = 199  # runs whose checksum this number divides lose a character
GRAM = 2  # characters of a gram
PREFIX = 3  # grams, GRAM x edits + 1: any such number of places holds two disjoint ones
COUNTED_WORDS = 200_000  # different words a task holds before it passes their counts on


def _lost(checksum: int, run: str) -> str:
    """The run without one character, where the checksum says so."""
    if checksum % DROP:
        return run
    at = checksum % len(run)
    return run[:at] + run[at + 1 :]


def count_words(docs: DataFrame, key: str = "doc_id", text: str = "text", damage: bool = True) -> DataFrame:
    """(word, n): runs of letters in lower-case A-Z over whole texts, counted.

    With ``damage``, runs lose a character by the checksum of key and run (a missing key counts as no
    text before the colon). A null or empty text has no words.
    """
    read = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def told(found: Counter) -> Iterator[pa.RecordBatch]:
        yield from batches({"word": list(found), "n": list(found.values())}, schema, 50_000)

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in rows:
            for key, text in zip(batch.column("key"), batch.column("text")):
                # bytes are lowered in A-Z only
                runs = Counter(RUN.findall((text.as_py() or "").encode().lower().decode()))
                if not runs:
                    continue
                if damage:
                    start = zlib.crc32(f"{key.as_py() or ''}:".encode())
                    for run, n in runs.items():
                        found[_lost(zlib.crc32(run.encode(), start), run)] += n
                else:
                    found.update(runs)
                if len(found) > COUNTED_WORDS:
                    yield from told(found)
                    found.clear()
        yield from told(found)

    part = read.mapInArrow(count, "word string, n long")
    return part.filter(F.length("word") >= MIN_LENGTH).groupBy("word").agg(F.sum("n").alias("n"))


def pivots(ranks: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Two disjoint grams (frequency, gram, place) of a prefix with the least total frequency.

    Over the places in order: the cheapest single gram so far, and the cheapest pair that ends here.
    """
    places = sorted(ranks, key=lambda r: r[2])
    best: tuple | None = None
    single: list[tuple] = []  # cheapest gram among the first i places
    for i, gram in enumerate(places):
        ahead = sum(p[2] <= gram[2] - GRAM for p in places[:i])
        if ahead:
            pair = (single[ahead - 1][0] + gram[0], single[ahead - 1], gram)
            best = pair if best is None or pair < best else best
        single.append(min(single[-1], gram) if single else gram)
    return [best[1], best[2]]


def _gram_keys(word: str) -> list[int]:
    """A bigram as one number: its two code points side by side."""
    return [ord(a) << 16 | ord(b) for a, b in zip(word, word[1:])]


def _grams(words: DataFrame) -> DataFrame:
    """(gram, n): how often a bigram occurs in the different words; at most one line per pair of letters."""

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in rows:
            for word in batch.column("word").to_pylist():
                found.update(_gram_keys(word))
        schema = pa.schema([("gram", pa.int64()), ("n", pa.int64())])
        yield from batches({"gram": list(found), "n": list(found.values())}, schema)

    return words.select("word").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _signed(words: DataFrame, frequency: dict[int, int]) -> DataFrame:
    """One line per prefix gram: (word, length, last, gram, place, pivot)."""
    rank = {g: i for i, g in enumerate(sorted(frequency, key=lambda g: (frequency[g], g)))}
    known = words.sparkSession.sparkContext.broadcast((rank, frequency))
    ddl = "word string, length int, last int, gram int, place int, pivot boolean"
    schema = pa.schema(
        [("word", pa.string()), ("length", pa.int32()), ("last", pa.int32()), ("gram", pa.int32()),
         ("place", pa.int32()), ("pivot", pa.bool_())]
    )

    def sign(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, often = known.value
        for batch in rows:
            out: dict[str, list] = {n: [] for n in schema.names}
            for word in batch.column("word").to_pylist():
                grams = sorted((ranks[g], i) for i, g in enumerate(_gram_keys(word)))
                last = grams[PREFIX - 1][0]
                prefix = [(r, i) for r, i in grams if r <= last]
                of = {ranks[g]: often[g] for g in _gram_keys(word)}
                chosen = {p[2] for p in pivots([(of[r], r, i) for r, i in grams[:PREFIX]])}
                for r, i in prefix:
                    for name, value in zip(schema.names, (word, len(word), last, r, i, i in chosen)):
                        out[name].append(value)
            yield from batches(out, schema, 20_000)

    return words.select("word").mapInArrow(sign, ddl)


def one_edit(a: Column, b: Column) -> Column:
    """Exactly one inserted, deleted or replaced code point between two different words."""
    return F.levenshtein(a, b, 1) == 1


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b): every pair of words exactly one edit apart, once; words have at least four characters.

    Bigrams and their counts are as many as pairs of letters occur, so they go to every task.
    """
    spark = words.sparkSession
    frequency = {r["gram"]: r["n"] for r in _grams(words).collect()}
    # spelled by (last, word), so that the two words of a pair agree on which one shows its pivots
    signed = written(_signed(words, frequency), "grams")
    moves = F.array(
        *[F.struct(F.lit(a).alias("longer"), F.lit(b).alias("later")) for a, b in ((0, 0), (1, 0), (1, 1), (-1, 0), (-1, -1))]
    )
    shown = signed.filter("pivot").select(
        F.col("word").alias("a"), F.col("last").alias("a_last"), "gram", "place", "length", F.explode(moves).alias("move")
    ).select(
        "a", "a_last", "gram",
        (F.col("length") + F.col("move.longer")).alias("length"),
        (F.col("place") + F.col("move.later")).alias("place"),
    )
    held = signed.select(F.col("word").alias("b"), F.col("last").alias("b_last"), "gram", "length", "place")
    later = (F.col("a_last") < F.col("b_last")) | ((F.col("a_last") == F.col("b_last")) & (F.col("a") < F.col("b")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Words by themselves are few against a text, but their pairs are not: deal the work out evenly.
    joined = shown.repartition(parts, "gram", "length", "place").join(held, ["gram", "length", "place"])
    found = joined.filter(later & one_edit(F.col("a"), F.col("b")))
    return found.select("a", "b").distinct()


@tidy
def variants(docs: DataFrame, key: str = "doc_id", text: str = "text", damage: bool = True) -> DataFrame:
    """(word, n, n_near, form, form_n, root): every frequent word with the spelling it is a variant of.

    Words have at least six characters and five occurrences over all texts. ``form`` is the most frequent
    word one edit away (ties: the smallest by code points) if it is at least five times as frequent,
    ``root`` the last one reached by following forms. Null texts and a missing key are allowed, equal rows
    count as often as they come, other columns do not matter; no words give an empty table.
    """
    words = written(count_words(docs, key, text, damage).filter(F.col("n") >= MIN_COUNT), "words")
    pairs = near_pairs(words)
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    sized = both.join(words.select(F.col("word").alias("b"), F.col("n").alias("b_n")), "b")
    # the largest n; of equal ones the smallest word: max over the count, min over the word per count
    best = sized.groupBy("a").agg(
        F.count(F.lit(1)).alias("n_near"),
        F.min(F.struct((-F.col("b_n")).alias("minus_n"), "b")).alias("best"),
    )
    near = words.join(best.withColumnRenamed("a", "word"), "word", "left")
    fits = -F.col("best.minus_n") >= FORM_RATIO * F.col("n")
    formed = written(
        near.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(fits, F.col("best.b")).alias("form"),
            F.when(fits, -F.col("best.minus_n")).alias("form_n"),
        ),
        "forms",
    )
    steps = formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    # Each form is at least five times as frequent, so the longest way is a logarithm of the largest count.
    largest = words.agg(F.max("n")).first()[0] or 1
    longest = max(1, math.ceil(math.log(max(largest / MIN_COUNT, 1), FORM_RATIO)) + 1)
    for _ in range(math.ceil(math.log2(longest))):
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        steps = written(
            steps.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root")),
            "roots",
        )
    return formed.join(steps, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
