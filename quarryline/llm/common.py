"""What the operators share: words, hashes of words, and tables written on the way."""

from __future__ import annotations

import ctypes
import functools
import itertools
import threading
import time
from collections.abc import Callable, Iterable, Iterator
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarryline.session import new_path

WORD = r"[^\x20\x09-\x0D]+"  # a word, as a Java pattern
SPACE = r"[\x20\x09-\x0D]+"
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
CACHED_WORDS = 200_000  # a worker forgets its hashes of words beyond that
LONGEST_CACHED = 64  # bytes; longer words are not remembered
IDLE_SECONDS = 5.0  # after which a worker forgets what it has not used


_MADE: ContextVar[list[str] | None] = ContextVar("_MADE", default=None)


def written(df: DataFrame, label: str) -> DataFrame:
    """The table as it lies in the shared folder: computed once, whichever executor is lost."""
    path = new_path(df.sparkSession, label)
    if (made := _MADE.get()) is not None:
        made.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tidy(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The operator with its result written, and the tables it wrote on the way removed."""

    @functools.wraps(operator)
    def call(*args, **kwargs) -> DataFrame:
        made: list[str] = []
        token = _MADE.set(made)
        try:
            result = operator(*args, **kwargs)
        finally:
            _MADE.reset(token)
        done = written(result, operator.__name__)
        spark = result.sparkSession
        for path in made:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        return done

    return call


def text_key(text) -> Column:
    """64 bits of a text; a null counts as the empty text."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def chosen_rows(docs: DataFrame, chosen: DataFrame, key: str, text: str) -> DataFrame:
    """The documents named by ``chosen`` (id, text_key), one row for each line, with all their columns.

    Ids may be missing or repeated. Of rows with the same id and text any one is taken; whole rows
    travel once, and only here.
    """
    names = [free_name(docs.columns, n) for n in ("chosen_id", "chosen_key", "chosen_nth")]
    chosen_id, chosen_key, nth = names
    wanted = chosen.toDF(chosen_id, chosen_key)
    same = F.col(key).eqNullSafe(F.col(chosen_id)) & (text_key(F.col(text)) == F.col(chosen_key))
    one = Window.partitionBy(chosen_id, chosen_key).orderBy(F.lit(0))
    found = docs.join(wanted, same).withColumn(nth, F.row_number().over(one))
    return found.filter(F.col(nth) == 1).select(*[docs[c] for c in docs.columns])


def free_name(columns: Iterable[str], base: str) -> str:
    """A column name that the table does not use yet (names differ by more than case)."""
    taken = {c.lower() for c in columns}
    names = itertools.chain([base], (f"{base}_{i}" for i in itertools.count(1)))
    return next(n for n in names if n.lower() not in taken)


def is_held_out(doc_id, parts: int):
    """True where crc32 of the id as text leaves 0; a null id counts as the empty text."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % parts == 0


def words_of(text: str | None) -> list[bytes]:
    """Words in lower-case A-Z; bytes split at exactly the white space of ``WORD``."""
    return text.encode("utf-8", "surrogatepass").translate(LOWER).split() if text else []


class Remembered(dict):
    """What a worker knows of words from one task to the next: at most ``bound`` short words, and none
    after ``IDLE_SECONDS`` without use, so that nothing of a stage lies in memory during later ones."""

    def __init__(self, bound: int = CACHED_WORDS):
        super().__init__()
        self.bound = bound
        self.used = 0.0
        self.watched = False

    def keep(self, word: bytes, value):
        if len(word) <= LONGEST_CACHED:
            if len(self) >= self.bound:
                self.clear()
            self[word] = value
        return value

    def touch(self) -> None:
        self.used = time.monotonic()
        if not self.watched:
            self.watched = True
            threading.Thread(target=self._forget, daemon=True).start()

    def _forget(self) -> None:
        while (left := self.used + IDLE_SECONDS - time.monotonic()) > 0:
            time.sleep(left)
        self.watched = False
        self.clear()
        give_back()


def give_back() -> None:
    """Return memory that is free within the process to the system."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


class WordHashes(Remembered):
    """64-bit hashes of words, remembered within a worker."""

    def __missing__(self, word: bytes) -> int:
        return self.keep(word, xxhash.xxh3_64_intdigest(word))

    def of(self, words: list[bytes]) -> np.ndarray:
        self.touch()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


WORD_HASHES = WordHashes()


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finaliser of splitmix64, whose constants are fixed)."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def batches(columns: dict[str, list], schema: pa.Schema, rows: int = 4096) -> Iterator:
    """Record batches of the columns, at most so many rows each."""
    table = pa.table([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
    yield from table.to_batches(max_chunksize=rows)
