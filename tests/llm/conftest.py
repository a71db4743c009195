import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    " row string, kept string, slot int, size long, language string, component_id long, weight double"
)


@pytest.fixture(scope="session")
def prose():
    """Texts from a seed: words of a small vocabulary, so that shingles and counts repeat."""
    draw = random.Random(11)
    words = ["".join(draw.choices("abcdeéöñ", k=draw.randint(1, 6))) for _ in range(400)]

    def make(n: int, seed: int) -> str:
        own = random.Random(seed)
        return " ".join(own.choices(words, k=n))

    return make


@pytest.fixture(scope="session")
def tricky(spark, prose):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing names."""
    long_text = prose(60_000, 1)
    texts = [
        (1, "The cat sat on the mat, and it was fine.", "en", "a"),
        (2, "The  cat sat on\tthe mat, and it was fine.", "en", "a"),
        (2, "The  cat sat on\tthe mat, and it was fine.", "en", "a"),
        (3, None, "en", "b"),
        (4, "", None, "b"),
        (5, " \n\t ", "de", None),
        (None, "Ein Text ohne Nummer und mit Wörtern.", "de", None),
        (None, None, None, None),
        (6, long_text, "de", "c"),
        (7, long_text + " noch ein Wort", "de", "c"),
        (8, "123 456 !!!", "en", "c"),
        (9, "eins", "de", "a"),
        (10, "THE CAT SAT ON THE MAT, AND IT WAS FINE.", "en", "b"),
        (11, "\u00a0x\u2003y \U0001f600 <|endoftext|> 's é.", "fr", "\U0001f600"),
        (12, prose(80, 2), "fr", "z"),
        (13, prose(80, 2) + " encore", "fr", "z"),
    ]
    rows = [
        (i, t, lang, s, len(t) if t is not None else None, "r", None, 1, 2, "x", 3, None)
        for i, t, lang, s in texts
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none_at_all(spark):
    return spark.createDataFrame([], SCHEMA)
