"""Language identification by the nearest of several centroids per language.

A text becomes a vector of byte n-gram counts (of its letters, in lower case), damped, weighted by
inverse document frequency and scaled to length one. For each language, spherical k-means over
labelled texts gives several centroids, each with the cosines that nearly all of its own texts of a
length reach: short texts lie farther out, and the farthest are odd or mislabelled. A text gets the
language of the nearest centroid; much farther from it than texts of its length, it is rejected.

The document frequencies count all labelled texts. The centroids are fitted on about
``per_language`` texts of each language, chosen by a hash of the text and the row's key: the bound
that a fit needs. Copies are drawn apart and equal texts then count once, so a text with many copies
neither fills the sample nor outweighs the others. A drawn text leaves its task as counts of n-grams.
Model and vectors have fixed sizes: ``DIMENSIONS`` and ``CLUSTERS`` numbers per language.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quarryline.llm.common import free_name

UNKNOWN = "und"
DIMENSIONS = 4096
CLUSTERS = 4
PER_LANGUAGE = 1_500
ROUNDS = 12
LEAST_SHARE = 0.03  # smaller clusters of a language are mislabelled or odd texts and are left out
ODD = 0.05  # the share of a centroid's texts that may be odd ones or mislabelled
BANDS = 8  # of text length, each four times as long as the one before
ENOUGH = 20  # texts that a quantile needs; a band with fewer takes in its neighbours
SLACK = 0.5  # a text is rejected below this share of the cosine that the centroid's texts reach
# Letters of other scripts and accents keep their bytes; all else of ASCII becomes a space.
KEEP = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


COUNTED = pa.schema(
    [("lang", pa.string()), ("key", pa.int64()), ("place", pa.list_(pa.int32())), ("n", pa.list_(pa.int64()))]
)


@dataclass(frozen=True)
class Model:
    languages: list[str]  # of each centroid
    centroids: np.ndarray  # (centroids, DIMENSIONS), rows of length one
    floors: np.ndarray  # (centroids, BANDS), the cosine that the centroid's own texts reach
    weights: np.ndarray  # inverse document frequencies


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def counts_of(text: str) -> np.ndarray:
    """Counts of the 1-, 2- and 3-grams of bytes by hash; runs of other characters are one space."""
    data = b" " + b" ".join(text.encode("utf-8", "replace").translate(KEEP).split()) + b" "
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    two = (b[:-1] << 8) | b[1:]
    three = (two[:-1] << 8) | b[2:]
    grams = np.concatenate([b + 0x1000000, two + 0x2000000, three])
    return np.bincount((grams * np.uint32(2654435761)) >> np.uint32(20), minlength=DIMENSIONS)


def band_of(counts: np.ndarray) -> int:
    return min(int(counts.sum()).bit_length() // 2, BANDS - 1)


def _floors(cosine: np.ndarray, bands: np.ndarray) -> list[float]:
    """For each band, the cosine that all but ``ODD`` of its texts reach."""
    floors = []
    for band in range(BANDS):
        away = np.abs(bands - band)
        near = next((n for n in range(BANDS) if (away <= n).sum() >= ENOUGH), BANDS)
        floors.append(float(np.quantile(cosine[away <= near], ODD)))
    return floors


def vector_of(text: str, weights: np.ndarray) -> np.ndarray:
    return _scaled(counts_of(text), weights)


def _scaled(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    found = np.log1p(counts) * weights
    length = np.sqrt(found @ found)
    return found / length if length else found


def _frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """How many texts, and in how many of them each n-gram occurs."""

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(DIMENSIONS, np.int64), 0
        for batch in rows:
            for value in batch.column("text"):
                seen += counts_of(value.as_py()) > 0
                n += 1
        place = np.append(np.flatnonzero(seen), -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(place), pa.array(np.append(seen[place[:-1]], n))], names=["place", "n"]
        )

    total = texts.mapInArrow(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    found = np.zeros(DIMENSIONS, np.int64)
    n = 0
    for row in total.collect():  # at most DIMENSIONS + 1 rows
        if row["place"] < 0:
            n = row["n"]
        else:
            found[row["place"]] = row["n"]
    return n, found


def _counted(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each text, the n-grams it has and how often: a bounded number, however long the text."""
    for batch in rows:
        for lang, key, text in zip(*(batch.column(n) for n in ("lang", "key", "text"))):
            counts = counts_of(text.as_py())
            place = np.flatnonzero(counts)
            line = {"lang": lang.as_py(), "key": key.as_py(), "place": place, "n": counts[place]}
            yield pa.RecordBatch.from_pylist([line], schema=COUNTED)


def _clusters(rows: pd.DataFrame, weights: np.ndarray, clusters: int) -> list[tuple[np.ndarray, list[float]]]:
    """Spherical k-means, begun with texts far apart: (centroid, floors of the bands)."""
    points = np.zeros((len(rows), DIMENSIONS), np.float32)
    bands = np.zeros(len(rows), np.int64)
    for i, (place, n) in enumerate(zip(rows["place"], rows["n"])):
        counts = np.zeros(DIMENSIONS, np.int64)
        counts[place] = n
        points[i], bands[i] = _scaled(counts, weights), band_of(counts)
    bands = bands[points.any(axis=1)]
    points = points[points.any(axis=1)]
    if not len(points):
        return []
    centres = [points[int(np.argmax(points @ points.mean(axis=0)))]]
    while len(centres) < min(clusters, len(points)):
        nearest = np.max(points @ np.array(centres).T, axis=1)
        # The texts at the edge are often odd ones: take one at the lower tenth instead.
        centres.append(points[int(np.argsort(nearest, kind="stable")[len(points) // 10])])
    middle = np.array(centres)
    for _ in range(ROUNDS):
        own = np.argmax(points @ middle.T, axis=1)
        sums = np.array([points[own == k].sum(axis=0) for k in range(len(middle))])
        lengths = np.linalg.norm(sums, axis=1, keepdims=True)
        middle = np.where(lengths > 0, sums / np.maximum(lengths, 1e-12), middle)
    cosine = points @ middle.T
    own = np.argmax(cosine, axis=1)
    return [
        (middle[k].astype(np.float64), _floors(cosine[own == k, k], bands[own == k]))
        for k in range(len(middle))
        if (own == k).sum() >= min(LEAST_SHARE * len(own), np.bincount(own).max())
    ]


def fit(
    labelled: DataFrame,
    text: str = "text",
    lang: str = "lang",
    clusters: int = CLUSTERS,
    per_language: int = PER_LANGUAGE,
    key: str | None = None,
) -> Model:
    """Centroids of the labelled texts; rows without a label or a letter teach nothing.

    ``key`` names a column that tells rows apart. Rows with the same key and text (or, without a key,
    the same text) are drawn together, and count once like all equal texts of a language.
    """
    nth = F.lit(None).cast("string") if key is None else F.col(key).cast("string")
    rows = labelled.select(
        F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"), nth.alias("nth")
    ).filter(F.col("lang").isNotNull() & has_letter(F.col("text")))
    n, found = _frequencies(rows.select("text"))
    weights = np.log((1 + n) / (1 + found)) + 1
    sizes = rows.groupBy("lang").count().collect()  # a row for each language to be learned
    if not sizes:
        return _model([], weights)
    size = F.create_map(*[F.lit(value) for row in sizes for value in (row["lang"], float(row["count"]))])
    draw = F.pmod(F.xxhash64("text", "nth", F.lit(5)), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.filter(draw * size[F.col("lang")] < float(per_language))
    counted = (
        sample.select("lang", F.xxhash64("text").alias("key"), "text")
        .mapInArrow(_counted, "lang string, key long, place array<int>, n array<long>")
        .dropDuplicates(["lang", "key"])
    )

    def cluster(pdf: pd.DataFrame) -> pd.DataFrame:
        # In the order of the hashes, so that the result does not depend on how rows arrive.
        parts = _clusters(pdf.sort_values("key"), weights, clusters)
        return pd.DataFrame(
            {
                "lang": [pdf["lang"].iloc[0]] * len(parts),
                "centroid": [c.tolist() for c, _ in parts],
                "floors": [f for _, f in parts],
            }
        )

    model = counted.groupBy("lang").applyInPandas(
        cluster, "lang string, centroid array<double>, floors array<double>"
    )
    return _model(model.collect(), weights)


def _model(lines: list[Row], weights: np.ndarray) -> Model:
    parts = sorted(lines, key=lambda r: (r["lang"], r["floors"], r["centroid"]))
    return Model(
        [r["lang"] for r in parts],
        np.array([r["centroid"] for r in parts]).reshape(len(parts), DIMENSIONS),
        np.array([r["floors"] for r in parts]).reshape(len(parts), BANDS),
        weights,
    )


def identify(
    docs: DataFrame, model: Model, text: str = "text", name: str = "language", slack: float = SLACK
) -> tuple[DataFrame, str]:
    """The rows with a struct (lang, score, rejected), and the name of that column.

    ``score`` is the cosine to the nearest centroid, 0 for a text without a letter, which is
    ``und`` and rejected like a null or empty one. So is every text if nothing was learned. Whole
    texts count, however long; equal texts get equal answers. All columns stay; if one is called
    ``name`` already, the new one gets a number.
    """
    name = free_name(docs.columns, name)
    checked = free_name([*docs.columns, name], "lettered")
    answer = T.StructType.fromDDL("lang string, score double, rejected boolean")
    out = T.StructType([*docs.schema.fields, T.StructField(name, answer)])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def answers(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, known = to_arrow_schema(out), shared.value
        for batch in rows:
            found = []
            for lettered, value in zip(batch.column(checked), batch.column(text)):
                if not lettered.as_py() or not known.languages:
                    found.append({"lang": UNKNOWN, "score": 0.0, "rejected": True})
                    continue
                counts = counts_of(value.as_py())
                cosine = known.centroids @ _scaled(counts, known.weights)
                k = int(np.argmax(cosine))
                found.append(
                    {
                        "lang": known.languages[k],
                        "score": min(1.0, max(0.0, float(cosine[k]))),
                        "rejected": bool(cosine[k] < slack * known.floors[k, band_of(counts)]),
                    }
                )
            columns = [batch.column(f.name).cast(schema.field(f.name).type) for f in docs_fields]
            columns.append(pa.array(found, schema.field(name).type))
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    docs_fields: Sequence[T.StructField] = docs.schema.fields
    return docs.withColumn(checked, has_letter(F.col(text))).mapInArrow(answers, out), name
