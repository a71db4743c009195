"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.llm import exact_dedup, langid, mixing, packing, similarity_join
from quarryline.llm.common import chosen_rows, free_name, text_key, written
from quarryline.llm.queries import TOKENIZER, quality_weights, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter that are not far from every language of the labelled ones.

    Where no document has a label there is nothing to be far from, so all with a letter stay.
    """
    model = langid.fit(docs, key="doc_id")
    if not model.languages:
        return docs.filter(langid.has_letter(F.col("text")))
    named, name = langid.identify(docs, model)
    return named.filter(~F.col(name)["rejected"]).select(*docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the smallest id."""
    keyed, name = _keyed(docs)
    found = exact_dedup.deduplicate(keyed, carry=["doc_id", name]).filter("kept")
    return chosen_rows(docs, found.select("row.*"), "doc_id", "text")


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents, the one with the smallest id."""
    keyed, name = _keyed(docs)
    found = similarity_join.join_components(keyed, carry=["doc_id", name]).filter("leader")
    return chosen_rows(docs, found.select("row.*"), "doc_id", "text")


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """With a hash of the text: operators carry it and the id, not whole rows."""
    name = free_name(docs.columns, "text_key")
    return docs.withColumn(name, text_key(F.col("text"))), name


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: a row for each time."""
    weights = quality_weights(table(spark, sf_dir, "labels"))
    mixed = mixing.mix(docs, quality=weights, carry=docs.columns)
    return mixed.filter("epochs > 0").select("row", F.explode(F.sequence(F.lit(1), "epochs"))).select("row.*")


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in the sequences."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER)).select(
        "row.doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


STAGES: list[tuple[str, Stage]] = [
    ("language", known_language),
    ("exact copies", without_copies),
    ("near copies", without_near_copies),
    ("source mix", mixed_sources),
    ("packing", packed_sequences),
]
# The language model, the tokenizer and the packing are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each on the written result of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
