"""Projections and row edits: numeric / non-numeric columns, edits of a range of rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarryline.session import new_path


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def non_numeric_columns(df: DataFrame, leave_out: Sequence[str] = ()) -> list[str]:
    """Every other column; a boolean counts as non-numeric."""
    numeric = set(numeric_columns(df))
    return [c for c in df.columns if c not in numeric and c not in leave_out]


@dataclass(frozen=True)
class RowRange:
    """Set ``column`` to ``value`` in the rows at positions start..stop-1, counted from 0."""

    column: str
    start: int
    stop: int
    value: object = None


def keys_at(df: DataFrame, key: str, positions: Sequence[int]) -> dict[int, object]:
    """The unique key at each 0-based position of the key order; positions past the end are absent.

    The keys, of any type that has an order, are dealt to ranges and written; the sizes of the
    ranges say where a position lies, and only those ranges are sorted.
    """
    spark = df.sparkSession
    path = new_path(spark, "keys")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.select(F.col(key).alias("key")).repartitionByRange(parts, "key")
    dealt.withColumn("part", F.spark_partition_id()).write.parquet(path)
    keys = spark.read.parquet(path)
    sizes = keys.groupBy("part").count().collect()  # one line per range
    wanted, first = [], 0
    for line in sorted(sizes, key=lambda r: r["part"]):
        wanted += [
            (line["part"], p - first + 1, p) for p in positions if first <= p < first + line["count"]
        ]
        first += line["count"]
    if not wanted:
        return {}
    places = spark.createDataFrame(wanted, "in_part int, nth int, position long")
    order = Window.partitionBy("part").orderBy("key")
    found = (
        keys.filter(F.col("part").isin(sorted({w[0] for w in wanted})))
        .withColumn("nth", F.row_number().over(order))
        .join(places.withColumnRenamed("in_part", "part"), ["part", "nth"])
    )
    return {line["position"]: line["key"] for line in found.collect()}  # as many as positions


def edit_rows(df: DataFrame, key: str, edits: Sequence[RowRange]) -> DataFrame:
    """Apply all edits in one projection; a row's position is its rank by ``key``.

    Only the keys at the ends of the ranges are looked up, so the edit neither shuffles nor
    joins the table.
    """
    ends = {p for e in edits for p in (e.start, e.stop - 1)}
    key_at = keys_at(df, key, sorted(ends))
    changed: dict[str, Column] = {}
    for edit in edits:
        if edit.start not in key_at:
            continue
        inside = F.col(key) >= F.lit(key_at[edit.start])
        if edit.stop - 1 in key_at:
            inside &= F.col(key) <= F.lit(key_at[edit.stop - 1])
        kind = df.schema[edit.column].dataType
        before = changed.get(edit.column, F.col(edit.column))
        changed[edit.column] = F.when(inside, F.lit(edit.value).cast(kind)).otherwise(before)
    return df.withColumns(changed) if changed else df
