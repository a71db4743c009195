"""The transform job: dirty a clean table so that the later steps have something to repair."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarryline.operators.edit import RowRange, edit_rows
from quarryline.sources.tables import read_table, write_table

# fixed values: the row ranges (from 0, end left out) that the transform changes
EDITS = (
    RowRange("duration", 0, 46),
    RowRange("checking_status", 25, 75),
    RowRange("credit_amount", 10, 54, 0),
)


def transform(df: DataFrame, key: str) -> DataFrame:
    return edit_rows(df, key, EDITS)


def run_transform(spark: SparkSession, raw: str, processed: str, key: str) -> None:
    write_table(transform(read_table(spark, raw), key), processed)
