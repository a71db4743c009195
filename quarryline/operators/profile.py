"""Column profiles and class counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarryline.operators.edit import non_numeric_columns, numeric_columns
from quarryline.operators.ordered import exact_quantiles
from quarryline.session import stored

PERCENTILES = {"p10": 0.10, "p25": 0.25, "p50": 0.50, "p75": 0.75, "p90": 0.90}


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns")
    )


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def class_balance(df: DataFrame, label: str, by: str) -> DataFrame:
    """Share of each class within each split."""
    counts = df.groupBy(by, label).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(by)))


def numeric_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One line per numeric column: counts, moments and exact percentiles."""
    columns = list(columns) if columns is not None else numeric_columns(df)
    if not columns:
        raise ValueError("no numeric columns to summarise")
    df = stored(df.select(*columns), "numbers")  # read in every pass, computed once
    quantiles = exact_quantiles(df, columns, list(PERCENTILES.values()))
    aggregates = [F.count(F.lit(1)).alias("n")]
    for i, name in enumerate(columns):
        x = F.col(name).cast("double")
        aggregates += [
            F.count(x).alias(f"non_null_{i}"),
            F.count(F.when(x == 0, 1)).alias(f"zeros_{i}"),
            F.avg(x).alias(f"mean_{i}"),
            F.stddev_samp(x).alias(f"sd_{i}"),
            F.skewness(x).alias(f"skew_{i}"),
            F.kurtosis(x).alias(f"kurtosis_{i}"),
            F.min(x).alias(f"min_{i}"),
            F.max(x).alias(f"max_{i}"),
        ]
    lines = F.array(
        *[_numeric_line(name, i, quantiles[name]) for i, name in enumerate(columns)]
    )
    return df.agg(*aggregates).select(F.inline(lines))


def _numeric_line(name: str, i: int, quantiles: Sequence[float | None]) -> Column:
    def at(measure: str) -> Column:
        return F.col(f"{measure}_{i}")

    mean = at("mean")
    return F.struct(
        F.lit(name).alias("column"),
        at("non_null").alias("non_null"),
        (F.col("n") - at("non_null")).alias("nulls"),
        _share(F.col("n") - at("non_null"), F.col("n")).alias("pct_null"),
        at("zeros").alias("zeros"),
        _share(at("zeros"), F.col("n")).alias("pct_zeros"),
        mean.alias("mean"),
        at("sd").alias("sd"),
        F.when(mean != 0, at("sd") / mean).alias("coef_var"),
        at("skew").alias("skew"),
        at("kurtosis").alias("kurtosis"),
        at("min").alias("min"),
        *[F.lit(v).cast("double").alias(p) for p, v in zip(PERCENTILES, quantiles)],
        at("max").alias("max"),
    )


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole)


def value_counts(df: DataFrame, columns: Sequence[str], kind: str = "string") -> DataFrame:
    """Long table (column, value, n); NULL is one of the values."""
    entries = [
        F.struct(F.lit(c).alias("column"), F.col(c).cast(kind).alias("value")) for c in columns
    ]
    return (
        df.select(F.inline(F.array(*entries)))
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def most_frequent(counts: DataFrame) -> Column:
    """Aggregate over ``value_counts``: the commonest value, the smallest one on ties."""
    return F.min_by(
        "value", F.when(F.col("value").isNotNull(), F.struct(-F.col("n"), F.col("value")))
    )


def non_numeric_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One line per non-numeric column: counts, most frequent value, distinct values."""
    columns = list(columns) if columns is not None else non_numeric_columns(df)
    if not columns:
        raise ValueError("no non-numeric columns to summarise")
    counts = value_counts(df, columns)
    present = F.col("value").isNotNull()
    total = F.sum("n")
    non_null = F.coalesce(F.sum(F.when(present, F.col("n"))), F.lit(0))
    unique = F.count("value")
    return counts.groupBy("column").agg(
        non_null.alias("non_null"),
        (total - non_null).alias("nulls"),
        ((total - non_null) / total).alias("pct_null"),
        most_frequent(counts).alias("most_frequent"),
        unique.alias("unique"),
        (unique / total).alias("pct_unique"),
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()
