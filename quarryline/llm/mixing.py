"""Mix sources to target weights: complete epochs, then a weighted sample without replacement.

A source's target is its share, by weight, of all words, at most ``max_epochs`` times its own size;
what the limit leaves over goes to the other sources by weight. A source is taken whole as often as
its target holds it. The rest of its target is filled by Efraimidis-Spirakis sampling: each
document draws u from a hash of its id and gets the key u^(1/quality); documents are taken from the
highest key downwards until their sizes reach the budget. The last one is taken when that brings
the words closer to the target.

Prefix sums do not sort a source in one task: keys fall into bins, the sums of the bins are added up,
and only the bin in which a budget runs out is sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarryline.functions.hashing import unit_draw
from quarryline.llm.common import WORD, written

CYCLE = (1, 2, 3)
MAX_EPOCHS = 3
ROWS_PER_BIN = 500
SEED = 7


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(
    sized: DataFrame, cycle: Sequence[float] = CYCLE, max_epochs: int = MAX_EPOCHS
) -> DataFrame:
    """(source, source_size, source_rows, target): one row per source, from rows (source, size).

    Weights go round over the sources in the order of their code points, null last. Sharing again
    what is above the limits, until none is above, ends where target = min(level * weight, limit)
    with one level for all. Sources reach their limit in the order of limit / weight: the level is that
    of the first source that stays within its limit when all before it are at theirs, and as levels
    only fall from there, it is the highest level that stays within a limit.
    """
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    by_limit = Window.partitionBy(F.lit(0)).orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    weights = F.array(*[F.lit(float(w)) for w in cycle])
    all_rows = Window.partitionBy(F.lit(0))
    return (
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows"))
        .withColumn("weight", F.get(weights, (F.row_number().over(by_name) - 1) % len(cycle)))
        .withColumn("cap", (max_epochs * F.col("source_size")).cast("double"))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("lighter", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn(
            "level",
            (F.sum("source_size").over(all_rows) - F.col("capped"))
            / (F.sum("weight").over(all_rows) - F.col("lighter")),
        )
        .withColumn("level", F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(all_rows))
        .withColumn("target", F.least("cap", F.col("level") * F.col("weight")))
        .select("source", "source_size", "source_rows", "target")
    )


def _sized(
    docs: DataFrame,
    key: str,
    text: str,
    source: str,
    quality: DataFrame | None,
    unmarked: float,
    carry: Sequence[str],
    seed: int,
) -> DataFrame:
    """Every row with its size and its key ``draw``; ``uid`` tells repeated rows apart.

    Sizes are computed in the scan, so no text travels to its weight unless it is carried.
    """
    rows = docs.select(
        F.struct(*carry).alias("row"),
        F.col(key).alias("id"),
        F.col(source).alias("source"),
        n_words(F.col(text)).alias("size"),
    )
    weight = F.lit(1.0)
    if quality is not None:
        of, value = quality.columns
        marks = quality.groupBy(F.col(of).alias("marked")).agg(
            F.max(value).cast("double").alias("weight")
        )
        rows = rows.join(marks, F.col("id") == F.col("marked"), "left")
        weight = F.greatest(F.coalesce("weight", F.lit(unmarked)), F.lit(1.0))
    unit = unit_draw(seed, F.coalesce(F.col("id").cast("string"), F.lit("")))
    return rows.select(
        "row",
        "id",
        "source",
        "size",
        F.pow(unit, 1 / weight).alias("draw"),
        F.monotonically_increasing_id().alias("uid"),
    )


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    quality: DataFrame | None = None,
    unmarked: float = 2.0,
    carry: Sequence[str] = ("doc_id",),
    cycle: Sequence[float] = CYCLE,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: row (the carried columns), source, size, source_size, target, epochs.

    ``epochs`` says how often a document is taken, 0 to ``max_epochs``. ``quality`` has ids and
    weights of at least 1, which do not change the targets; a document without one has ``unmarked``,
    and of several the largest counts. A null or empty text has size 0 and is taken with the complete
    epochs only. Documents without a source are a source of their own. Repeated rows draw the same
    key, and as many of them are taken as the budget holds. An empty table gives an empty one; columns
    that are not carried do not matter.
    """
    sized = written(_sized(docs, key, text, source, quality, unmarked, carry, seed), "mix-sized")
    targets = source_targets(sized, cycle, max_epochs).select(
        F.col("source").alias("of"),
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
        .otherwise(1)
        .alias("full"),
        F.ceil(F.col("source_rows") / ROWS_PER_BIN).alias("bins"),
    )
    targets = written(
        targets.withColumn("budget", F.col("target") - F.col("full") * F.col("source_size")), "mix-targets"
    )
    of_source = F.col("source").eqNullSafe(F.col("of"))
    rows = sized.join(targets, of_source).withColumn("bin", F.floor((1 - F.col("draw")) * F.col("bins")))
    # Sums of the bins, the words taken before each, and the bin in which a source's budget ends.
    upto = Window.partitionBy("of").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    ends = (
        rows.groupBy("of", "bin", "budget")
        .agg(F.sum("size").alias("bin_size"))
        .withColumn("before", F.coalesce(F.sum("bin_size").over(upto), F.lit(0)))
        .filter("before <= budget and before + bin_size > budget")
        .groupBy("of")
        .agg(F.min(F.struct("bin", "before")).alias("end"))
        .select(F.col("of").alias("ends_of"), F.col("end.bin").alias("last_bin"), "end.before")
    )
    # Where in that bin: a document is still taken if the budget ends beyond its middle.
    place = F.struct(
        (-F.col("draw")).alias("draw"), F.col("id").isNull().alias("missing"), "id", "size", "uid"
    )
    order = Window.partitionBy("of").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    last = (
        rows.drop("row")
        .join(ends, F.col("of").eqNullSafe(F.col("ends_of")) & (F.col("bin") == F.col("last_bin")))
        .withColumn("place", place)
        .withColumn("upto", F.col("before") + F.sum("size").over(order))
        .filter("upto - size / 2 <= budget")
        .groupBy("of")
        .agg(F.max("place").alias("last_place"))
        .select(F.col("of").alias("last_of"), "last_place")
    )
    cuts = written(
        targets.join(ends, F.col("of").eqNullSafe(F.col("ends_of")), "left")
        .join(last, F.col("of").eqNullSafe(F.col("last_of")), "left")
        .drop("ends_of", "last_of", "before"),
        "mix-cuts",
    )
    marked = sized.join(cuts, of_source).withColumn(
        "bin", F.floor((1 - F.col("draw")) * F.col("bins"))
    )
    chosen = (
        F.when((F.col("budget") <= 0) | (F.col("size") == 0), False)
        .when(F.col("last_bin").isNull() | (F.col("bin") < F.col("last_bin")), True)
        .when(F.col("bin") > F.col("last_bin"), False)
        .otherwise(F.coalesce(place <= F.col("last_place"), F.lit(False)))
    )
    return marked.withColumn("epochs", (F.col("full") + chosen.cast("int")).cast("int")).select(
        "row", "source", "size", "source_size", "target", "epochs"
    )
