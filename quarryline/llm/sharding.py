"""Place records on shards by a permutation-filled lookup table.

Each shard has a preference order over the slots of a table of prime size (start and step come from
a hash of its name). The shards take turns; at its turn a shard claims the first free slot of its
order, until no slot is free. Shards own equally many slots (give or take one), and when a shard is
added or lost few of the other slots change hands. A record belongs to the owner of the slot its
key hashes to.

The table is folded up by one SQL expression over the turns; its size is the parameter ``slots``,
which bounds what is broadcast. Records are placed by a lookup: no shuffle, no sort, no hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarryline.llm.common import free_name

SLOTS = 4099  # prime; at least a hundred slots for each shard keep the shares within 1 %
PROBES = 65_536  # slots looked at in one pass of the fold
FREE = "~"


def _hash(text: Column, start: int) -> Column:
    """32 bits of the md5, which any SQL engine computes alike."""
    return F.conv(F.substring(F.md5(text.cast("binary")), start, 8), 16, 10).cast("bigint")


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """A null key hashes like the empty text."""
    return (_hash(F.coalesce(key.cast("string"), F.lit("")), 1) % slots).cast("int")


def lookup_table(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """(slot, shard): one row per slot. ``shards`` are distinct names, at most as many as slots."""
    if not is_prime(slots):
        raise ValueError("the number of slots must be prime, or an order may miss some of them")
    if not shards or len(set(shards)) < len(shards) or len(shards) > slots:
        raise ValueError("give at least one shard, distinct names and no more shards than slots")
    # The owners stand in a text of four characters per slot; turn counts claims, next how many
    # slots of its order each shard has looked at.
    n, wide = len(shards), 4
    names = F.array(*[F.lit(s) for s in shards])
    state = spark.range(1).select(
        F.transform(names, lambda s: _hash(s, 1) % slots).alias("start"),
        F.transform(names, lambda s: _hash(s, 9) % (slots - 1) + 1).alias("step"),
        F.lit(FREE * (wide * slots)).alias("owners"),
        F.lit(0).alias("turn"),
        F.array_repeat(F.lit(0).cast("bigint"), n).alias("next"),
    )

    def look(s: Column, _: Column) -> Column:
        shard = s["turn"] % n
        tried = F.get(s["next"], shard)
        slot = (F.get(F.col("start"), shard) + tried * F.get(F.col("step"), shard)) % slots
        place = (slot * wide + 1).cast("int")
        free = (s["turn"] < slots) & (F.substring(s["owners"], place, 1) == FREE)
        claim = F.overlay(s["owners"], F.lpad(shard.cast("string"), wide, "0"), place, wide)
        return F.struct(
            F.when(free, claim).otherwise(s["owners"]).alias("owners"),
            F.when(free, s["turn"] + 1).otherwise(s["turn"]).alias("turn"),
            F.transform(
                s["next"], lambda v, i: F.when(i == shard, v + 1).otherwise(v)
            ).alias("next"),
        )

    if n > 10**wide:
        raise ValueError("too many shards")
    while True:
        folded = F.aggregate(
            F.sequence(F.lit(1), F.lit(PROBES)), F.struct("owners", "turn", "next"), look
        )
        row = state.select("start", "step", folded.alias("s")).select("start", "step", "s.*").first()
        if row["turn"] == slots:
            break
        state = spark.range(1).select(
            *[F.array(*[F.lit(v).cast("bigint") for v in row[c]]).alias(c) for c in ("start", "step")],
            F.lit(row["owners"]).alias("owners"),
            F.lit(row["turn"]).alias("turn"),
            F.array(*[F.lit(v).cast("bigint") for v in row["next"]]).alias("next"),
        )
    return (
        spark.range(slots)
        .select(F.col("id").cast("int").alias("slot"))
        .select(
            "slot",
            F.substring(F.lit(row["owners"]), F.col("slot") * wide + 1, F.lit(wide))
            .cast("int")
            .alias("place"),
        )
        .select("slot", F.get(names, F.col("place")).alias("shard"))
    )


def place(records: DataFrame, key: Column, table: DataFrame, slots: int = SLOTS) -> DataFrame:
    """The records with (slot, shard).

    Null keys go where the empty text goes; equal keys meet on one shard; an empty table stays
    empty. Columns of the records called slot or shard keep their values, and the new ones are then
    called slot_1 or shard_1.
    """
    slot, shard = (free_name(records.columns, c) for c in ("slot", "shard"))
    owners = table.select(F.col("slot").alias(slot), F.col("shard").alias(shard))
    return records.withColumn(slot, slot_of(key, slots)).join(F.broadcast(owners), slot).select(
        *[records[c] for c in records.columns], slot, shard
    )
