"""Random numbers that depend only on a seed and a row's key.

``rand(seed)`` and ``randomSplit`` change with the partitioning of the input and with a lost
executor; an md5 of the key does not, and any other SQL engine can reproduce it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 48
HASH_BOUNDS = (0.0, float((1 << HASH_BITS) - 1))


def key_hash(*parts: Column | str | int) -> Column:
    """Uniform integer in [0, 2^48) from the colon-joined parts; plain values are literals."""
    columns = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    text = F.concat_ws(":", *[c.cast("string") for c in columns])
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def unit_draw(*parts: Column | str | int) -> Column:
    """Uniform double in [0, 1)."""
    return key_hash(*parts) / F.lit(float(1 << HASH_BITS))
