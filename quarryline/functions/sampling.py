"""Draws from hyper-parameter priors: column expressions over a uniform column ``u``."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column
from pyspark.sql import functions as F


def categorical(u: Column, options: Sequence, weights: Sequence[float] | None = None) -> Column:
    """One of the options, uniformly or with the given weights."""
    choices = F.array(*[F.lit(o) for o in options])
    if weights is None:
        return F.element_at(choices, (F.floor(u * len(options)) + 1).cast("int"))
    edges = list(accumulate(weights))
    passed = sum(F.when(u >= F.lit(edge), 1).otherwise(0) for edge in edges[:-1])
    return F.element_at(choices, passed + 1)


def uniform(u: Column, low: float, high: float) -> Column:
    return F.lit(float(low)) + u * F.lit(float(high - low))


def log_uniform(u: Column, low: float, high: float) -> Column:
    return F.exp(F.lit(math.log(low)) + u * F.lit(math.log(high) - math.log(low)))


def integer(u: Column, low: int, high: int) -> Column:
    """Both ends can be drawn."""
    return F.lit(low).cast("bigint") + F.floor(u * (high - low + 1))


def integer_log(u: Column, low: int, high: int) -> Column:
    return F.round(log_uniform(u, low, high)).cast("bigint")
