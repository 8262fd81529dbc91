"""Helpers for operators that use DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once: a lambda variable is not computed again at each use."""
    return F.transform(F.array(value), then)[0]


def running(lengths: Column, block: int = 256) -> Column:
    """Sum of the elements before each one. Two levels, so that arrays of any length grow in small steps only."""

    def plain(a: Column) -> Column:
        start = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("before"))
        return F.aggregate(a, start, lambda s, x: F.struct((s["sum"] + x).alias("sum"), F.concat(s["before"], F.array(s["sum"])).alias("before")))

    def both(a: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(a), F.lit(1)), F.lit(block))
        blocks = F.transform(starts, lambda k: plain(F.slice(a, k, F.lit(block))))
        return let(blocks, lambda b: F.flatten(F.zip_with(
            b, plain(F.transform(b, lambda x: x["sum"]))["before"], lambda x, o: F.transform(x["before"], lambda y: y + o))))

    return let(lengths, both)
