"""Joins of a log to a lookup table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

BROADCAST_ROWS = 100_000


def join_lookup(log: DataFrame, lookup: DataFrame, on: list[str], max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Left join a lookup, broadcast only after counting that it has at most ``max_rows`` rows.

    A lookup key such as the month is shared by very many log rows, so shuffling the log by
    it would pile them up; that is left to larger lookups, where Spark splits skewed keys.
    """
    small = lookup.limit(max_rows + 1).count() <= max_rows
    return log.join(F.broadcast(lookup) if small else lookup, on, "left")
