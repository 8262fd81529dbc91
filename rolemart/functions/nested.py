"""Typed nested details, and their JSON text for consumers that want it."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def json_text(value: Column) -> Column:
    """JSON text that keeps NULL members."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def json_rows(value: Column, row_ddl: str) -> Column:
    """Array of JSON object texts to typed rows."""
    return F.transform(value, lambda text: F.from_json(text, row_ddl))


def amounts_from_json(value: Column) -> Column:
    """JSON object text to a name-to-amount map."""
    return F.from_json(value, "map<string,bigint>")


def map_total(amounts: Column) -> Column:
    """Sum of the map's values; NULL for a NULL map or a NULL value, 0 for an empty map."""
    return F.aggregate(F.map_values(amounts), F.lit(0).cast("bigint"), lambda total, x: total + x)


def zipped(left: Column, right: Column) -> Column:
    """Pair two arrays by position; the shorter (or NULL) one is padded with NULL."""
    both = F.arrays_zip(F.coalesce(left, F.array()).alias("left"), F.coalesce(right, F.array()).alias("right"))
    return both
