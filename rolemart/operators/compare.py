"""Reconciliation between two layers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def difference_of_totals(expected: DataFrame, actual: DataFrame, value: str) -> DataFrame:
    """Both one-row totals and their absolute difference, on one row.

    NULL totals stay NULL, as does their difference.
    """
    sides = expected.select(F.col(value).alias("expected"), F.lit(None).alias("actual")).unionByName(
        actual.select(F.lit(None).alias("expected"), F.col(value).alias("actual"))
    )
    return sides.agg(F.max("expected").alias("expected"), F.max("actual").alias("actual")).withColumn(
        "difference", F.abs(F.col("expected") - F.col("actual"))
    )


def difference_by_key(
    expected: DataFrame,
    actual: DataFrame,
    keys: Sequence[str],
    value: str,
    *,
    how: str = "left",
    signed: bool = False,
    only_mismatch: bool = False,
    missing_is_zero: bool = True,
) -> DataFrame:
    """Expected and actual value per key with their difference.

    A missing side counts as 0, or leaves the difference NULL where ``missing_is_zero`` is off.
    """
    left = expected.select(*keys, F.col(value).alias("expected"))
    right = actual.select(*keys, F.col(value).alias("actual"))
    joined = left.join(right, list(keys), how)
    gap = F.col("expected") - F.col("actual")
    if missing_is_zero:
        gap = F.coalesce("expected", F.lit(0)) - F.coalesce("actual", F.lit(0))
    report = joined.withColumn("difference", gap if signed else F.abs(gap))
    return report.where(F.col("difference") != 0) if only_mismatch else report
