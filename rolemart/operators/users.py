"""User attributes, lifecycle days and distinct-user metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rolemart.functions.dates import days_between


def with_user_attrs(fact: DataFrame, info: DataFrame, attrs: Sequence[str]) -> DataFrame:
    """Left join user attributes and drop test users; users missing from ``info`` stay.

    Without attributes to add, only the few test users are looked at: an anti join has the same rows, and Spark
    broadcasts its small side where it knows the size.
    """
    if not attrs:
        listed = info.where(F.col("is_test").isNotNull()).select("role_id")
        return fact.join(listed, "role_id", "left_anti")
    picked = info.select("role_id", *attrs, F.col("is_test").alias("_info_test"))
    return fact.join(picked, "role_id", "left").where(F.col("_info_test").isNull()).drop("_info_test")


def mark_test_users(df: DataFrame, test_accounts: DataFrame) -> DataFrame:
    """Add ``is_test``: 1 for listed accounts, NULL for everyone else."""
    listed = test_accounts.select("role_id").distinct().withColumn("is_test", F.lit(1))
    return df.join(listed, "role_id", "left")


def without_test_accounts(df: DataFrame, test_accounts: DataFrame) -> DataFrame:
    return df.join(test_accounts.select("role_id"), "role_id", "left_anti")


def lifecycle_days(day: str = "date") -> dict[str, Column]:
    """Days since install, days since first payment, and days from install to first payment."""
    return {
        "retention_day": days_between(F.col("install_date"), F.col(day)),
        "pay_retention_day": days_between(F.col("firstpay_date"), F.col(day)),
        "firstpay_interval_days": days_between(F.col("install_date"), F.col("firstpay_date")),
    }


def user_metrics(
    df: DataFrame,
    dims: Sequence[str],
    users: Mapping[str, Column | None],
    sums: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Distinct users under several conditions, plus sums, per ``dims``.

    Two plain aggregations instead of several DISTINCT aggregates: the first folds a
    user's rows to one row of flags, the second adds the flags up. No row is copied per
    condition, and both steps combine map-side, so a hot dimension value or a hot user
    reaches the shuffle already reduced.
    """
    sums = sums or {}
    per_user = df.groupBy(*dims, "role_id").agg(
        *[F.max((F.lit(True) if c is None else c).cast("int")).alias(n) for n, c in users.items()],
        *[F.sum(c).alias(n) for n, c in sums.items()],
    )
    known = F.col("role_id").isNotNull()
    return per_user.groupBy(*dims).agg(
        *[F.coalesce(F.sum(F.when(known, F.col(n))), F.lit(0)).cast("bigint").alias(n) for n in users],
        *[F.sum(n).alias(n) for n in sums],
    )
