"""Exact distinct users of any days from stored bitmaps, without going back to the users.

Users are numbered densely within ``PARTS`` parts. A day's active users are bitmaps, one for each part and each 32,768 numbers
of it. Bitmaps of several days are merged by or, so a month or a trailing window costs its days' bitmaps, however often a user
was active, and no user id is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rolemart.functions.dates import days_from_to

#: Parts that users are numbered in. Fixed once users are numbered; a part is numbered by one task.
PARTS = 512


def _part(parts: int) -> Column:
    return F.pmod(F.xxhash64("role_id"), F.lit(parts)).cast("int")


def number_users(daily: DataFrame, known: DataFrame | None = None, parts: int = PARTS) -> DataFrame:
    """``known`` numbers (role_id, part, nth from 1) and, after them, those of the users of ``daily`` that have none yet.

    A number stays with its user, so bitmaps written earlier keep their meaning. Rows without a user get none.
    """
    users = daily.where(F.col("role_id").isNotNull()).select("role_id").distinct()
    if known is None:
        fresh, start = users, F.lit(0)
    else:
        taken = known.groupBy(F.col("part").alias("_part")).agg(F.max("nth").alias("_taken"))  # ``parts`` rows
        fresh = users.join(known.select("role_id"), "role_id", "left_anti").join(taken, _part(parts) == F.col("_part"), "left")
        start = F.coalesce("_taken", F.lit(0))
    nth = F.row_number().over(Window.partitionBy("part").orderBy("role_id"))
    numbered = fresh.withColumn("part", _part(parts)).select("role_id", "part", (nth + start).cast("bigint").alias("nth"))
    return numbered if known is None else known.select("role_id", "part", "nth").unionByName(numbered)


def day_bitmaps(daily: DataFrame, numbers: DataFrame) -> DataFrame:
    """Active users per day as bitmaps (part_date, part, bucket, users). Every user of ``daily`` needs a number."""
    seen = daily.where(F.col("role_id").isNotNull()).select("part_date", "role_id").distinct()
    numbered = seen.join(numbers, "role_id", "left")
    missing = F.raise_error(F.concat(F.lit("no number for user "), F.col("role_id"))).cast("bigint")
    nth = F.coalesce("nth", missing)
    return (
        numbered.select("part_date", "part", nth.alias("nth"))
        .groupBy("part_date", "part", F.bitmap_bucket_number("nth").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("nth")).alias("users"))
    )


def _count(bitmaps: DataFrame, period: str) -> DataFrame:
    merged = bitmaps.groupBy(period, "part", "bucket").agg(F.bitmap_or_agg("users").alias("users"))
    return merged.groupBy(period).agg(F.sum(F.bitmap_count("users")).cast("bigint").alias("active_users"))


def monthly_users(bitmaps: DataFrame) -> DataFrame:
    """Distinct users per calendar month."""
    return _count(bitmaps.withColumn("month", F.trunc(F.to_date("part_date"), "month")), "month")


def trailing_users(bitmaps: DataFrame, days: int) -> DataFrame:
    """Distinct users of the ``days`` days up to each day that had any users, the day itself included."""
    day = F.to_date("part_date")
    served = bitmaps.select("part", "bucket", "users", F.explode(days_from_to(day, F.date_add(day, days - 1)).cast("array<string>")).alias("_day"))
    stored = bitmaps.select(F.col("part_date").alias("_day")).distinct()
    return _count(served.join(stored, "_day", "left_semi"), "_day").withColumnRenamed("_day", "part_date")
