"""Month-level carry-forward and neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rolemart.functions.dates import months_from_to


def carry_forward(observed: DataFrame, until: Column) -> DataFrame:
    """One row per role and month from its first observation to ``until``, with the last observed values.

    ``observed`` holds one row per role and ``month``. Each row covers the months up to the
    next observation, so rows are written once and never ranked against each other.
    """
    by_month = Window.partitionBy("role_id").orderBy("month")
    stop = F.coalesce(F.add_months(F.lead("month").over(by_month), -1), until)
    return observed.withColumn("_stop", stop).withColumn(
        "cal_month", F.explode(months_from_to(F.col("month"), F.least("_stop", until)))
    ).drop("_stop")


def with_previous_month(months: DataFrame, month: str, value: str, previous: str) -> DataFrame:
    """Add the value of the month before, for a gapless month report, plus whether there is one.

    Every row is sent to its own month and to the next one and the two meet in one grouping:
    no ordered pass of the whole report through a single task.
    """
    others = [c for c in months.columns if c != month]
    here = F.struct(
        F.col(month).alias("m"), F.struct(*others).alias("own"), F.lit(None).cast("struct<v:bigint>").alias("prev")
    )
    nothing = F.lit(None).cast(_struct_type(months, others))
    there = F.struct(
        F.add_months(month, 1).alias("m"),
        nothing.alias("own"),
        F.struct(F.col(value).cast("bigint").alias("v")).alias("prev"),
    )
    both = months.select(F.explode(F.array(here, there)).alias("r"))
    met = both.groupBy(F.col("r.m").alias(month)).agg(
        F.max("r.own").alias("own"), F.max("r.prev").alias("prev")
    )
    return met.where(F.col("own").isNotNull()).select(
        month,
        "own.*",
        F.col("prev.v").alias(previous),
        F.col("prev").isNotNull().alias("has_previous"),
    )


def _struct_type(df: DataFrame, names: list[str]) -> str:
    return "struct<" + ",".join(f"{n}:{df.schema[n].dataType.simpleString()}" for n in names) + ">"
