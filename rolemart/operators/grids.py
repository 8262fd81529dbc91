"""Dense dimension-by-time grids without a join between the axes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rolemart.functions.dates import days_from_to


def fill_days(metrics: DataFrame, dims: Sequence[str], values: Sequence[str], first: str, last: str) -> DataFrame:
    """Every day first..last for every existing combination of ``dims``.

    Each row is stretched over the gap up to the next row of its combination, so the grid
    comes out of one window on ``dims``; the metrics are computed and shuffled only once.
    Days without a row, and combinations with a NULL dimension, carry NULL values.
    """
    begin, end = F.lit(first).cast("date"), F.lit(last).cast("date")
    by_day = Window.partitionBy(*dims).orderBy("date")
    own = F.col("date").between(begin, end)
    upper = F.least(F.coalesce(F.date_sub("_next", 1), end), end)
    upper = F.when(own, F.greatest(upper, F.col("date"))).otherwise(upper)
    lower = F.when(F.col("_nth") == 1, begin).otherwise(F.greatest(F.col("date"), begin))
    stretched = (
        metrics.withColumn("_next", F.lead("date").over(by_day))
        .withColumn("_nth", F.row_number().over(by_day))
        .withColumn("_day", F.explode(days_from_to(lower, upper)))
    )
    comparable = F.col("_day") == F.col("date")
    for dim in dims:
        comparable = comparable & F.col(dim).isNotNull()
    return stretched.select(
        F.col("_day").alias("date"), *dims, *[F.when(comparable, F.col(v)).alias(v) for v in values]
    )


def axis_grid(base: DataFrame, metrics: DataFrame, axes: Sequence[str]) -> DataFrame:
    """Every row of ``base`` with every distinct value of each axis of ``metrics``.

    An axis is a set of dimension values (dates, systems, channels); all axes are read in one aggregate, as arrays that
    are exploded next to each base row; the largest axis belongs into ``base``. The grid is
    the report itself, so its size is the size of the output. ``metrics`` should be settled.
    """
    members = metrics.agg(F.struct(*(F.collect_set(F.struct(axis)).alias(axis) for axis in axes)).alias("members")).scalar()
    base = base.withColumn("_members", members)
    for axis in axes:
        base = base.select("*", F.explode(F.col(f"_members.{axis}")).alias(f"_{axis}"))
    return base.select(*(c for c in base.columns if c not in ("_members", *(f"_{a}" for a in axes))), *(F.col(f"_{a}.{a}").alias(a) for a in axes))


def running_total(value: str, dims: Sequence[str], time: str) -> Column:
    """Cumulative sum per ``dims`` in ``time`` order, row by row."""
    frame = Window.partitionBy(*dims).orderBy(time).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.sum(value).over(frame)
