from __future__ import annotations

from pyspark.sql import Column, functions as F


def days_between(start: Column, end: Column) -> Column:
    """Whole days from start to end."""
    return F.datediff(end, start)


def months_between(start: Column, end: Column) -> Column:
    """Calendar months from start to end, ignoring the day of month."""
    return (F.year(end) - F.year(start)) * 12 + (F.month(end) - F.month(start))


def month_of(day: Column) -> Column:
    """First day of the month; stays a DATE."""
    return F.trunc(day, "month")


def day_text(day: Column) -> Column:
    """``yyyy-MM-dd``, without passing through a zoned timestamp."""
    return day.cast("date").cast("string")


def month_text(day: Column) -> Column:
    return F.substring(day.cast("date").cast("string"), 1, 7)


def hour_of(ts: Column) -> Column:
    """Start of the hour as a zone-free timestamp."""
    midnight = F.to_date(ts).cast("timestamp_ntz")
    return midnight + F.make_dt_interval(F.lit(0), F.hour(ts), F.lit(0), F.lit(0))


def days_from_to(start: Column, end: Column) -> Column:
    """Array of days start..end; empty where start lies after end."""
    return F.when(start <= end, F.sequence(start, end)).otherwise(F.array().cast("array<date>"))


def months_from_to(start: Column, end: Column) -> Column:
    """Array of month starts start..end; empty where start lies after end."""
    step = F.expr("interval 1 month")
    return F.when(start <= end, F.sequence(start, end, step)).otherwise(F.array().cast("array<date>"))
