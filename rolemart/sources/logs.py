"""Scans of day-partitioned logs. Bounds stay on the raw text partition column, so Spark prunes partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rolemart.config import RunWindow


def read_log(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Read with the declared schema; inference would turn ``part_date`` into a DATE."""
    return spark.read.schema(ddl).parquet(path)


def in_window(log: DataFrame, window: RunWindow, column: str = "part_date") -> DataFrame:
    return log.where(F.col(column).between(window.start_date, window.end_date))


def trailing(log: DataFrame, end_date: str, days: int, column: str = "part_date") -> DataFrame:
    """The ``days`` days before ``end_date`` and that day itself."""
    return in_window(log, RunWindow.trailing(end_date, days), column)


def since(log: DataFrame, start_date: str, as_of: str, column: str = "part_date") -> DataFrame:
    return in_window(log, RunWindow(start_date, as_of), column)


def before(log: DataFrame, start_date: str, column: str = "part_date") -> DataFrame:
    return log.where(F.col(column) < start_date)
