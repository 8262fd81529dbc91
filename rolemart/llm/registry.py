"""The queries of this package and, where SQL can express them, the SQL that must give the same rows."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_SPARK: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        _SPARK[name] = build
        if sql is not None:
            _SQL[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def find_package(spark: SparkSession) -> None:
    """Let Python workers import this package also when it is neither installed nor in their working directory."""
    here = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if here not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([here, *filter(None, paths)])


def _load() -> None:
    from rolemart.llm import queries  # noqa: F401


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()

    def bound(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            find_package(spark)
            return build(spark, sf_dir)

        return run

    return {name: bound(build) for name, build in _SPARK.items()}


def sql_queries() -> dict[str, str]:
    _load()
    return dict(_SQL)
