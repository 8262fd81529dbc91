"""Query registry: a Spark function and the SQL that must give the same rows, side by side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from harness.logs import Logs
from harness.views import complete

_SPARK: dict[str, Callable[[Logs], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str):
    def register(build: Callable[[Logs], DataFrame]) -> Callable[[Logs], DataFrame]:
        if name in _SPARK:
            raise ValueError(f"query {name} is registered twice")
        _SPARK[name], _SQL[name] = build, sql
        return build

    return register


def _load() -> None:
    from harness import queries_checks, queries_functions, queries_models, queries_raw, queries_relational, queries_tables  # noqa: F401


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()

    def bound(build):
        return lambda spark, sf_dir: build(Logs(spark, sf_dir))

    return {name: bound(build) for name, build in _SPARK.items()}


def sql_queries() -> dict[str, str]:
    _load()
    return {name: complete(sql) for name, sql in _SQL.items()}
