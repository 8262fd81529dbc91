"""Run registered queries on Spark and their SQL on DuckDB, and compare the rows.

usage: python -m harness.verify [--sf-dir DIR] [name ...]
"""

from __future__ import annotations

import argparse
import sys
import time
from collections import Counter
from datetime import datetime
from decimal import Decimal

import duckdb
from pyspark.sql import SparkSession

from harness.registry import spark_queries, sql_queries

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLE_NAMES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _plain(value):
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(value, Decimal):
        return format(value.normalize(), "f")
    return value


def _type(name: str) -> str:
    """A type name both engines agree on; decimals keep their scale only."""
    name = name.lower().replace("timestamp_ntz", "timestamp").replace("string", "varchar").replace("integer", "int")
    if name.startswith("decimal"):
        return "decimal scale " + name.rstrip(")").split(",")[-1].strip()
    return name


# Operators no plan may contain: joins of all pairs, and Python in the data path.
BANNED = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval", "MapInPandas", "BatchEvalPython")


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> str:
    """Empty text where rows, column names and types agree and the plan is sound; otherwise what is wrong."""
    frame = spark_queries()[name](spark, sf_dir)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    if any(operator in plan for operator in BANNED):
        return f"plan contains one of {BANNED}"
    columns = sorted(frame.columns)
    types = {f.name: _type(f.dataType.simpleString()) for f in frame.schema.fields}
    got = Counter(tuple(_plain(v) for v in row) for row in frame.select(*columns).collect())
    result = con.sql(sql_queries()[name])
    expected_types = {c: _type(str(d)) for c, d in zip(result.columns, result.types)}
    if columns != sorted(result.columns):
        return f"columns {columns} vs {sorted(result.columns)}"
    order = [result.columns.index(c) for c in columns]
    want = Counter(tuple(_plain(row[i]) for i in order) for row in result.fetchall())
    problems = []
    if types != expected_types:
        problems.append(f"types {[(c, types[c], expected_types[c]) for c in columns if types[c] != expected_types[c]]}")
    if got != want:
        only_got, only_want = got - want, want - got
        problems.append(
            f"{sum(got.values())} vs {sum(want.values())} rows; {sum(only_got.values())} only in Spark, e.g. "
            f"{list(only_got)[:2]}; {sum(only_want.values())} only in SQL, e.g. {list(only_want)[:2]}; columns {columns}"
        )
    return "; ".join(problems)


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(args.sf_dir), 0
    for name in args.names or spark_queries():
        began = time.time()
        try:
            problem = compare(spark, con, name, args.sf_dir)
        except Exception as error:  # report every query, then fail
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - began:.1f}s {problem}", flush=True)
    print(f"{bad} of {len(args.names or spark_queries())} differ")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
