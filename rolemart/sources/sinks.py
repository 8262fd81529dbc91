"""Idempotent writes of partitioned parquet tables."""

from __future__ import annotations

import uuid
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from rolemart.config import RunWindow
from rolemart.sources.tables import Table, conform


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path in its terms."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def _stored_days(spark: SparkSession, path: str, column: str, window: RunWindow) -> dict[str, set[str]]:
    """Data file names per partition of the window that is there. Only those folders are listed, by their names."""
    first = date.fromisoformat(window.start_date)
    found = {}
    for n in range((date.fromisoformat(window.end_date) - first).days + 1):
        value = (first + timedelta(days=n)).isoformat()
        files = _list_files(spark, f"{path}/{column}={value}")
        if files is not None:
            found[value] = files
    return found


def stored_partitions(spark: SparkSession, path: str, column: str) -> list[str]:
    """Partition values of a stored table in order, from the names of its folders; rows without a value are not among them."""
    fs, root = file_system(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
    return sorted(n.removeprefix(f"{column}=") for n in names if n.startswith(f"{column}=") and "__HIVE_DEFAULT" not in n)


def partition_span(spark: SparkSession, path: str, column: str) -> tuple[str, str] | None:
    """The smallest and the greatest partition value of a stored table."""
    values = stored_partitions(spark, path, column)
    return (values[0], values[-1]) if values else None


def last_partition(spark: SparkSession, path: str, column: str) -> str | None:
    span = partition_span(spark, path, column)
    return span and span[1]


def _list_files(spark: SparkSession, folder: str) -> set[str] | None:
    """Data files of a folder, None if it is not there."""
    fs, target = file_system(spark, folder)
    if not fs.exists(target):
        return None
    names = {f.getPath().getName() for f in fs.listStatus(target)}
    return {n for n in names if not n.startswith(("_", "."))}


def data_files(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the data files of a folder."""
    return sorted(f"{folder}/{name}" for name in _list_files(spark, folder) or ())


def _rename(fs, source, target) -> bool:
    """File systems report a refused rename as False or by an error; both count, and a target that is there refuses."""
    if fs.exists(target):
        return False
    return bool(fs.rename(source, target)) and fs.exists(target)


def _balanced(df: DataFrame, table: Table) -> DataFrame:
    """Group rows by partition for writing; AQE splits a big day and merges small ones."""
    return df.hint("rebalance", table.partition) if table.partition else df


def overwrite_range(df: DataFrame, table: Table, path: str, window: RunWindow) -> None:
    """Replace all partitions inside the window by the new rows, and nothing outside it.

    A row whose partition lies outside the window fails the job before anything is replaced: it would replace that
    partition by a fraction, and dropping it would lose it. Partitions with new rows are replaced when the job commits. A
    partition of the range that got no new rows still holds only its old files afterwards, and is then removed; dynamic
    overwrite alone would leave it.
    """
    spark, column = df.sparkSession, table.partition
    before = _stored_days(spark, path, column, window)
    rows = conform(df, table)
    inside = rows[column].between(window.start_date, window.end_date)
    outside = F.raise_error(F.concat(
        F.lit(f"{table.name}: a row of partition "), F.coalesce(rows[column].cast("string"), F.lit("NULL")),
        F.lit(f" is outside {window.start_date} to {window.end_date}")))
    rows = rows.withColumn(column, F.when(inside, rows[column]).otherwise(outside.cast("string")))
    (
        _balanced(rows, table).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column).parquet(path)
    )
    for value, files in _stored_days(spark, path, column, window).items():
        if files <= before.get(value, set()):
            fs, stale = file_system(spark, f"{path}/{column}={value}")
            fs.delete(stale, True)


def full_refresh(df: DataFrame, table: Table, path: str) -> None:
    """Replace the whole table; the old rows stay readable until the new ones are complete.

    If a rename is refused the old table is put back, the new rows are removed, and the refresh fails. The old rows are
    deleted only once the new ones are in place.
    """
    spark = df.sparkSession
    tag = uuid.uuid4().hex
    jpath = spark._jvm.org.apache.hadoop.fs.Path
    incoming, outgoing = jpath(f"{path}.incoming-{tag}"), jpath(f"{path}.outgoing-{tag}")
    writer = _balanced(conform(df, table), table).write.mode("errorifexists")
    if table.partition:
        writer = writer.partitionBy(table.partition)
    fs, target = file_system(spark, path)
    try:
        writer.parquet(incoming.toString())
    except Exception:
        fs.delete(incoming, True)
        raise
    had_rows = fs.exists(target)
    if had_rows and not _rename(fs, target, outgoing):
        fs.delete(incoming, True)
        raise OSError(f"{path} could not be set aside; it still holds the old rows")
    if not _rename(fs, incoming, target):
        if had_rows and not _rename(fs, outgoing, target):
            raise OSError(f"the new rows of {path} could not be put in place; the old ones are in {outgoing.toString()}")
        fs.delete(incoming, True)
        raise OSError(f"the new rows of {path} could not be put in place; it holds the old rows")
    if had_rows:
        fs.delete(outgoing, True)


def write_table(df: DataFrame, table: Table, path: str, window: RunWindow) -> None:
    if table.incremental:
        overwrite_range(df, table, path, window)
    else:
        full_refresh(df, table, path)


def read_table(spark: SparkSession, table: Table, path: str, *, may_be_absent: bool = False) -> DataFrame:
    """Stored rows in the declared types. An absent table is an error, or empty where a first run may find none."""
    try:
        return spark.read.schema(table.schema).parquet(path)
    except AnalysisException as missing:
        if not may_be_absent or missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], table.schema)
