"""Raw game logs: one declared form per log, whatever shape its files have, and a quarantine for rows that do not parse.

Games and versions write the same log with other columns, names and types. A log is declared once; its files are read in
the shapes they have, missing columns become NULL, and every value is cast without failing the job. A row is set apart
with all its faults if a required value is missing (blank text included) or a value that is there cannot be read as its declared type. What is
left is the log the models read.

Nothing is guessed: blank text in a column that is not text means absent; whole numbers that arrive with decimals are
rounded; an id that arrives as a floating number is kept only where that number is exact. A column whose stored type is the
declared one needs no test, so it is read only by models that use it.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    BooleanType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, NumericType, ShortType,
    StringType, StructType, TimestampNTZType, TimestampType,
)

from rolemart.config import RunWindow
from rolemart.sources.sinks import data_files, file_system
from rolemart.sources.tables import Table

_WHOLE = (ByteType, ShortType, IntegerType, LongType)
_FLOATING = (FloatType, DoubleType)
_TIMES = (DateType, TimestampType, TimestampNTZType)
#: Whole numbers up to here are exact in a double.
_EXACT = 2**53


@dataclass(frozen=True)
class RawLog:
    """A log's columns; ``also`` lists further names a column is known by, ``required`` what every row must have."""

    name: str
    ddl: str
    also: dict[str, tuple[str, ...]] = field(default_factory=dict)
    required: tuple[str, ...] = ("part_date", "role_id", "event_time")

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)


_EVENT = "part_date string, event_time timestamp_ntz, date date, role_id string"
_ACCOUNT = "open_id string, zone_id string, channel string, os string, alliance_id string, vip_level bigint, level bigint, rank_level bigint"
_MONEY = "payment_itemid string, currency string, money decimal(32,4), exchange_rate decimal(12,6), money_rmb decimal(32,4)"
_ALSO = {"alliance_id": ("guild_id",), "rank_level": ("rank",)}

# Column names and types of the raw logs.
RAW_LOGS = {
    log.name: log
    for log in (
        RawLog(
            "base_log",
            f"{_EVENT}, event_name string, {_ACCOUNT}, {_MONEY}, online_time bigint, adid string, device_id string, power bigint",
            _ALSO,
        ),
        RawLog(
            "payment_log",
            f"{_EVENT}, event_name string, {_ACCOUNT}, {_MONEY}, web_rmb decimal(32,4), pay_source string", _ALSO,
        ),
        RawLog(
            "item_log",
            f"{_EVENT}, event_name string, {_ACCOUNT}, item_id string, item_add bigint, item_cost bigint, item_remain bigint", _ALSO,
        ),
        RawLog(
            "core_log", f"{_EVENT}, event_type string, reason string, free_num bigint, paid_num bigint, core_end bigint",
            required=("part_date", "role_id"),
        ),
        RawLog(
            "summon_log",
            f"{_EVENT}, recruitid string, count bigint, is_free int, currency_id string, currency_num bigint",
        ),
        RawLog(
            "herosnap_log",
            f"{_EVENT}, zone_id string, hero_id bigint, herostar bigint, flag_id bigint, flag_level bigint, flag_star bigint, "
            "flag_starran bigint, flag_awake bigint, artifact1_id bigint, artifact1_level bigint, artifact2_id bigint, "
            "artifact2_level bigint",
        ),
        RawLog(
            "upgraderare_log",
            f"{_EVENT}, zone_id string, hero string, fromrare string, torare string, costchip bigint, remainchip bigint, "
            "newskill string",
        ),
        RawLog("upgradehero_log", f"{_EVENT}, zone_id string, hero string, fromlv bigint, tolv bigint"),
        RawLog(
            "token_log",
            f"{_EVENT}, event_type string, reason string, reason_id string, reason_subid string, item_id string, "
            "item_num bigint, item_end bigint",
        ),
    )
}

#: Rows set apart: all faults of a row, and the row as it came.
QUARANTINE = Table(
    "quarantine", "di", "log string, role_id string, faults array<string>, record string, part_date string", "part_date"
)


def _read_as(source: Column, have: DataType, want: DataType) -> Column:
    """The value in the declared type, NULL where it cannot be read so."""
    if have == want:
        return source
    if isinstance(want, StringType):
        if isinstance(have, _FLOATING):
            exact = (source == F.floor(source)) & (F.abs(source) <= _EXACT)
            return F.when(exact, source.cast("decimal(20,0)").cast("string"))
        return source.cast("string")
    if isinstance(have, StringType):
        text = F.trim(source)
        return F.when(text != "", text.try_cast(want))
    if isinstance(want, _WHOLE) and isinstance(have, (*_FLOATING, DecimalType)):
        return F.round(source).try_cast(want)
    alike = any(isinstance(have, kind) and isinstance(want, kind) for kind in (NumericType, _TIMES))
    alike = alike or (isinstance(have, BooleanType) and isinstance(want, _WHOLE))
    return (source if alike else source.cast("string")).try_cast(want)


def _lossless(have: DataType, want: DataType) -> bool:
    """Every value of the stored type has one in the declared type, so no row needs a test."""
    if have == want or (isinstance(want, StringType) and not isinstance(have, _FLOATING)):
        return True
    return isinstance(have, _WHOLE) and isinstance(want, _WHOLE) and _WHOLE.index(type(have)) <= _WHOLE.index(type(want))


def _is_there(source: Column, have: DataType, want: DataType) -> Column:
    blank_is_absent = isinstance(have, StringType) and not isinstance(want, StringType)
    return F.trim(source) != "" if blank_is_absent else source.isNotNull()


def reconcile(raw: DataFrame, log: RawLog) -> tuple[DataFrame, Column]:
    """The rows with their declared columns (as ``read``) beside their own (as ``record``), and the faults of a row.

    A column stored under several of its names has the first value that is there. Without a ``date``, an event's day is
    that of its time, or else of its partition. Columns that are not declared stay in ``record`` only.
    """
    stored = {f.name.lower(): f for f in raw.schema.fields}
    values, faults = {}, []
    for column in log.schema.fields:
        found = [stored[n] for n in (column.name, *log.also.get(column.name, ())) if n in stored]
        sources = [(F.col("`" + f.name.replace("`", "``") + "`"), f.dataType) for f in found]
        read = [_read_as(source, have, column.dataType) for source, have in sources]
        values[column.name] = (F.coalesce(*read) if len(read) > 1 else read[0] if read else F.lit(None)).cast(column.dataType)
        unread = [
            _is_there(source, have, column.dataType) & value.isNull()
            for (source, have), value in zip(sources, read) if not _lossless(have, column.dataType)
        ]
        if unread:
            wrong = functools.reduce(lambda a, b: a | b, unread)
            faults.append(F.when(wrong, F.lit(f"{column.name} is not {column.dataType.simpleString()}")))
            missing = values[column.name].isNull() & ~F.coalesce(wrong, F.lit(False))
        else:
            missing = values[column.name].isNull()
        if column.name in log.required:
            if isinstance(column.dataType, StringType):
                missing = missing | (F.trim(values[column.name]) == "")
            faults.append(F.when(missing, F.lit(f"no {column.name}")))
    if "date" in values:
        days = [values[n].cast("date") if n == "event_time" else values[n].try_cast("date") for n in ("event_time", "part_date") if n in values]
        values["date"] = F.coalesce(values["date"], *days)
    rows = raw.select(
        F.struct(*[value.alias(name) for name, value in values.items()]).alias("read"),
        F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in raw.columns]).alias("record"),
        F.array_compact(F.array(*faults) if faults else F.array().cast("array<string>")).alias("faults"),
    )
    return rows, F.col("faults")


def accepted(raw: DataFrame, log: RawLog) -> DataFrame:
    """Rows without faults, in the declared columns."""
    rows, faults = reconcile(raw, log)
    return rows.where(F.size(faults) == 0).select("read.*")


def set_apart(raw: DataFrame, log: RawLog) -> DataFrame:
    """Rows with faults, as ``QUARANTINE`` has them. A row without a partition day keeps a NULL there."""
    rows, faults = reconcile(raw, log)
    return rows.where(F.size(faults) > 0).select(
        F.lit(log.name).alias("log"), "read.role_id", "faults", F.to_json("record").alias("record"), "read.part_date"
    )


def fault_counts(quarantine: DataFrame) -> DataFrame:
    """Rows per log, day and fault; a row with two faults counts in both."""
    return quarantine.select("log", "part_date", F.explode("faults").alias("fault")).groupBy("log", "part_date", "fault").agg(
        F.count(F.lit(1)).alias("row_count")
    )


def _union(parts: list[DataFrame], empty: DataFrame) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, parts) if parts else empty


def accepted_shapes(spark: SparkSession, shapes: list[DataFrame], log: RawLog) -> DataFrame:
    return _union([accepted(s, log) for s in shapes], spark.createDataFrame([], log.schema))


def set_apart_shapes(spark: SparkSession, shapes: list[DataFrame], log: RawLog) -> DataFrame:
    return _union([set_apart(s, log) for s in shapes], spark.createDataFrame([], QUARANTINE.schema))


def read_shapes(spark: SparkSession, path: str, window: RunWindow | None = None) -> list[DataFrame]:
    """The log's files, one frame per group of files whose types agree; of a window, only its partitions are looked at.

    Files that only lack columns are one group, found by one distributed read of their footers. Where types clash, the
    partitions are halved until they agree, so a type that changed on one day costs a few more such reads; within a
    partition its files are. An absent log is an error, a window without partitions is not.
    """
    fs, root = file_system(spark, path)
    if not fs.exists(root):
        return [spark.read.parquet(path)]  # raises, naming the path
    folders = [s.getPath().getName() for s in fs.listStatus(root) if s.getPath().getName().startswith("part_date=")]
    if window is not None:
        folders = [f for f in folders if window.start_date <= f.removeprefix("part_date=") <= window.end_date]
        if not folders:
            return []
    groups: dict[str, list[str]] = {}
    schemas: dict[str, StructType] = {}
    for schema, paths in _agreeing(spark, path, sorted(f"{path}/{f}" for f in folders) or [path]):
        schemas[schema.json()] = schema
        groups.setdefault(schema.json(), []).extend(paths)
    if window is None and len(groups) == 1:
        groups = {key: [path] for key in groups}
    return [
        _text_days(spark.read.option("basePath", path).schema(schemas[key]).parquet(*paths)) for key, paths in groups.items()
    ]


def _text_days(frame: DataFrame) -> DataFrame:
    if "part_date" not in frame.columns:
        return frame
    return frame.withColumn("part_date", F.col("part_date").cast("string"))


def _agreeing(spark: SparkSession, base: str, paths: list[str]) -> list[tuple[StructType, list[str]]]:
    """The paths in parts whose files merge into one schema each."""
    try:
        return [(spark.read.option("basePath", base).option("mergeSchema", True).parquet(*paths).schema, paths)]
    except (PySparkException, Py4JJavaError) as clash:  # Spark's own exception class is not translated everywhere
        if "CANNOT_MERGE" not in str(clash):
            raise
    if len(paths) == 1:
        paths = data_files(spark, paths[0])
    half = len(paths) // 2
    return _agreeing(spark, base, paths[:half]) + _agreeing(spark, base, paths[half:])
