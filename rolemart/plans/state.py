"""Stored partial aggregates, so that a run over new days need not read the days before.

A checkpoint holds one merged row per key over all partitions up to its day. A run continues the newest checkpoint before its
window with the partitions since, and writes a checkpoint at the window's end. Rows of a rerun range are taken back by falling
behind the range: checkpoints from its first day on are dropped, and an older one, or the history where none is left, is
continued. So runs in any order give what one run over everything gives.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from rolemart.config import RunWindow
from rolemart.sources.sinks import file_system

_KEPT = 4


@dataclass(frozen=True)
class Mergeable:
    """``partial`` folds rows to one per key; ``merges`` names the aggregate (min, max, sum) that joins two of them."""

    keys: tuple[str, ...]
    partial: Callable[[DataFrame], DataFrame]
    merges: Mapping[str, str]

    def merge(self, parts: DataFrame) -> DataFrame:
        how = [getattr(F, kind)(column).cast(parts.schema[column].dataType).alias(column) for column, kind in self.merges.items()]
        return parts.groupBy(*self.keys).agg(*how)


class Checkpoints:
    """Folders ``as_of=<day>`` under ``folder``. One without a success mark was not completed and counts as absent."""

    def __init__(self, spark: SparkSession, folder: str, spec: Mergeable | None, kept: int = _KEPT) -> None:
        self.spark, self.folder, self.spec, self.kept = spark, folder, spec, kept

    def _path(self, day: str) -> str:
        return f"{self.folder}/as_of={day}"

    def days(self) -> list[str]:
        """Days of the complete checkpoints, in order."""
        fs, folder = file_system(self.spark, self.folder)
        if not fs.exists(folder):
            return []
        named = [s.getPath().getName().removeprefix("as_of=") for s in fs.listStatus(folder)]
        return sorted(d for d in named if fs.exists(file_system(self.spark, f"{self._path(d)}/_SUCCESS")[1]))

    def _drop(self, days: list[str]) -> None:
        for day in days:
            fs, path = file_system(self.spark, self._path(day))
            fs.delete(path, True)

    def forget(self, first_day: str) -> None:
        """Drop what covers ``first_day`` or a later one; called before rows of these days change."""
        self._drop([d for d in self.days() if d >= first_day])

    def _since(self, rows: DataFrame, day: str | None) -> DataFrame:
        return rows if day is None else rows.where(F.col("part_date") > day)

    def _with_base(self, base: str | None, rows: DataFrame) -> DataFrame:
        parts = self.spec.partial(self._since(rows, base))
        if base is not None:
            parts = self.spark.read.schema(parts.schema).parquet(self._path(base)).unionByName(parts)
        return self.spec.merge(parts)

    def _base(self, first_day: str) -> str | None:
        return max((d for d in self.days() if d < first_day), default=None)

    def newest(self, first_day: str, schema: str) -> tuple[str, DataFrame] | None:
        """Day and rows of the newest checkpoint before ``first_day``."""
        base = self._base(first_day)
        return None if base is None else (base, self.spark.read.schema(schema).parquet(self._path(base)))

    def store(self, rows: DataFrame, window: RunWindow) -> None:
        """Write ``rows`` as the checkpoint of the window's end; those from the window's start on are dropped, and the oldest ones."""
        self.forget(window.start_date)
        rows.write.mode("overwrite").parquet(self._path(window.end_date))
        self._drop(self.days()[: -self.kept])

    def before(self, rows: DataFrame, day: str) -> DataFrame:
        """One row per key over the partitions before ``day``; nothing is written."""
        return self._with_base(self._base(day), rows.where(F.col("part_date") < day))

    def advance(self, rows: DataFrame, window: RunWindow) -> DataFrame:
        """One row per key over all partitions; the state at the window's end is stored."""
        self.forget(window.start_date)
        merged = self._with_base(self._base(window.start_date), rows.where(F.col("part_date") <= window.end_date))
        # an attempt that was cut off may have left files; they have no success mark and are replaced
        merged.write.mode("overwrite").parquet(self._path(window.end_date))
        result = self._with_base(window.end_date, rows)
        self._drop(self.days()[: -self.kept])
        return result
