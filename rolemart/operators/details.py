"""User-day snapshots: a spine of active users with an array of typed detail rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

SNAPSHOT_KEYS = ("role_id", "part_date")


def active_spine(log: DataFrame) -> DataFrame:
    """One row per user, event day and partition day seen in the log."""
    return log.select("part_date", "date", "role_id").distinct()


def collect_details(rows: DataFrame, fields: Sequence[str], name: str) -> DataFrame:
    """Pack one row per entity into an ordered array per user-day.

    The input is aggregated to one row per user-day and entity first, so an array
    never holds more elements than the game has entities.
    """
    packed = F.array_sort(F.collect_list(F.struct(*fields)))
    return rows.groupBy(*SNAPSHOT_KEYS).agg(packed.alias(name))


def attach_details(spine: DataFrame, *details: DataFrame) -> DataFrame:
    """Left join detail arrays onto the spine; users without details keep NULL."""
    for detail in details:
        spine = spine.join(detail, list(SNAPSHOT_KEYS), "left")
    return spine


def explode_details(df: DataFrame, name: str, keep: Sequence[str]) -> DataFrame:
    """One row per detail; NULL and empty arrays give none."""
    return df.select(*keep, F.inline(name))


def latest_non_null(value: str, *order: str) -> Column:
    """Aggregate: the last non-NULL value by the given order, without a window or a sort of the group."""
    ordering = F.when(F.col(value).isNotNull(), F.struct(*order))
    return F.max_by(value, ordering)


def newest_row_value(value: str, when: str) -> Column:
    """Aggregate: value of the newest row; of rows at the same time the smallest value, NULL last."""
    return F.max_by(value, F.struct(F.col(when), (-F.col(value)).alias("tie")))
