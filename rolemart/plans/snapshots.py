"""User-day snapshots of items, draws, heroes, flags and artifacts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rolemart.config import BULK_DRAW
from rolemart.functions.text import digit_at
from rolemart.operators.details import (
    SNAPSHOT_KEYS,
    active_spine,
    attach_details,
    collect_details,
    latest_non_null,
)


def item_snapshot(base_log: DataFrame, item_log: DataFrame) -> DataFrame:
    """Items added, spent and left over per user-day; one pass over the item log."""
    per_item = item_log.groupBy(*SNAPSHOT_KEYS, "item_id").agg(
        F.sum(F.when(F.col("event_name") == "AddItem", F.col("item_add"))).alias("item_add"),
        F.sum(F.when(F.col("event_name") == "CostItem", F.col("item_cost"))).alias("item_cost"),
        latest_non_null("item_remain", "event_time", "item_remain").alias("item_end"),
    )
    details = collect_details(per_item, ["item_id", "item_add", "item_cost", "item_end"], "item_detail")
    return attach_details(active_spine(base_log), details)


def summon_snapshot(base_log: DataFrame, summon_log: DataFrame) -> DataFrame:
    """Draws per user-day, pool and currency: free, paid, in bulk, and what they cost."""
    drawn = F.col("count")
    per_pool = summon_log.groupBy(
        *SNAPSHOT_KEYS, F.col("recruitid").cast("string").alias("summon_id"), F.col("currency_id").cast("string").alias("currency_id")
    ).agg(
        F.sum("currency_num").alias("currency_num"),
        F.sum(F.when(F.col("is_free") == 1, drawn)).alias("summon_free"),
        F.sum(F.when(F.col("is_free") == 0, drawn)).alias("summon_valid"),
        F.sum(drawn).alias("summon_count"),
        F.sum(F.when(drawn == BULK_DRAW, F.lit(BULK_DRAW).cast("bigint"))).alias("summon_continue"),
    )
    fields = ["summon_id", "currency_id", "currency_num", "summon_free", "summon_valid", "summon_count", "summon_continue"]
    return attach_details(active_spine(base_log), collect_details(per_pool, fields, "summon_detail"))


def hero_snapshot(base_log: DataFrame, star_log: DataFrame, level_log: DataFrame) -> DataFrame:
    """Heroes raised per user-day: highest star before raising, largest chip cost, highest level.

    Both upgrade logs are first reduced per event day and then meet in a full join, so a
    hero with two event days in both logs yields each pairing of those days.
    """
    keys = [*SNAPSHOT_KEYS, "hero_id"]
    stars = (
        star_log.select(
            *SNAPSHOT_KEYS, "date", F.col("hero").cast("string").alias("hero_id"),
            digit_at(F.col("fromrare"), 3).alias("hero_star"), F.col("costchip").alias("chip_cost"),
        )
        .groupBy(*keys, "date").agg(F.max("hero_star").alias("hero_star"), F.max("chip_cost").alias("chip_cost"))
    )
    levels = (
        level_log.select(*SNAPSHOT_KEYS, "date", F.col("hero").cast("string").alias("hero_id"), F.col("tolv").alias("hero_level"))
        .groupBy(*keys, "date").agg(F.max("hero_level").alias("hero_level"))
    )
    raised = stars.drop("date").join(levels.drop("date"), keys, "full")
    details = collect_details(raised, ["hero_id", "hero_level", "hero_star", "chip_cost"], "hero_detail")
    return attach_details(active_spine(base_log), details)


def flag_snapshot(base_log: DataFrame, hero_log: DataFrame) -> DataFrame:
    """Highest flag level, star and awakening per user-day; id 0 means no flag."""
    best = (
        hero_log.where(F.col("flag_id") != 0)
        .groupBy(*SNAPSHOT_KEYS, F.col("flag_id").cast("string").alias("flag_id"))
        .agg(*[F.max(c).alias(c) for c in ("flag_level", "flag_star", "flag_awake")])
    )
    details = collect_details(best, ["flag_id", "flag_level", "flag_star", "flag_awake"], "flag_detail")
    return attach_details(active_spine(base_log), details)


def artifact_snapshot(base_log: DataFrame, hero_log: DataFrame) -> DataFrame:
    """Highest level per artifact and slot. Both slots come out of one scan and one grouping."""
    slots = F.array(
        *[
            F.struct(
                F.lit(n).alias("slot"), F.col(f"artifact{n}_id").alias("id"), F.col(f"artifact{n}_level").alias("level")
            )
            for n in (1, 2)
        ]
    )
    best = (
        hero_log.where("artifact1_id != 0 or artifact2_id != 0")
        .select(*SNAPSHOT_KEYS, F.inline(slots))
        .where(F.col("id") != 0)
        .groupBy(*SNAPSHOT_KEYS, "slot", F.col("id").cast("string").alias("id"))
        .agg(F.max("level").alias("level"))
    )

    def packed(n: int):
        row = F.struct(F.col("id").alias(f"artifact{n}_id"), F.col("level").alias(f"artifact{n}_level"))
        rows = F.array_sort(F.collect_list(F.when(F.col("slot") == n, row)))
        return F.when(F.size(rows) > 0, rows).alias(f"artifact{n}_detail")

    details = best.groupBy(*SNAPSHOT_KEYS).agg(packed(1), packed(2))
    return attach_details(active_spine(base_log), details)
