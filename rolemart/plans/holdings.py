"""What users hold: best state per entity over all time, tracked item balances, hero progress."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from rolemart.config import TRAILING_DAYS, Game
from rolemart.functions.nested import zipped
from rolemart.functions.text import digit_at
from rolemart.operators.details import explode_details
from rolemart.operators.users import user_metrics
from rolemart.plans.state import Mergeable
from rolemart.sources.logs import trailing


def hero_best(heroes: DataFrame) -> DataFrame:
    """Highest level and star per user and hero. Snapshots hold no power, so it stays NULL."""
    rows = explode_details(heroes, "hero_detail", ["role_id"])
    return rows.groupBy("role_id", "hero_id").agg(
        F.max("hero_level").alias("hero_level"),
        F.lit(None).cast("bigint").alias("hero_power"),
        F.max("hero_star").alias("hero_star"),
    )


def flag_best(flags: DataFrame) -> DataFrame:
    """Highest level, star and awakening per user and flag."""
    rows = explode_details(flags, "flag_detail", ["role_id"])
    return rows.groupBy("role_id", "flag_id").agg(
        *[F.max(c).alias(c) for c in ("flag_level", "flag_star", "flag_awake")]
    )


def artifact_best(artifacts: DataFrame) -> DataFrame:
    """Highest level per user and artifact over both slots.

    The slots are paired by position; where one is shorter its partner is a NULL artifact,
    which the report keeps as a row of its own.
    """
    pairs = artifacts.select("role_id", F.inline(zipped(F.col("artifact1_detail"), F.col("artifact2_detail"))))
    both = F.array(
        F.struct(F.col("left.artifact1_id").alias("artifact_id"), F.col("left.artifact1_level").alias("level")),
        F.struct(F.col("right.artifact2_id").alias("artifact_id"), F.col("right.artifact2_level").alias("level")),
    )
    rows = pairs.select("role_id", F.inline(both))
    return rows.groupBy("role_id", "artifact_id").agg(F.max("level").alias("artifact_level"))


#: The best states can be merged over any sets of days.
HEROES = Mergeable(("role_id", "hero_id"), hero_best, {"hero_level": "max", "hero_power": "max", "hero_star": "max"})
FLAGS = Mergeable(("role_id", "flag_id"), flag_best, {"flag_level": "max", "flag_star": "max", "flag_awake": "max"})
ARTIFACTS = Mergeable(("role_id", "artifact_id"), artifact_best, {"artifact_level": "max"})


def first_seen(hero_log: DataFrame) -> DataFrame:
    """The first day a hero was seen in a zone."""
    hero, zone = F.col("hero_id").cast("string").alias("hero_id"), F.col("zone_id").cast("string").alias("zone_id")
    return hero_log.groupBy(hero, zone).agg(F.min(F.to_date("event_time")).alias("start_date"))


FIRST_SEEN = Mergeable(("hero_id", "zone_id"), first_seen, {"start_date": "min"})


def item_end(items: DataFrame, game: Game, latest_only: bool = False) -> DataFrame:
    """Balance of tracked items: one row per user, item and snapshot day, or only the last one.

    Item ids compare as text. Two snapshots of the same event day share the later balance.
    """
    low, high = game.tracked_items
    rows = explode_details(items, "item_detail", ["role_id", "date", "part_date"]).where(
        F.col("item_id").between(low, high)
    )
    if latest_only:
        newest = F.max_by("item_end", F.struct("date", "part_date"))
        return rows.groupBy("role_id", "item_id").agg(newest.alias("item_end"))
    day = (
        Window.partitionBy("role_id", "item_id", "date").orderBy("part_date")
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return rows.select("role_id", "item_id", F.last("item_end").over(day).alias("item_end"))


def hero_upgrade(
    star_log: DataFrame, hero_log: DataFrame, daily: DataFrame, info: DataFrame, end_date: str, days: int = TRAILING_DAYS,
    seen_first: DataFrame | None = None,
) -> DataFrame:
    """Star upgrades of the trailing days next to holders, first sight of the hero and active users.

    ``seen_first`` has the first days where they are known; otherwise the whole hero log is read for them.
    """
    hero, zone = F.col("hero_id").cast("string").alias("hero_id"), F.col("zone_id").cast("string").alias("zone_id")
    raised = trailing(star_log, end_date, days).select(
        "role_id", zone, F.col("hero").cast("string").alias("hero_id"),
        digit_at(F.col("fromrare"), 3).alias("hero_star"), "costchip",
    )
    upgrades = user_metrics(
        raised, ["hero_id", "zone_id", "hero_star"], {"upgrade_users": None},
        {"upgrade_count": F.lit(1), "chip_cost": F.col("costchip")},
    )
    best = trailing(hero_log, end_date, days).groupBy("role_id", hero, zone).agg(F.max("herostar").alias("hero_star"))
    holders = user_metrics(best, ["hero_id", "zone_id", "hero_star"], {"hold_users": None})
    seen = trailing(daily, end_date, days).select("role_id").distinct()
    active = user_metrics(
        seen.join(info.select("role_id", "zone_id"), "role_id", "left"), ["zone_id"], {"active_users": None}
    )
    return (
        upgrades.join(holders, ["hero_id", "zone_id", "hero_star"], "left")
        .join(first_seen(hero_log) if seen_first is None else seen_first, ["hero_id", "zone_id"], "left")
        .join(active, "zone_id", "left")
    )
