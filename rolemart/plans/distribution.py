"""Level, VIP, currency, item and draw reports per day."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rolemart.config import LEVEL_BUCKET, RunWindow
from rolemart.functions.nested import map_total
from rolemart.functions.text import bucket_floor, bucket_label
from rolemart.operators.details import explode_details
from rolemart.operators.users import user_metrics, with_user_attrs
from rolemart.sources.logs import in_window


def level_daily(daily: DataFrame, info: DataFrame, window: RunWindow) -> DataFrame:
    """Users and payers per highest level of the day, with five-level buckets."""
    days = in_window(daily, window).select(
        "date", "part_date", "role_id", F.col("level_max").alias("level_max_daily"), "money", "pay_count", "money_rmb"
    )
    rows = with_user_attrs(days, info, ["zone_id", "channel", "moneyrmb_ac"])
    counted = user_metrics(
        rows,
        ["date", "part_date", "zone_id", "channel", "level_max_daily"],
        {"users": None, "pay_users": F.col("money") > 0, "paid_users": F.col("moneyrmb_ac") > 0},
        {"pay_count_daily": F.col("pay_count"), "money_rmb_daily": F.col("money_rmb")},
    )
    floor = bucket_floor(F.col("level_max_daily"), LEVEL_BUCKET)
    return counted.withColumns({"level_hs": floor, "level_hist": bucket_label(floor, LEVEL_BUCKET)})


def viplevel_daily(daily: DataFrame, info: DataFrame, window: RunWindow) -> DataFrame:
    """Users and payers per highest VIP level of the day."""
    days = in_window(daily, window).select(
        "date", "part_date", "role_id", F.col("viplevel_max").alias("viplevel_max_daily"), "money", "pay_count", "money_rmb"
    )
    return user_metrics(
        with_user_attrs(days, info, ["zone_id", "channel", "os"]),
        ["date", "part_date", "zone_id", "channel", "os", "viplevel_max_daily"],
        {"users": None, "pay_users": F.col("money") > 0},
        {"pay_count_daily": F.col("pay_count"), "money_rmb_daily": F.col("money_rmb")},
    )


def core_daily(core: DataFrame, info: DataFrame, window: RunWindow) -> DataFrame:
    """Core currency gained, spent and held per zone and channel."""
    days = in_window(core, window).select(
        "date", "part_date", "role_id", "core_end",
        map_total(F.col("coregain_detail")).alias("core_add"),
        map_total(F.col("corecost_detail")).alias("core_cost"),
    )
    return user_metrics(
        with_user_attrs(days, info, ["zone_id", "channel"]),
        ["date", "part_date", "zone_id", "channel"],
        {"users": None, "users_add": F.col("core_add") > 0, "users_cost": F.col("core_cost") > 0},
        {c: F.col(c) for c in ("core_add", "core_cost", "core_end")},
    )


def item_daily(items: DataFrame, info: DataFrame, window: RunWindow) -> DataFrame:
    """Item flow per zone, channel and VIP level. User attributes join before the details unfold."""
    attrs = ["zone_id", "channel", "vip_level"]
    days = with_user_attrs(in_window(items, window), info, attrs)
    rows = explode_details(days, "item_detail", ["date", "part_date", "role_id", *attrs])
    return user_metrics(
        rows,
        ["date", "part_date", *attrs, "item_id"],
        {"users": None},
        {"item_add": F.col("item_add"), "item_cost": F.col("item_cost")},
    )


def summon_daily(draws: DataFrame, info: DataFrame, window: RunWindow) -> DataFrame:
    """Draws per pool and currency next to the day's active users."""
    days = with_user_attrs(in_window(draws, window), info, [])
    active = user_metrics(days.select("date", "role_id"), ["date"], {"dau": None})
    sums = ("currency_num", "summon_free", "summon_valid", "summon_continue", "summon_count")
    per_pool = user_metrics(
        explode_details(days, "summon_detail", ["date", "part_date", "role_id"]),
        ["date", "part_date", "summon_id", "currency_id"],
        {"users": None},
        {c: F.col(c) for c in sums},
    )
    return per_pool.join(active, "date", "left")
