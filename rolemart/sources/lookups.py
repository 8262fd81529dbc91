"""Lookup tables: uploaded CSV dimensions, monthly currency rates, the token price list.

None of them is broadcast unseen: rates are counted first (``join_lookup``), the price list
is a literal, and for the others Spark compares the size it knows with its own threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rolemart.config import Game

# Column names of the uploaded dimension files. Ids are text: account ids
# do not fit a double.
DIMENSIONS = {
    "activity": ("act_name", "start_date", "end_date", "code", "month"),
    "activity_stage": ("act_id", "act_sid", "act_type", "act_name"),
    "advert_icon": ("icon_id", "icon_name"),
    "battle_map": ("map_id", "map_type", "map_cn"),
    "battle_skill": ("skill_id", "skill_type", "skill_name"),
    "core_reason": ("id", "reason_cn"),
    "flag": ("flag_id", "flag_cn", "grade"),
    "guide_step": ("group_id", "step_id", "is_compulsory", "step_num", "step_name", "union_step"),
    "hero": ("hero_id", "hero_cn", "type", "grade", "is_season", "shard_id", "start_date"),
    "install_step": ("event_name", "event_token", "step_name", "is_compulsory", "step_num", "union_step"),
    "item": ("item_id", "color", "item_name"),
    "item_reason": ("reason", "reason_cn"),
    "payment_item": ("payment_itemid", "payment_name", "payment_cate", "payment_act", "limit_num", "limit_type", "money"),
    "shop": ("shop_id", "shop_name"),
    "summon": ("summon_id", "summon_cn", "summon_type"),
    "test_accounts": ("role_id",),
}


def read_dimension(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A CSV dimension as text columns, by name: files of different games order or omit columns differently."""
    wanted = DIMENSIONS[name]
    raw = (
        spark.read.option("header", True).option("inferSchema", False)
        .option("quote", '"').option("escape", '"').option("encoding", "UTF-8").csv(path)
    )
    present = {c.lstrip("﻿").strip(): c for c in raw.columns}
    return raw.select(
        *[(F.col(f"`{present[c]}`") if c in present else F.lit(None).cast("string")).alias(c) for c in wanted]
    )


def calendar_day(text: Column) -> Column:
    """Day of an uploaded calendar; months and days may come without a leading zero."""
    return text.cast("date")


def read_rates_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """Rates kept in an operational database; land them as a table before joining a log to them."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def currency_rates(rates: DataFrame, currency: str) -> DataFrame:
    """Monthly home-currency rates of one currency."""
    return rates.where(F.col("currency") == currency).select(
        "currency_time", F.col("rate").alias("exchange_rate")
    )


def token_price_list(spark: SparkSession, game: Game) -> DataFrame:
    """Tokens granted per payment item, as rows."""
    rows = F.array(
        *[
            F.struct(F.lit(item).alias("payment_itemid"), F.lit(tokens).cast("bigint").alias("token_num"))
            for item, tokens in game.token_packs
        ]
    )
    return spark.range(1).select(F.inline(rows))


def token_price(payment_itemid: Column, game: Game) -> Column:
    """The same list as a lookup inside the scan; NULL for items that are not on it."""
    listed = [F.lit(v) for item, tokens in game.token_packs for v in (item, tokens)]
    return F.element_at(F.create_map(*listed), payment_itemid).cast("bigint")
