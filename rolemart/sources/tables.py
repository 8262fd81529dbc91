"""Declared output tables: column types, partition column and refresh kind."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

INCREMENTAL = ("di", "hi", "mi")


@dataclass(frozen=True)
class Table:
    """``refresh`` is the table-name suffix: d/h/m for the rhythm, i for a date range, f for everything."""

    model: str
    refresh: str
    ddl: str
    partition: str | None = None
    stored_as: str | None = None

    @property
    def name(self) -> str:
        return self.stored_as or f"{self.model}_{self.refresh}"

    @property
    def incremental(self) -> bool:
        return self.refresh in INCREMENTAL

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)


def conform(df: DataFrame, table: Table) -> DataFrame:
    """Columns by name, in the declared order and types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema.fields])


_KEY = "date date, role_id string"
_DIMS = "date date, zone_id string, channel string"

# The declared schemas of the stored tables.
TABLES = {
    t.model: t
    for t in (
        Table(
            "dws_user_daily", "di",
            f"{_KEY}, level_min bigint, level_max bigint, viplevel_min bigint, viplevel_max bigint, "
            "online_time bigint, exchange_rate decimal(12,6), pay_count bigint, money decimal(32,4), "
            "money_rmb decimal(32,4), web_rmb decimal(32,4), is_test int, login_ts timestamp_ntz, zone_id string, "
            "channel string, os string, pay_first struct<pay_ts:timestamp_ntz,good_id:string,level:bigint>, "
            "days array<struct<date:date,online_time:bigint,pay_count:bigint,money:decimal(32,4),money_rmb:decimal(32,4),"
            "web_rmb:decimal(32,4)>>, part_date string",
            "part_date",
        ),
        Table(
            "dws_user_info", "df",
            "role_id string, install_date date, lastlogin_ts timestamp_ntz, moneyrmb_ac decimal(32,4), "
            "firstpay_date date, firstpay_goodid string, firstpay_level bigint, zone_id string, channel string, "
            "os string, vip_level bigint, is_test int",
            stored_as="dws_user_info_di",
        ),
        Table(
            "dws_user_daily_derive", "di",
            f"{_KEY}, money_ac decimal(32,4), moneyrmb_ac decimal(32,4), is_new int, is_firstpay int, is_pay int, "
            "is_paid int, part_date string",
            "part_date",
        ),
        Table(
            "dws_user_hourly", "hi",
            "date date, hour timestamp_ntz, role_id string, money decimal(32,4), money_rmb decimal(32,4), "
            "exchange_rate decimal(12,6), part_date string",
            "part_date",
        ),
        Table(
            "dws_core_snapshot", "di",
            f"{_KEY}, coregain_detail map<string,bigint>, corecost_detail map<string,bigint>, core_end bigint, "
            "part_date string",
            "part_date",
        ),
        Table(
            "dws_item_snapshot", "di",
            f"{_KEY}, item_detail array<struct<item_id:string,item_add:bigint,item_cost:bigint,item_end:bigint>>, "
            "part_date string",
            "part_date",
        ),
        Table(
            "dws_summon_snapshot", "di",
            f"{_KEY}, summon_detail array<struct<summon_id:string,currency_id:string,currency_num:bigint,"
            "summon_free:bigint,summon_valid:bigint,summon_count:bigint,summon_continue:bigint>>, part_date string",
            "part_date",
        ),
        Table(
            "dws_hero_snapshot", "di",
            f"{_KEY}, hero_detail array<struct<hero_id:string,hero_level:bigint,hero_star:bigint,chip_cost:bigint>>, "
            "part_date string",
            "part_date",
        ),
        Table(
            "dws_flag_snapshot", "di",
            f"{_KEY}, flag_detail array<struct<flag_id:string,flag_level:bigint,flag_star:bigint,flag_awake:bigint>>, "
            "part_date string",
            "part_date",
        ),
        Table(
            "dws_artifact_snapshot", "di",
            f"{_KEY}, artifact1_detail array<struct<artifact1_id:string,artifact1_level:bigint>>, "
            "artifact2_detail array<struct<artifact2_id:string,artifact2_level:bigint>>, part_date string",
            "part_date",
        ),
        Table(
            "dws_token_monthly", "mf",
            "cal_month date, money_rmb decimal(32,4), users bigint, pay_users bigint, token_users bigint, "
            "token_get_by_pay bigint, token_get bigint, token_cost bigint, token_remain bigint, "
            "token_remain_lastmonth bigint, price decimal(32,4), diff bigint",
        ),
        Table(
            "ads_kpi_daily", "di",
            f"{_DIMS}, os string, new_users bigint, active_users bigint, pay_users bigint, paid_users bigint, "
            "install_pay bigint, newpay_users bigint, online_time bigint, pay_count bigint, money_rmb decimal(36,2), "
            "install_moneyrmb decimal(36,2), newpay_moneyrmb decimal(36,2), web_rmb decimal(36,2), "
            "webpay_users bigint, moneyrmb_ac decimal(36,2), newuser_ac bigint, part_date string",
            "part_date",
        ),
        Table(
            "ads_kpi_daily_hf", "hf",
            f"{_DIMS}, os string, active_users bigint, new_users bigint, retention1_newusers bigint, "
            "retention1_users bigint, paid_users bigint, pay_users bigint, firstpay_users bigint, "
            "firstdaypay_users bigint, money_rmb decimal(36,2), firstpay_rmb decimal(36,2), "
            "firstdaypay_rmb decimal(36,2), part_date string",
            "part_date",
            "ads_kpi_daily_hf",
        ),
        Table(
            "ads_kpi_monthly", "mi",
            "month date, zone_id string, channel string, os string, new_users bigint, active_users bigint, "
            "pay_users bigint, new_users_pay bigint, users_new_pay bigint, pay_count bigint, "
            "money_rmb decimal(36,2), new_users_moneyrmb decimal(36,2), users_new_moneyrmb decimal(36,2), "
            "new_users_ac bigint, moneyrmb_ac decimal(36,2), part_month string",
            "part_month",
        ),
        Table(
            "ads_level_daily", "di",
            f"{_DIMS}, level_max_daily bigint, level_hs bigint, level_hist string, users bigint, pay_users bigint, "
            "paid_users bigint, pay_count_daily bigint, money_rmb_daily decimal(36,2), part_date string",
            "part_date",
        ),
        Table(
            "ads_viplevel_daily", "di",
            f"{_DIMS}, os string, viplevel_max_daily bigint, users bigint, pay_users bigint, pay_count_daily bigint, "
            "money_rmb_daily decimal(36,2), part_date string",
            "part_date",
        ),
        Table(
            "ads_core_daily", "di",
            f"{_DIMS}, core_add bigint, core_cost bigint, core_end bigint, users bigint, users_add bigint, "
            "users_cost bigint, part_date string",
            "part_date",
        ),
        Table(
            "ads_item", "di",
            f"{_DIMS}, vip_level bigint, item_id string, item_add bigint, item_cost bigint, users bigint, "
            "part_date string",
            "part_date",
        ),
        Table("ads_item_end", "df", "role_id string, item_end bigint, item_id string", "item_id"),
        Table(
            "ads_summon", "di",
            "date date, dau bigint, summon_id string, currency_id string, users bigint, currency_num bigint, "
            "summon_free bigint, summon_valid bigint, summon_continue bigint, summon_count bigint, part_date string",
            "part_date",
        ),
        Table(
            "ads_hero", "df",
            "role_id string, hero_level bigint, hero_power bigint, hero_star bigint, hero_id string", "hero_id",
        ),
        Table(
            "ads_flag", "df",
            "role_id string, flag_level bigint, flag_star bigint, flag_awake bigint, flag_id string", "flag_id",
        ),
        Table("ads_artifact", "df", "role_id string, artifact_level bigint, artifact_id string", "artifact_id"),
        Table(
            "ads_hero_upgrade", "df",
            "hero_id string, zone_id string, start_date date, active_users bigint, hero_star bigint, "
            "hold_users bigint, upgrade_users bigint, upgrade_count bigint, chip_cost bigint",
        ),
        Table("ads_active_daily", "di", "dau bigint, part_date string", "part_date"),
        Table("ads_core_addreason", "di", "reason string, core_add bigint, part_date string", "part_date"),
        Table("ads_core_costreason", "di", "reason string, core_cost bigint, part_date string", "part_date"),
        Table("dws_user_number", "df", "role_id string, part int, nth bigint"),
        Table("dws_active_bitmap", "di", "part int, bucket bigint, users binary, part_date string", "part_date"),
        Table("ads_retention_daily", "di", "retention_day bigint, dau bigint, part_date string", "part_date"),
        Table("ads_user_retention", "df", "date date, retention_day bigint, active_users bigint",
              stored_as="ads_user_retention_di"),
        Table(
            "ads_kpi_hourly_hi", "hi",
            "hour timestamp_ntz, dau bigint, money_hourly decimal(32,4), new_users bigint, part_date string",
            "part_date",
            "ads_kpi_hourly_hi",
        ),
        Table("ads_kpi_hourly_hf", "hf", "hour timestamp_ntz, money decimal(32,4), part_date string", "part_date",
              "ads_kpi_hourly_hf"),
    )
}
