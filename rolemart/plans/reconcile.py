"""All reconciliation checks over the stored tables of one game."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from rolemart.plans import checks
from rolemart.plans.warehouse import Warehouse

Check = Callable[[Warehouse, str, str, bool], DataFrame]

# Arguments: warehouse, day of the check, moment of the check, whether to list mismatches only.
CHECKS: dict[str, Check] = {
    "4.1": lambda wh, day, now, only: checks.user_daily_money(wh.log("payment_log"), wh.table("dws_user_daily"), day),
    "4.2": lambda wh, day, now, only: checks.user_daily_unique(wh.table("dws_user_daily"), day),
    "4.3": lambda wh, day, now, only: checks.user_daily_money_by_user(
        wh.log("payment_log"), wh.table("dws_user_daily"), day
    ),
    "5.1": lambda wh, day, now, only: checks.user_info_coverage(wh.log("base_log"), wh.table("dws_user_info")),
    "5.2": lambda wh, day, now, only: checks.user_info_unique(wh.table("dws_user_info")),
    "6.1": lambda wh, day, now, only: checks.derive_total(wh.log("payment_log"), wh.table("dws_user_daily_derive"), day),
    "6.2": lambda wh, day, now, only: checks.derive_unique(wh.table("dws_user_daily_derive")),
    "6.3": lambda wh, day, now, only: checks.derive_running_total(
        wh.table("dws_user_daily"), wh.table("dws_user_daily_derive"), day
    ),
    "7.1": lambda wh, day, now, only: checks.hourly_users(wh.log("base_log"), wh.table("dws_user_hourly"), now),
    "7.2": lambda wh, day, now, only: checks.hourly_money_by_user(wh.log("payment_log"), wh.table("dws_user_hourly"), now),
    "8.1 gain": lambda wh, day, now, only: checks.core_flow_by_user(
        wh.log("core_log"), wh.table("dws_core_snapshot"), wh.game, "gain", "coregain_detail", day
    ),
    "8.1 cost": lambda wh, day, now, only: checks.core_flow_by_user(
        wh.log("core_log"), wh.table("dws_core_snapshot"), wh.game, "cost", "corecost_detail", day
    ),
    "9.1": lambda wh, day, now, only: checks.active_users(wh.table("dws_user_daily"), wh.table("ads_active_daily"), day),
    "10.1": lambda wh, day, now, only: checks.core_by_reason_total(
        wh.table("dws_core_snapshot"), wh.table("ads_core_addreason"), wh.test_accounts(), "coregain_detail",
        "core_add", day,
    ),
    "11.1": lambda wh, day, now, only: checks.core_by_reason_total(
        wh.table("dws_core_snapshot"), wh.table("ads_core_costreason"), wh.test_accounts(), "corecost_detail",
        "core_cost", day, missing_is_zero=False,
    ),
    "12.1": lambda wh, day, now, only: checks.retention_base(
        wh.table("dws_user_daily"), wh.table("ads_retention_daily"), day, only
    ),
    "13.1": lambda wh, day, now, only: checks.retention_installs(
        wh.table("dws_user_info"), wh.table("ads_user_retention"), day, only
    ),
    "14.1": lambda wh, day, now, only: checks.kpi_money(wh.table("dws_user_daily"), wh.table("ads_kpi_daily"), day),
    "14.2": lambda wh, day, now, only: checks.kpi_money_cumulative(
        wh.table("dws_user_daily"), wh.table("ads_kpi_daily"), day
    ),
    "14.3": lambda wh, day, now, only: checks.kpi_users_cumulative(
        wh.table("dws_user_daily"), wh.table("ads_kpi_daily"), day
    ),
    "15.1": lambda wh, day, now, only: checks.hourly_report_users(
        wh.table("dws_user_daily"), wh.table("ads_kpi_hourly_hi"), day, only
    ),
    "15.2": lambda wh, day, now, only: checks.hourly_report_money(
        wh.table("dws_user_daily"), wh.table("ads_kpi_hourly_hi"), "money_hourly", day, only
    ),
    "15.3": lambda wh, day, now, only: checks.hourly_report_installs(
        wh.table("dws_user_info"), wh.table("ads_kpi_hourly_hi"), day, only
    ),
    "16.1": lambda wh, day, now, only: checks.hourly_report_money(
        wh.table("dws_user_daily"), wh.table("ads_kpi_hourly_hf"), "money", day, only
    ),
}


def run_check(wh: Warehouse, name: str, moment: str, only_mismatch: bool = True) -> DataFrame:
    """One check as of ``moment`` (``yyyy-MM-dd HH:mm:ss``)."""
    return CHECKS[name](wh, moment[:10], moment, only_mismatch)
