"""Reconciliation between layers: each check returns the differences it finds.

``as_of`` is the day (or moment) the check runs; checks of closed days look at the day
before it or at the days since ``CHECK_DAYS`` before it.

Checks with ``only_mismatch`` exist in two forms: games either see the mismatching days
only, or all days; in the second form the hourly checks include the running day, and a day
missing from the report shows no difference at all.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, functions as F

from rolemart.config import CHECK_DAYS, Game
from rolemart.functions.dates import day_text
from rolemart.functions.money import rounded_long
from rolemart.operators.compare import difference_by_key, difference_of_totals, duplicates
from rolemart.operators.grids import running_total
from rolemart.operators.users import user_metrics, without_test_accounts


def _shift(as_of: str, days: int) -> str:
    return (date.fromisoformat(as_of) + timedelta(days=days)).isoformat()


def _yesterday(df: DataFrame, as_of: str) -> DataFrame:
    return df.where(F.col("part_date") == _shift(as_of, -1))


def _recent(df: DataFrame, as_of: str, today: bool = True) -> DataFrame:
    rows = df.where(F.col("part_date") >= _shift(as_of, -CHECK_DAYS))
    return rows if today else rows.where(F.col("part_date") < as_of)


def _real_users(df: DataFrame) -> DataFrame:
    return df.where(F.col("is_test").isNull())


def _users(df: DataFrame, keys: list[str]) -> DataFrame:
    return user_metrics(df, keys, {"value": None})


def _total(df: DataFrame, value: str, keys: tuple[str, ...] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias("value"))


def _whole(df: DataFrame) -> DataFrame:
    return df.withColumn("value", rounded_long(F.col("value")))


def user_daily_money(payment_log: DataFrame, daily: DataFrame, as_of: str) -> DataFrame:
    """4.1 Yesterday's payments against the user-day table, in whole units."""
    return difference_of_totals(
        _whole(_total(_yesterday(payment_log, as_of), "money")), _whole(_total(_yesterday(daily, as_of), "money")), "value"
    )


def user_daily_unique(daily: DataFrame, as_of: str) -> DataFrame:
    """4.2 Users more than once in yesterday's user-day table."""
    return duplicates(_yesterday(daily, as_of), ["role_id"])


def user_daily_money_by_user(payment_log: DataFrame, daily: DataFrame, as_of: str) -> DataFrame:
    """4.3 Yesterday's payments per user, in whole units."""
    by_user = ("role_id",)
    return difference_by_key(
        _whole(_total(_yesterday(payment_log, as_of), "money", by_user)),
        _whole(_total(_yesterday(daily, as_of), "money", by_user)),
        ["role_id"], "value",
    )


def user_info_coverage(base_log: DataFrame, info: DataFrame) -> DataFrame:
    """5.1 Users in the attribute table against users in the log, as a percentage with decimals."""
    seen = base_log.where(F.col("role_id").isNotNull()).select("role_id").distinct().agg(F.count(F.lit(1)).alias("value"))
    report = difference_of_totals(info.agg(F.count(F.lit(1)).alias("value")), seen, "value")
    share = F.try_divide((F.col("difference") * 100).cast("decimal(20,0)"), F.col("expected").cast("decimal(20,0)"))
    return report.withColumn("percent", share.cast("decimal(20,4)"))


def user_info_unique(info: DataFrame) -> DataFrame:
    """5.2 Users more than once in the attribute table."""
    return duplicates(info, ["role_id"])


def derive_total(payment_log: DataFrame, derive: DataFrame, as_of: str) -> DataFrame:
    """6.1 Sum of every user's highest cumulative payment against all payments before today."""
    highest = derive.where(F.col("date") < F.lit(as_of).cast("date")).groupBy("role_id").agg(F.max("money_ac").alias("m"))
    paid = payment_log.where(F.col("part_date") < as_of)
    zero = F.lit(0)
    expected = paid.agg(F.coalesce(F.sum("money"), zero).alias("value"))
    reached = highest.agg(F.coalesce(F.sum("m"), zero).alias("value"))
    report = difference_of_totals(expected, reached, "value")
    return report.withColumn("difference", rounded_long(F.col("difference")))


def derive_unique(derive: DataFrame) -> DataFrame:
    """6.2 Users more than once in a day of the derived table."""
    return duplicates(derive, ["part_date", "role_id"])


def derive_running_total(daily: DataFrame, derive: DataFrame, as_of: str) -> DataFrame:
    """6.3 Cumulative payments over the whole history, compared for the recent days."""
    summed = daily.select("part_date", "role_id", running_total("money", ["role_id"], "part_date").alias("money_ac"))
    return difference_by_key(
        _recent(summed, as_of), _recent(derive, as_of), ["part_date", "role_id"], "money_ac",
        how="full", only_mismatch=True,
    )


def until_hour(df: DataFrame, moment: str, column: str) -> DataFrame:
    """Rows of yesterday and today before the hour that ``moment`` falls in (24-hour clock)."""
    hour = datetime.fromisoformat(moment).replace(minute=0, second=0, microsecond=0)
    today = hour.date().isoformat()
    days = df.where(F.col("part_date").between(_shift(today, -1), today))
    return days.where(F.col(column) < F.lit(hour.isoformat(sep=" ")).cast("timestamp_ntz"))


def hourly_users(base_log: DataFrame, hourly: DataFrame, moment: str) -> DataFrame:
    """7.1 Active users from yesterday up to the current hour."""
    sides = [
        until_hour(df, moment, column).where(F.col("role_id").isNotNull()).select("role_id").distinct()
        .agg(F.count(F.lit(1)).alias("value"))
        for df, column in ((base_log, "event_time"), (hourly, "hour"))
    ]
    return difference_of_totals(*sides, "value")


def hourly_money_by_user(payment_log: DataFrame, hourly: DataFrame, moment: str) -> DataFrame:
    """7.2 Payments per user from yesterday up to the current hour."""
    sides = [
        _total(until_hour(df, moment, column), "money", ("role_id",))
        for df, column in ((payment_log, "event_time"), (hourly, "hour"))
    ]
    return difference_by_key(*sides, ["role_id"], "value")


def core_flow_by_user(core_log: DataFrame, core: DataFrame, game: Game, event_type: str, detail: str, as_of: str) -> DataFrame:
    """8.1 Yesterday's core currency per user, log against snapshot."""
    amount = F.coalesce("free_num", F.lit(0)) + F.coalesce("paid_num", F.lit(0))
    logged = (
        _yesterday(core_log, as_of).where(F.col("reason") != game.excluded_reason)
        .groupBy("role_id").agg(F.sum(F.when(F.col("event_type") == event_type, amount)).alias("value"))
    )
    stored = _yesterday(core, as_of).select("role_id", F.explode(detail).alias("reason", "amount"))
    return difference_by_key(logged, _total(stored, "amount", ("role_id",)), ["role_id"], "value")


def active_users(daily: DataFrame, active: DataFrame, as_of: str) -> DataFrame:
    """9.1 Daily active users of the recent days."""
    return difference_by_key(
        _users(_recent(daily, as_of), ["part_date"]), _total(_recent(active, as_of), "dau", ("part_date",)),
        ["part_date"], "value", missing_is_zero=False,
    )


def core_by_reason_total(
    core: DataFrame,
    by_reason: DataFrame,
    test_accounts: DataFrame,
    detail: str,
    value: str,
    as_of: str,
    missing_is_zero: bool = True,
) -> DataFrame:
    """10.1 and 11.1 Core currency per recent day without test accounts, snapshot against report.

    For spending (11.1) a day missing from the report has no difference.
    """
    real = without_test_accounts(_recent(core, as_of), test_accounts)
    stored = real.select("part_date", F.explode(detail).alias("reason", "amount"))
    return difference_by_key(
        _total(stored, "amount", ("part_date",)), _total(_recent(by_reason, as_of), value, ("part_date",)),
        ["part_date"], "value", missing_is_zero=missing_is_zero,
    )


def retention_base(daily: DataFrame, retention: DataFrame, as_of: str, only_mismatch: bool = True) -> DataFrame:
    """12.1 Users of retention day 0 against real active users, signed."""
    return difference_by_key(
        _users(_real_users(_recent(daily, as_of)), ["part_date"]),
        _total(_recent(retention, as_of).where(F.col("retention_day") == 0), "dau", ("part_date",)),
        ["part_date"], "value", signed=True, only_mismatch=only_mismatch,
    )


def _installs(info: DataFrame, as_of: str, today: bool = True) -> DataFrame:
    since = F.col("install_date") >= F.lit(_shift(as_of, -CHECK_DAYS)).cast("date")
    rows = _real_users(info).where(since)
    return rows if today else rows.where(F.col("install_date") < F.lit(as_of).cast("date"))


def retention_installs(info: DataFrame, retention: DataFrame, as_of: str, only_mismatch: bool = True) -> DataFrame:
    """13.1 Installs per day against the cohort's users on day 0."""
    recent = F.col("date") >= F.lit(_shift(as_of, -CHECK_DAYS)).cast("date")
    cohorts = retention.where(recent & (F.col("retention_day") == 0)).withColumnRenamed("date", "install_date")
    return difference_by_key(
        _users(_installs(info, as_of), ["install_date"]), _total(cohorts, "active_users", ("install_date",)),
        ["install_date"], "value", only_mismatch=only_mismatch,
    )


def kpi_money(daily: DataFrame, kpi: DataFrame, as_of: str) -> DataFrame:
    """14.1 Daily money, user-day table against KPI report, in whole units and day order."""
    by_day = ("part_date",)
    return difference_by_key(
        _whole(_total(_recent(daily, as_of), "money_rmb", by_day)), _whole(_total(_recent(kpi, as_of), "money_rmb", by_day)),
        ["part_date"], "value",
    ).orderBy("part_date", "difference")


def kpi_money_cumulative(daily: DataFrame, kpi: DataFrame, as_of: str) -> DataFrame:
    """14.2 All money up to yesterday against yesterday's cumulative money in the KPI report."""
    paid = _real_users(daily).where(F.col("part_date") <= _shift(as_of, -1))
    return difference_of_totals(_total(paid, "money_rmb"), _total(_yesterday(kpi, as_of), "moneyrmb_ac"), "value")


def kpi_users_cumulative(daily: DataFrame, kpi: DataFrame, as_of: str) -> DataFrame:
    """14.3 All real users up to yesterday against yesterday's cumulative new users in the KPI report."""
    seen = _real_users(daily).where(F.col("part_date") <= _shift(as_of, -1)).where(F.col("role_id").isNotNull())
    users = seen.select("role_id").distinct().agg(F.count(F.lit(1)).alias("value"))
    return difference_of_totals(users, _total(_yesterday(kpi, as_of), "newuser_ac"), "value")


def hourly_report_users(daily: DataFrame, hourly_report: DataFrame, as_of: str, only_mismatch: bool = True) -> DataFrame:
    """15.1 Daily active users of closed days, hourly report summed."""
    return difference_by_key(
        _users(_real_users(_recent(daily, as_of, today=not only_mismatch)), ["part_date"]),
        _total(_recent(hourly_report, as_of, today=not only_mismatch), "dau", ("part_date",)),
        ["part_date"], "value", only_mismatch=only_mismatch, missing_is_zero=only_mismatch,
    )


def hourly_report_money(
    daily: DataFrame, hourly_report: DataFrame, value: str, as_of: str, only_mismatch: bool = True
) -> DataFrame:
    """15.2 and 16.1 Money of closed days, hourly report summed."""
    by_day = ("part_date",)
    return difference_by_key(
        _total(_real_users(_recent(daily, as_of, today=not only_mismatch)), "money", by_day),
        _total(_recent(hourly_report, as_of, today=not only_mismatch), value, by_day),
        ["part_date"], "value", only_mismatch=only_mismatch, missing_is_zero=only_mismatch,
    )


def hourly_report_installs(info: DataFrame, hourly_report: DataFrame, as_of: str, only_mismatch: bool = True) -> DataFrame:
    """15.3 Installs of closed days, hourly report summed."""
    installs = _installs(info, as_of, today=not only_mismatch).withColumn("part_date", day_text(F.col("install_date")))
    return difference_by_key(
        _users(installs, ["part_date"]),
        _total(_recent(hourly_report, as_of, today=not only_mismatch), "new_users", ("part_date",)),
        ["part_date"], "value", only_mismatch=only_mismatch, missing_is_zero=only_mismatch,
    )
