"""KPI reports over dense date-by-dimension grids."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, functions as F

from rolemart.config import MAX_LATE_DAYS, RunWindow
from rolemart.functions.dates import day_text, month_of, months_between
from rolemart.operators.grids import axis_grid, fill_days, running_total
from rolemart.operators.users import lifecycle_days, user_metrics, with_user_attrs
from rolemart.plans.upstream import event_days
from rolemart.session import settle
from rolemart.sources.logs import in_window

DIMS = ("zone_id", "channel", "os")
_LIFECYCLE = ["install_date", "firstpay_date", *DIMS]


def _latest_arrival(day: str) -> str:
    return (date.fromisoformat(day) + timedelta(days=MAX_LATE_DAYS)).isoformat()


def _same_dims(left: DataFrame, right: DataFrame, time: str) -> DataFrame:
    """Left join on time and dimensions by plain equality: NULL dimensions find no partner."""
    return left.join(right, [time, *DIMS], "left")


def daily_metrics(
    daily: DataFrame, derive: DataFrame, info: DataFrame, window: RunWindow, by_event_day: bool = False
) -> DataFrame:
    """User and money metrics per day, partition day and dimension, over existing combinations only.

    ``by_event_day``: the window is one of event days, whenever they arrived, and a day's partitions count together.
    """
    values = ("online_time", "pay_count", "money_rmb", "web_rmb")
    if by_event_day:  # a day's events lie in its partition or one of the next
        arrived = RunWindow(window.start_date, _latest_arrival(window.end_date))
        daily = event_days(in_window(daily, arrived)).where(F.col("date").between(window.start_date, window.end_date))
        days = daily.select("date", "part_date", "role_id", *values)
    else:
        arrived = window
        days = in_window(daily, window).select("date", "part_date", "role_id", *values)
    so_far = in_window(derive, arrived).select("role_id", "part_date", "moneyrmb_ac")
    days = days.join(so_far, ["role_id", "part_date"], "left")
    if by_event_day:  # parts of one day that came in several partitions are one user-day
        days = days.groupBy("role_id", "date").agg(*(F.sum(c).alias(c) for c in values), F.max("moneyrmb_ac").alias("moneyrmb_ac"))
    rows = with_user_attrs(days, info, _LIFECYCLE)
    rows = rows.withColumns(lifecycle_days())
    pays, fresh = F.col("money_rmb") > 0, F.col("retention_day") == 0
    first_pay = pays & (F.col("pay_retention_day") == 0)
    return user_metrics(
        rows,
        ["date", *DIMS] if by_event_day else ["date", "part_date", *DIMS],
        {
            "new_users": fresh,
            "active_users": None,
            "pay_users": pays,
            "paid_users": F.col("moneyrmb_ac") > 0,
            "install_pay": first_pay & fresh,
            "newpay_users": first_pay,
            "webpay_users": F.col("web_rmb") > 0,
        },
        {
            "online_time": F.col("online_time"),
            "pay_count": F.col("pay_count"),
            "money_rmb": F.col("money_rmb"),
            "install_moneyrmb": F.when(first_pay & fresh, F.col("money_rmb")),
            "newpay_moneyrmb": F.when(first_pay, F.col("money_rmb")),
            "web_rmb": F.col("web_rmb"),
            "moneyrmb_ac": F.col("moneyrmb_ac"),
        },
    )


def kpi_daily(
    daily: DataFrame, derive: DataFrame, info: DataFrame, window: RunWindow, history: DataFrame | None = None,
    by_event_day: bool = False,
) -> DataFrame:
    """Daily KPIs on a gapless grid with the running number of new users.

    The running number starts at the window. With ``history`` (the stored report of earlier
    days) it continues from there instead. By default the window is one of partitions, and user-days
    of other dates in them are not reported; ``by_event_day`` reports all events of the window's days.
    """
    metrics = daily_metrics(daily, derive, info, window, by_event_day)
    values = [c for c in metrics.columns if c not in ("date", "part_date", *DIMS)]
    grid = fill_days(metrics, DIMS, values, window.start_date, window.end_date)
    grid = grid.withColumn("newuser_ac", running_total("new_users", DIMS, "date"))
    if history is not None:
        reached = history.where(F.col("part_date") < window.start_date).groupBy(*DIMS).agg(
            F.max("newuser_ac").alias("_reached")
        )
        grid = grid.join(reached, list(DIMS), "left")
        total = F.coalesce("newuser_ac", F.lit(0)) + F.coalesce("_reached", F.lit(0))
        grid = grid.withColumn("newuser_ac", total).drop("_reached")
    return grid.withColumn("part_date", day_text(F.col("date")))


def intraday_metrics(hourly: DataFrame, derive: DataFrame, info: DataFrame, window: RunWindow) -> DataFrame:
    """Hourly activity folded to user-days, then to users and money per day and dimension."""
    recent = hourly.where(F.col("part_date").between(window.start_date, window.end_date))
    days = recent.groupBy("role_id", "date", "part_date").agg(F.sum("money_rmb").alias("money_rmb"))
    if "part_date" in derive.columns:  # a row of an event day lies in the partition of that day or a later one
        first = F.coalesce(F.min("date").cast("string"), F.lit(window.start_date))
        derive = derive.where(F.col("part_date") >= recent.agg(F.least(first, F.lit(window.start_date))).scalar())
        derive = derive.where(F.col("part_date") <= _latest_arrival(window.end_date))
    status = derive.select("role_id", "date", "is_paid")
    rows = with_user_attrs(days.join(status, ["role_id", "date"], "left"), info, _LIFECYCLE)
    rows = rows.withColumns(lifecycle_days())
    first_pay_day = F.col("firstpay_date") == F.col("date")
    install_day = F.col("retention_day") == 0
    return user_metrics(
        rows,
        ["date", *DIMS],
        {
            "active_users": None,
            "new_users": install_day,
            "retention1_users": F.col("retention_day") == 1,
            "pay_users": F.col("money_rmb") > 0,
            "firstpay_users": (F.col("money_rmb") > 0) & first_pay_day,
            "firstdaypay_users": first_pay_day & install_day,
        },
        {
            "paid_users": F.col("is_paid"),
            "money_rmb": F.col("money_rmb"),
            "firstpay_rmb": F.when(first_pay_day, F.col("money_rmb")),
            "firstdaypay_rmb": F.when(first_pay_day & install_day, F.col("money_rmb")),
        },
    )


def kpi_daily_intraday(hourly: DataFrame, derive: DataFrame, info: DataFrame, window: RunWindow) -> DataFrame:
    """KPIs of the trailing days, rerun through the day, with next-day retention of new users."""
    metrics = settle(intraday_metrics(hourly, derive, info, window))
    grid = axis_grid(metrics.select(*DIMS).distinct(), metrics, ["date"])
    day_before = metrics.select(
        F.date_add("date", 1).alias("date"), *DIMS, F.col("new_users").alias("retention1_newusers")
    )
    report = _same_dims(_same_dims(grid, metrics, "date"), day_before, "date")
    return report.withColumn("part_date", day_text(F.col("date")))


def monthly_metrics(daily: DataFrame, info: DataFrame, window: RunWindow) -> DataFrame:
    """User-months folded to users and money per month and dimension, by the event date.

    An event lies in the partition of its day or one of the next, so only these partitions are read.
    """
    arrived = in_window(daily, RunWindow(window.start_date, _latest_arrival(window.end_date)))
    days = event_days(arrived).where(F.col("date").between(window.start_date, window.end_date))
    months = days.groupBy("role_id", month_of(F.col("date")).alias("month")).agg(
        F.sum("pay_count").alias("pay_count"), F.sum("money").alias("money"), F.sum("money_rmb").alias("money_rmb")
    )
    rows = with_user_attrs(months, info, _LIFECYCLE)
    pays = F.col("money") > 0
    fresh = months_between(F.col("install_date"), F.col("month")) == 0
    first_pay = pays & (months_between(F.col("firstpay_date"), F.col("month")) == 0)
    return user_metrics(
        rows,
        ["month", *DIMS],
        {
            "new_users": fresh,
            "active_users": None,
            "pay_users": pays,
            "new_users_pay": first_pay & fresh,
            "users_new_pay": first_pay,
        },
        {
            "pay_count": F.col("pay_count"),
            "money_rmb": F.col("money_rmb"),
            "new_users_moneyrmb": F.when(first_pay & fresh, F.col("money_rmb")),
            "users_new_moneyrmb": F.when(first_pay, F.col("money_rmb")),
        },
    )


def kpi_monthly(daily: DataFrame, info: DataFrame, window: RunWindow, history: DataFrame | None = None) -> DataFrame:
    """Monthly KPIs over every combination of the observed months and dimension values.

    Runs over whole months, so that a window starting mid-month neither splits nor
    repeats one. Running sums start at its first month; with ``history`` (the stored report) they continue from the last
    month before it, and values of a dimension that were reported before stay on its axis. So a month's running sums are the
    same whether it is computed alone or together with the months before.
    """
    window = window.whole_months()
    metrics = settle(monthly_metrics(daily, info, window))
    seen = metrics.select(*DIMS)
    if history is not None:
        earlier = history.where(F.col("part_month") < window.start_date)
        last = F.max(F.struct("part_month", "new_users_ac", "moneyrmb_ac"))
        reached = settle(earlier.groupBy(*DIMS).agg(last.alias("last")).select(
            *DIMS, F.col("last.new_users_ac").alias("_users"), F.col("last.moneyrmb_ac").alias("_money")))
        seen = seen.unionByName(reached.select(*DIMS))
    grid = axis_grid(seen.select("zone_id").distinct(), metrics, ["month"])
    grid = axis_grid(grid, seen, ["channel", "os"])
    report = _same_dims(grid, metrics, "month")
    sums = {"new_users_ac": running_total("new_users", DIMS, "month"), "moneyrmb_ac": running_total("money_rmb", DIMS, "month")}
    report = report.withColumns({**sums, "part_month": day_text(F.col("month"))})
    if history is None:
        return report
    known = report.join(reached, list(DIMS), "left")

    def carried(total: str, before: str):
        both = F.coalesce(total, F.lit(0)) + F.coalesce(before, F.lit(0))
        return F.when(F.col(total).isNotNull() | F.col(before).isNotNull(), both)

    return known.withColumns({"new_users_ac": carried("new_users_ac", "_users"), "moneyrmb_ac": carried("moneyrmb_ac", "_money")}).drop("_users", "_money")
