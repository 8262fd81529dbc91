"""User-level summaries the reports build on, and the reports directly on top of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rolemart.config import MAX_LATE_DAYS, Game, RunWindow
from rolemart.functions.dates import days_between, hour_of
from rolemart.functions.money import LEDGER
from rolemart.operators.grids import running_total
from rolemart.operators.users import mark_test_users, user_metrics, with_user_attrs
from rolemart.plans.state import Mergeable

_PARTITION_KEYS = ("role_id", "part_date")
_DAY_KEYS = (*_PARTITION_KEYS, "date")
_ACCOUNT = ("zone_id", "channel", "os")
#: What a partition day keeps for each event date.
EVENT_DAY = {"online_time": "bigint", "pay_count": "bigint", "money": "decimal(32,4)", "money_rmb": "decimal(32,4)", "web_rmb": "decimal(32,4)"}
_PAY_FIRST = "struct<pay_ts:timestamp_ntz,good_id:string,level:bigint>"


def _by_event_day(parts: Column) -> Column:
    """One entry per event date, in date order, from the partial sums of a user's partition day."""

    def total(metric: str, kind: str) -> Column:
        def of_day(day: Column) -> Column:
            known = F.filter(parts, lambda p: (p["date"] == day) & p[metric].isNotNull())
            summed = F.aggregate(known, F.lit(0).cast(kind), lambda n, p: (n + p[metric]).cast(kind))
            return summed if metric != "online_time" else F.when(F.size(known) > 0, summed)

        return of_day

    totals = {m: total(m, t) for m, t in EVENT_DAY.items()}
    dates = F.array_sort(F.array_distinct(F.filter(F.transform(parts, lambda p: p["date"]), lambda d: d.isNotNull())))
    return F.transform(dates, lambda d: F.struct(d.alias("date"), *(f(d).alias(m) for m, f in totals.items())))


def user_daily(base_log: DataFrame, payment_log: DataFrame, test_accounts: DataFrame) -> DataFrame:
    """One row per user and partition day: levels, time online, payments, and the day's last account attributes.

    Events of other days that arrived in the partition belong to its row, which carries the latest event date. ``days`` holds
    what the row has of each event date, so that reports by event date (``event_days``) find every event in its own day.

    Each log is reduced to user-days before the two meet, so the meeting is one grouping of
    small rows and needs no join. A payment without any other activity still counts.
    """
    activity = base_log.groupBy(*_DAY_KEYS, *_ACCOUNT).agg(
        F.min("level").alias("level_min"),
        F.max("level").alias("level_max"),
        F.min("vip_level").alias("viplevel_min"),
        F.max("vip_level").alias("viplevel_max"),
        F.sum("online_time").alias("online_time"),
        F.max("event_time").alias("login_ts"),
    )
    payments = payment_log.groupBy(*_DAY_KEYS).agg(
        F.min("exchange_rate").alias("exchange_rate"),
        F.count("money").alias("pay_count"),
        F.sum("money").alias("money"),
        F.sum("money_rmb").alias("money_rmb"),
        F.sum("web_rmb").alias("web_rmb"),
        F.min(
            F.struct(
                F.col("event_time").alias("pay_ts"), F.col("payment_itemid").alias("good_id"), F.col("level").alias("level")
            )
        ).alias("pay_first"),
    )
    account = F.max_by(F.struct(*_ACCOUNT), F.when(F.col("login_ts").isNotNull(), F.struct("login_ts", *_ACCOUNT)))
    zero = F.lit(0).cast(LEDGER)
    merged = (
        activity.unionByName(payments, allowMissingColumns=True)
        .groupBy(*_PARTITION_KEYS)
        .agg(
            F.max("date").alias("date"),
            *[F.min(c).alias(c) for c in ("level_min", "viplevel_min", "exchange_rate")],
            *[F.max(c).alias(c) for c in ("level_max", "viplevel_max", "login_ts")],
            F.sum("online_time").alias("online_time"),
            F.coalesce(F.sum("pay_count"), F.lit(0)).alias("pay_count"),
            *[F.coalesce(F.sum(c).cast(LEDGER), zero).alias(c) for c in ("money", "money_rmb", "web_rmb")],
            F.min("pay_first").cast(_PAY_FIRST).alias("pay_first"),
            account.alias("account"),
            F.collect_list(F.struct("date", *EVENT_DAY)).alias("parts"),
        )
        .select("*", "account.*", _by_event_day(F.col("parts")).alias("days"))
        .drop("account", "parts")
    )
    return mark_test_users(merged, test_accounts)


def with_days(daily: DataFrame) -> DataFrame:
    """User-days with ``days``; rows of another origin than ``user_daily`` have their own date as the only one."""
    if "days" in daily.columns:
        return daily
    known = (F.col(c).cast(t).alias(c) if c in daily.columns else F.lit(None).cast(t).alias(c) for c, t in EVENT_DAY.items())
    return daily.withColumn("days", F.array(F.struct("date", *known)))


def _in_time(day: Column, max_late_days: int) -> Column:
    """Whether an event date may stand in its partition: not after it, and not further back than events can be late."""
    part = F.to_date("part_date")
    return day.between(F.date_sub(part, max_late_days), part)


def event_days(daily: DataFrame, max_late_days: int = MAX_LATE_DAYS) -> DataFrame:
    """User-days unfolded to one row per user, partition and event date, with the sums of that date.

    Dates that no lateness explains (a clock at 1970, or ahead) are left out here; ``stray_days`` counts them. Other columns
    are those of the partition day.
    """
    others = [c for c in daily.columns if c not in ("date", "days", *EVENT_DAY)]
    rows = with_days(daily).select(*others, F.explode("days").alias("_day")).where(_in_time(F.col("_day.date"), max_late_days))
    return rows.select(*others, "_day.*")


def stray_days(daily: DataFrame, max_late_days: int = MAX_LATE_DAYS) -> DataFrame:
    """Per partition and impossible event date: users, payments and money that reports by event date leave out."""
    rows = with_days(daily).select("part_date", "role_id", F.explode("days").alias("_day")).where(~_in_time(F.col("_day.date"), max_late_days))
    return rows.groupBy("part_date", F.col("_day.date").alias("date")).agg(
        F.count(F.lit(1)).alias("users"), F.sum("_day.pay_count").alias("pay_count"), F.sum("_day.money_rmb").cast(LEDGER).alias("money_rmb"))


def first_event_date(max_late_days: int = MAX_LATE_DAYS) -> Column:
    """The earliest event date of a user's partition day that lateness explains."""
    return F.array_min(F.filter(F.transform("days", lambda d: d["date"]), lambda d: _in_time(d, max_late_days)))


def user_partials(daily: DataFrame) -> DataFrame:
    """What ``user_info`` needs of a user's days, in a form that can be merged with that of other days."""
    first_day = F.coalesce(first_event_date(), "date") if "days" in daily.columns else F.col("date")
    money = F.col("money") if "money" in daily.columns else F.lit(None).cast(LEDGER)
    return daily.groupBy("role_id").agg(
        F.min(first_day).alias("install_date"),
        F.max("login_ts").alias("lastlogin_ts"),
        F.sum(money).cast(LEDGER).alias("money_ac"),
        F.sum("money_rmb").cast(LEDGER).alias("moneyrmb_ac"),
        F.min("pay_first").alias("first"),
        F.max(F.when(F.col("login_ts").isNotNull(), F.struct("login_ts", *_ACCOUNT))).alias("latest"),
        F.max("viplevel_max").alias("vip_level"),
        F.max("is_test").alias("is_test"),
    )


#: Per user over any set of days: totals, first payment and latest account.
USERS = Mergeable(
    ("role_id",), user_partials,
    {"install_date": "min", "lastlogin_ts": "max", "money_ac": "sum", "moneyrmb_ac": "sum", "first": "min", "latest": "max", "vip_level": "max", "is_test": "max"},
)


def user_info_of(users: DataFrame) -> DataFrame:
    """The user table from merged ``USERS`` rows."""
    return users.select(
        "role_id", "install_date", "lastlogin_ts", "moneyrmb_ac",
        F.to_date("first.pay_ts").alias("firstpay_date"),
        F.col("first.good_id").alias("firstpay_goodid"),
        F.col("first.level").alias("firstpay_level"),
        *(F.col(f"latest.{c}").alias(c) for c in _ACCOUNT), "vip_level", "is_test",
    )


def user_info(daily: DataFrame) -> DataFrame:
    """One row per user: install, last login, lifetime payments, first payment, latest attributes."""
    return user_info_of(user_partials(daily))


def user_daily_derive(daily: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """Cumulative payments and lifecycle flags per user-day.

    ``earlier`` (role_id, money_ac, moneyrmb_ac) carries the totals reached before the days
    given; the stored state has them, so a daily run does not read the whole history.
    """
    order = Window.partitionBy("role_id").orderBy("part_date")
    if earlier is None:
        known, money_before, rmb_before = F.lit(False), F.lit(0), F.lit(0)
    else:
        start = earlier.groupBy("role_id").agg(
            F.max("money_ac").alias("_money"), F.max("moneyrmb_ac").alias("_rmb"), F.lit(True).alias("_known")
        )
        daily = daily.join(start, "role_id", "left")
        known = F.coalesce("_known", F.lit(False))
        money_before, rmb_before = F.coalesce("_money", F.lit(0)), F.coalesce("_rmb", F.lit(0))
    paying = F.col("money_rmb") > 0
    return daily.select(
        "date", "part_date", "role_id",
        (running_total("money", ["role_id"], "part_date") + money_before).cast(LEDGER).alias("money_ac"),
        (running_total("money_rmb", ["role_id"], "part_date") + rmb_before).cast(LEDGER).alias("moneyrmb_ac"),
        ((F.row_number().over(order) == 1) & ~known).cast("int").alias("is_new"),
        paying.cast("int").alias("is_pay"),
        F.col("money_rmb").alias("_today"),
    ).select(
        "date", "part_date", "role_id", "money_ac", "moneyrmb_ac", "is_new",
        ((F.col("is_pay") == 1) & (F.col("moneyrmb_ac") == F.col("_today"))).cast("int").alias("is_firstpay"),
        "is_pay",
        (F.col("moneyrmb_ac") > 0).cast("int").alias("is_paid"),
    )


def user_hourly(base_log: DataFrame, payment_log: DataFrame) -> DataFrame:
    """Active users per hour with their payments."""
    keys = ("role_id", "part_date", "date", "hour")
    seen = base_log.withColumn("hour", hour_of(F.col("event_time"))).select(*keys).distinct()
    paid = payment_log.withColumn("hour", hour_of(F.col("event_time"))).groupBy(*keys).agg(
        F.sum("money").alias("money"), F.sum("money_rmb").alias("money_rmb"), F.min("exchange_rate").alias("exchange_rate")
    )
    zero = F.lit(0).cast(LEDGER)
    return seen.unionByName(paid, allowMissingColumns=True).groupBy(*keys).agg(
        F.coalesce(F.sum("money").cast(LEDGER), zero).alias("money"),
        F.coalesce(F.sum("money_rmb").cast(LEDGER), zero).alias("money_rmb"),
        F.min("exchange_rate").alias("exchange_rate"),
    )


def core_snapshot(core_log: DataFrame, game: Game) -> DataFrame:
    """Core currency gained and spent per user-day, by reason, and the balance at the end of the day."""
    amount = F.coalesce("free_num", F.lit(0)) + F.coalesce("paid_num", F.lit(0))
    by_reason = (
        core_log.where(F.col("reason") != game.excluded_reason)
        .groupBy(*_DAY_KEYS, "reason")
        .agg(
            F.sum(F.when(F.col("event_type") == "gain", amount)).alias("gain"),
            F.sum(F.when(F.col("event_type") == "cost", amount)).alias("cost"),
            F.max(F.when(F.col("core_end").isNotNull(), F.struct("event_time", "core_end"))).alias("balance"),
        )
    )

    def amounts(column: str):
        pairs = F.collect_list(F.when(F.col(column).isNotNull(), F.struct("reason", column)))
        return F.map_from_entries(F.array_sort(pairs))

    return by_reason.groupBy(*_DAY_KEYS).agg(
        amounts("gain").alias("coregain_detail"),
        amounts("cost").alias("corecost_detail"),
        F.max("balance").getField("core_end").alias("core_end"),
    )


def event_span(daily: DataFrame, window: RunWindow) -> RunWindow:
    """The window, begun at the earliest event date in its partitions if that lies before it, by ``MAX_LATE_DAYS`` at most."""
    rows = with_days(daily).where(F.col("part_date").between(window.start_date, window.end_date))
    earliest = rows.agg(F.min(first_event_date()).cast("string").alias("first")).first()["first"]
    return RunWindow(min(earliest or window.start_date, window.start_date), window.end_date)


def active_daily(daily: DataFrame) -> DataFrame:
    return user_metrics(daily, ["part_date"], {"dau": None})


def core_by_reason(core: DataFrame, info: DataFrame, detail: str, value: str) -> DataFrame:
    """Core currency per day and reason, test users excluded."""
    rows = with_user_attrs(core, info, []).select("part_date", F.explode(detail).alias("reason", value))
    return rows.groupBy("part_date", "reason").agg(F.sum(value).alias(value))


def _active_words(daily: DataFrame) -> DataFrame:
    """A user's active days as bits, 64 days a row."""
    seen = daily.select("role_id", F.unix_date(F.to_date("part_date")).alias("_day")).where(F.col("_day").isNotNull())
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_day").bitwiseAND(F.lit(63)))
    return seen.groupBy("role_id", F.shiftright("_day", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))


#: Per user and 64 days: one bit a day on which the user was active. Words of other days are merged by or.
ACTIVE_DAYS = Mergeable(("role_id", "word"), _active_words, {"bits": "bit_or"})


def retention_of(words: DataFrame, info: DataFrame, touching: RunWindow | None = None) -> DataFrame:
    """Pairs of days with the users active on both, from ``ACTIVE_DAYS`` rows; ``touching`` keeps pairs with a day in the window.

    A user's bits are cut into groups of eight days. Users with the same pair of groups and the same bits in both are counted
    together, and only the bits of such counted pairs are unfolded to days. So a user gives a row for each pair of groups and
    not of days, and a pair of groups has at most 65,536 rows, however many users there are.
    """
    cut = F.array(*[
        F.struct((F.col("word") * 8 + n).alias("at"), F.shiftrightunsigned("bits", 8 * n).bitwiseAND(F.lit(255)).cast("int").alias("bits"))
        for n in range(8)
    ])
    users = (
        with_user_attrs(words, info, []).where(F.col("role_id").isNotNull())
        .groupBy("role_id").agg(F.flatten(F.collect_list(F.filter(cut, lambda g: g["bits"] != 0))).alias("groups"))
    )

    def touched(first: Column, second: Column, days: int) -> Column:
        if touching is None:
            return F.lit(True)
        start, end = (F.shiftright(F.unix_date(F.lit(d).cast("date")), days.bit_length() - 1) for d in (touching.start_date, touching.end_date))
        return first.between(start, end) | second.between(start, end)

    if touching is not None:  # most users have no day in a short window
        users = users.where(F.exists("groups", lambda g: touched(g["at"], g["at"], 8)))
    alike = (
        users.select("groups", F.explode("groups").alias("a"))
        .select("a", F.explode(F.filter("groups", lambda g: (g["at"] >= F.col("a.at")) & touched(F.col("a.at"), g["at"], 8))).alias("b"))
        .groupBy("a", "b").agg(F.count(F.lit(1)).alias("users"))
    )

    def days_of(group: str) -> Column:
        bits = F.filter(F.array(*[F.lit(n) for n in range(8)]), lambda n: F.getbit(F.col(f"{group}.bits"), n) == 1)
        return F.explode(F.transform(bits, lambda n: F.col(f"{group}.at") * 8 + n))

    return (
        alike.select("users", "b", days_of("a").alias("day")).select("users", "day", days_of("b").alias("later"))
        .where((F.col("later") >= F.col("day")) & touched(F.col("day"), F.col("later"), 1))
        .groupBy(
            F.date_from_unix_date("day").cast("string").alias("part_date"),
            (F.col("later") - F.col("day")).cast("bigint").alias("retention_day"),
        )
        .agg(F.sum("users").alias("dau"))
    )


def retention_daily(daily: DataFrame, info: DataFrame, window: RunWindow | None = None) -> DataFrame:
    """Users active on a day who are active again ``retention_day`` days later (0: the day's active users).

    ``window`` limits the days counted from; every later day in ``daily`` still counts as a return.
    """
    if window is None:
        return retention_of(ACTIVE_DAYS.partial(daily), info)
    words = ACTIVE_DAYS.partial(daily.where(F.col("part_date") >= window.start_date))
    return retention_of(words, info, window).where(F.col("part_date").between(window.start_date, window.end_date))


def retention_continued(stored: DataFrame, words: DataFrame, info: DataFrame, window: RunWindow) -> DataFrame:
    """The stored report with all pairs that have a day in the window counted anew, from the bits of all days.

    Pairs of two other days keep their stored count. A user listed as a test account later leaves the rows of a day when that
    day is rerun, as in the other reports by day.
    """
    later = F.date_add(F.to_date("part_date"), F.col("retention_day").cast("int")).cast("string")
    inside = F.col("part_date").between(window.start_date, window.end_date) | later.between(window.start_date, window.end_date)
    return stored.where(~inside).unionByName(retention_of(words, info, window))


def user_retention(daily: DataFrame, info: DataFrame) -> DataFrame:
    """Active users per install day and days since install."""
    rows = with_user_attrs(event_days(daily), info, ["install_date"]).withColumn(
        "retention_day", days_between(F.col("install_date"), F.col("date")).cast("bigint")
    )
    return user_metrics(rows, ["install_date", "retention_day"], {"active_users": None}).withColumnRenamed(
        "install_date", "date"
    )


def kpi_hourly(hourly: DataFrame, info: DataFrame) -> DataFrame:
    """Hourly payments; a day's users and new users count in the first hour they are seen."""
    first_hour = F.min("hour").over(Window.partitionBy("role_id", "part_date"))
    fresh = F.col("hour") == first_hour
    return (
        with_user_attrs(hourly, info, ["install_date"])
        .withColumn("first_seen", fresh.cast("bigint"))
        .withColumn("installed", (fresh & (F.col("install_date") == F.col("date"))).cast("bigint"))
        .groupBy("part_date", "hour")
        .agg(
            F.sum("first_seen").alias("dau"),
            F.sum("money").cast(LEDGER).alias("money_hourly"),
            F.coalesce(F.sum("installed"), F.lit(0)).alias("new_users"),
        )
    )


def kpi_hourly_full(hourly: DataFrame, info: DataFrame) -> DataFrame:
    return with_user_attrs(hourly, info, []).groupBy("part_date", "hour").agg(F.sum("money").cast(LEDGER).alias("money"))
