"""Monthly token ledger: payments, tokens gained and spent, and carried-forward balances."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from rolemart.config import MAX_LATE_DAYS, Game, RunWindow
from rolemart.functions.dates import month_of, month_text, months_from_to
from rolemart.functions.money import LEDGER, minor_to_home, unit_price
from rolemart.functions.text import part_of
from rolemart.operators.details import newest_row_value
from rolemart.operators.lookups import join_lookup
from rolemart.operators.months import with_previous_month
from rolemart.plans.state import Checkpoints
from rolemart.session import settle
from rolemart.sources.logs import since
from rolemart.sources.lookups import token_price


def token_payments(payment_log: DataFrame, rates: DataFrame, game: Game) -> DataFrame:
    """Token purchases in home currency: web orders name the token count, app orders are priced by item.

    One scan serves both channels; a web order of an app item counts in both.
    """
    web = F.col("pay_source") == game.web_pay_source
    listed = token_price(F.col("payment_itemid"), game)
    tokens = F.array_compact(
        F.array(
            F.when(web, F.struct(part_of(F.col("payment_itemid"), ";", 2).cast("bigint").alias("tokens"))),
            F.when(listed.isNotNull(), F.struct(listed.alias("tokens"))),
        )
    )
    rated = (
        payment_log.withColumn("_sold", tokens).where(F.size("_sold") > 0)
        .select("date", "role_id", "money", "_sold", month_text(F.col("event_time")).alias("currency_time"))
    )
    return join_lookup(rated, rates, ["currency_time"]).select(
        "date", "role_id", minor_to_home(F.col("money"), F.col("exchange_rate")).alias("money_rmb"), F.inline("_sold")
    )


def token_days(token_log: DataFrame, game: Game) -> DataFrame:
    """Tokens gained and spent per user and event day, with the balance of the partition day's last row.

    The log is reduced once, to user, partition day and event day. The event day that holds
    a partition day's newest row takes its balance; a day closing two partitions has two rows.
    """
    kept = token_log.where((F.col("item_id") == game.token_item_id) & (F.col("reason") != game.excluded_reason))
    days = kept.groupBy("role_id", "part_date", "date").agg(
        F.sum(F.when(F.col("event_type") == "gain", F.col("item_num"))).alias("token_get"),
        F.sum(F.when(F.col("event_type") == "cost", F.col("item_num"))).alias("token_cost"),
        F.max("event_time").alias("newest"),
        newest_row_value("item_end", "event_time").alias("balance"),
    )
    closes = F.col("newest") == F.max("newest").over(Window.partitionBy("role_id", "part_date"))
    closing = F.collect_list(F.when(F.col("closes"), F.struct(F.col("balance").alias("token_remain"))))
    per_day = days.withColumn("closes", closes).groupBy("role_id", "date").agg(
        F.sum("token_get").alias("token_get"), F.sum("token_cost").alias("token_cost"), closing.alias("closing")
    )
    return per_day.select("role_id", "date", "token_get", "token_cost", F.inline_outer("closing"))


def user_months(payments: DataFrame, tokens: DataFrame) -> DataFrame:
    """Paying users per month: sums, and the balance of their last paying day."""
    paid = payments.groupBy("role_id", "date").agg(
        F.sum("money_rmb").alias("money_rmb"), F.sum("tokens").alias("token_get_by_pay")
    )
    days = paid.join(tokens, ["role_id", "date"], "left")
    return days.groupBy("role_id", month_of(F.col("date")).alias("month")).agg(
        *[F.sum(c).alias(c) for c in ("money_rmb", "token_get_by_pay", "token_get", "token_cost")],
        F.max_by("token_remain", "date").alias("token_remain"),
    )


FLOWS = ("money_rmb", "token_get_by_pay", "token_get", "token_cost")
_COUNTS = ("pay_users", "token_users", "_joined", "_moved", "_holders")
#: Closed months. Rows with ``role_id``: a user's last paying month in them and its balance. Rows without: a month's changes.
CLOSED = (
    "role_id string, month date, token_remain bigint, money_rmb decimal(38,4), token_get_by_pay bigint, token_get bigint, "
    "token_cost bigint, pay_users bigint, token_users bigint, _joined bigint, _moved bigint, _holders bigint"
)


def open_since(day: str) -> str:
    """The first month that events arriving after ``day`` can still reach; the months before it are closed."""
    return (date.fromisoformat(day) - timedelta(days=MAX_LATE_DAYS)).replace(day=1).isoformat()


def in_time(log: DataFrame) -> DataFrame:
    """Events whose date lies in the ``MAX_LATE_DAYS`` up to their partition day; others are wrong clocks."""
    part = F.to_date("part_date")
    return log.where(F.col("date").between(F.date_sub(part, MAX_LATE_DAYS), part))


def month_changes(months: DataFrame, closed: DataFrame | None = None) -> DataFrame:
    """Per month its sums, and what its users change: users more, balances moved.

    ``closed`` gives the balance a user brings from the closed months, and the changes of these months as they were.
    """
    months = months.where(F.col("role_id").isNotNull()).withColumn("_new", F.lit(True))
    if closed is not None:
        brought = closed.where(F.col("role_id").isNotNull()).select("role_id", "month", "token_remain", F.lit(False).alias("_new"))
        months = months.unionByName(brought, allowMissingColumns=True)
    order = Window.partitionBy("role_id").orderBy("month")
    before = F.lag("token_remain").over(order)
    balance, held = F.col("token_remain"), F.col("token_remain").isNotNull().cast("bigint")
    steps = months.select(
        "*",
        (F.row_number().over(order) == 1).cast("bigint").alias("_joined"),
        (F.coalesce(balance, F.lit(0)) - F.coalesce(before, F.lit(0))).alias("_moved"),
        (held - before.isNotNull().cast("bigint")).alias("_holders"),
    ).where("_new")
    active = (F.col("token_get") > 0) | (F.col("token_cost") > 0)
    changes = steps.groupBy("month").agg(
        *[F.sum(c).alias(c) for c in FLOWS],
        F.sum(F.when(F.col("money_rmb") > 0, 1).otherwise(0)).alias("pay_users"),
        F.sum(F.when(active, 1).otherwise(0)).alias("token_users"),
        *[F.sum(c).alias(c) for c in ("_joined", "_moved", "_holders")],
    )
    if closed is None:
        return changes
    return changes.unionByName(closed.where(F.col("role_id").isNull()).select("month", *FLOWS, *_COUNTS))


def close_months(months: DataFrame, closed: DataFrame | None, until: str) -> DataFrame:
    """``closed`` with the months before ``until`` added to it."""
    ended = months.where(F.col("month") < F.lit(until).cast("date"))
    users = ended.where(F.col("role_id").isNotNull()).select("role_id", "month", "token_remain")
    if closed is not None:
        users = users.unionByName(closed.where(F.col("role_id").isNotNull()).select("role_id", "month", "token_remain"))
    last = users.groupBy("role_id").agg(F.max("month").alias("month"), F.max_by("token_remain", "month").alias("token_remain"))
    both = last.unionByName(month_changes(ended, closed), allowMissingColumns=True)
    schema = StructType.fromDDL(CLOSED)
    return both.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def month_totals(months: DataFrame, as_of: str, closed: DataFrame | None = None) -> DataFrame:
    """Month sums in which every user counts from the first paying month on, with the last known balance.

    Instead of one row per user and month up to ``as_of``, each user-month contributes the
    change it makes (a user more, a balance moved). The changes are added up per month, and
    only those few month rows are spread over the months that follow.
    """
    per_month = month_changes(months, closed)
    until = month_of(F.lit(as_of).cast("date"))
    spread = per_month.withColumn("cal_month", F.explode(months_from_to(F.col("month"), until)))
    own = F.col("month") == F.col("cal_month")
    return spread.groupBy("cal_month").agg(
        *[F.sum(F.when(own, F.col(c))).alias(c) for c in FLOWS],
        *[F.sum(F.when(own, F.col(c)).otherwise(0)).alias(c) for c in ("pay_users", "token_users")],
        F.sum("_joined").alias("users"),
        F.when(F.sum("_holders") > 0, F.sum("_moved")).alias("token_remain"),
    )


def paying_months(payment_log: DataFrame, token_log: DataFrame, rates: DataFrame, game: Game, first_day: str, as_of: str) -> DataFrame:
    """``user_months`` from the first day on, read from the partitions from that day on: no event arrives before its date."""
    paid = token_payments(in_time(since(payment_log, first_day, as_of)), rates, game)
    tokens = token_days(in_time(since(token_log, first_day, as_of)), game)
    opened = F.col("date") >= F.lit(first_day).cast("date")
    return user_months(paid.where(opened), tokens.where(opened))


def token_monthly(
    payment_log: DataFrame,
    token_log: DataFrame,
    rates: DataFrame,
    game: Game,
    as_of: str,
) -> DataFrame:
    """The ledger from its start on. ``diff`` is what gains, spending and balances leave unexplained.

    Events dated before the ledger's first day, and wrong clocks (``in_time``), belong to no month of it.
    """
    return ledger_report(month_totals(paying_months(payment_log, token_log, rates, game, game.ledger_start, as_of), as_of))


def token_monthly_continued(
    payment_log: DataFrame, token_log: DataFrame, rates: DataFrame, game: Game, window: RunWindow, state: Checkpoints
) -> DataFrame:
    """The same ledger from the months closed before the window and the partitions since; closes months for the next run.

    A closed month keeps the rates it was closed with.
    """
    base = state.newest(window.start_date, CLOSED)
    first_day, closed = game.ledger_start, None
    if base is not None:
        first_day, closed = max(open_since(base[0]), game.ledger_start), base[1]
    months = settle(paying_months(payment_log, token_log, rates, game, first_day, window.end_date))
    report = settle(ledger_report(month_totals(months, window.end_date, closed)))  # before older checkpoints may go
    state.store(close_months(months, closed, open_since(window.end_date)), window)
    return report


def ledger_report(totals: DataFrame) -> DataFrame:
    ledger = with_previous_month(totals, "cal_month", "token_remain", "token_remain_lastmonth")
    carried = F.when(F.col("has_previous"), F.col("token_remain_lastmonth")).otherwise(F.lit(0))
    left_over = (
        F.col("token_get") + F.coalesce("token_remain_lastmonth", F.lit(0)) - F.col("token_cost") - F.col("token_remain")
    )
    return ledger.select(
        "cal_month", F.col("money_rmb").cast(LEDGER).alias("money_rmb"), "users", "pay_users", "token_users",
        "token_get_by_pay", "token_get", "token_cost", "token_remain", "token_remain_lastmonth",
        unit_price(F.col("money_rmb"), F.col("token_get") + carried).alias("price"),
        left_over.alias("diff"),
    )
