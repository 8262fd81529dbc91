"""Scans, lookups and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from harness.logs import DAYS, GAME, LAST_DAY, LEDGER_AS_OF, Logs
from harness.registry import query
from rolemart.config import RunWindow
from rolemart.operators.users import user_metrics
from rolemart.plans import holdings, upstream
from rolemart.session import new_scratch
from rolemart.sources.logs import in_window, since, trailing
from rolemart.sources.lookups import currency_rates, read_dimension
from rolemart.sources.sinks import full_refresh, overwrite_range, read_table
from rolemart.sources.tables import TABLES, Table

_DAY_COUNT = (
    "SELECT part_date, count(*) AS row_count, count(DISTINCT role_id) AS users, "
    "CAST(sum(online_time) AS BIGINT) AS online_time FROM base_log"
)


def _day_count(log):
    return user_metrics(
        log, ["part_date"], {"users": None}, {"row_count": F.lit(1), "online_time": F.col("online_time")}
    )


@query("scan_partition_range", f"{_DAY_COUNT} WHERE part_date BETWEEN '2024-01-08' AND '2024-01-31' GROUP BY part_date")
def _(t: Logs):
    return _day_count(in_window(t.base_log, RunWindow("2024-01-08", "2024-01-31")))


@query("scan_trailing_window", f"{_DAY_COUNT} WHERE part_date >= '2024-01-15' AND part_date <= '2024-01-30' GROUP BY part_date")
def _(t: Logs):
    return _day_count(trailing(t.base_log, LAST_DAY, 15))


@query(
    "scan_since_fixed_start",
    "SELECT part_date, count(*) AS payments, CAST(sum(money) AS DECIMAL(32,4)) AS money FROM order_payments "
    "WHERE part_date >= '1995-01-01' AND part_date <= '2001-08-31' GROUP BY part_date",
)
def _(t: Logs):
    return since(t.order_payments, GAME.ledger_start, LEDGER_AS_OF).groupBy("part_date").agg(
        F.count(F.lit(1)).alias("payments"), F.sum("money").cast("decimal(32,4)").alias("money")
    )


@query(
    "scan_full",
    "SELECT hero_id, count(*) AS row_count, min(date) AS first_day, max(herostar) AS best FROM herosnap_log GROUP BY hero_id",
)
def _(t: Logs):
    return t.herosnap_log.groupBy("hero_id").agg(
        F.count(F.lit(1)).alias("row_count"), F.min("date").alias("first_day"), F.max("herostar").alias("best")
    )


@query(
    "source_federated_rate",
    """
    SELECT r.currency_time, r.rate AS exchange_rate, count(p.role_id) AS payments
    FROM (SELECT * FROM rates WHERE currency = 'JPY') AS r
    LEFT JOIN order_payments AS p ON strftime(p.date, '%Y-%m') = r.currency_time GROUP BY ALL
    """,
)
def _(t: Logs):
    paid = t.order_payments.groupBy(F.substring("part_date", 1, 7).alias("currency_time")).agg(
        F.count("role_id").alias("n")
    )
    return currency_rates(t.rates, GAME.currency).join(paid, "currency_time", "left").select(
        "currency_time", "exchange_rate", F.coalesce("n", F.lit(0)).alias("payments")
    )


@query(
    "source_inline_values",
    "SELECT payment_itemid, CAST(token_num AS BIGINT) AS token_num, count(*) AS payments "
    "FROM order_payments LEFT JOIN prices USING (payment_itemid) GROUP BY ALL",
)
def _(t: Logs):
    sold = t.order_payments.groupBy("payment_itemid").agg(F.count(F.lit(1)).alias("payments"))
    return sold.join(t.prices, "payment_itemid", "left").select("payment_itemid", "token_num", "payments")


@query(
    "source_dim_csv",
    "SELECT CAST(p_partkey AS VARCHAR) AS item_id, p_brand AS color, p_name || ' \"' || p_type || '\"' AS item_name FROM part",
)
def _(t: Logs):
    path = new_scratch(t.spark, "dimension")
    t.read("part").select(
        F.expr("concat(p_name, ' \"', p_type, '\"')").alias("item_name"),
        F.col("p_partkey").alias("item_id"),
        F.col("p_brand").alias("color"),
    ).write.option("header", True).option("escape", '"').csv(path)
    return read_dimension(t.spark, path, "item")


@query(
    "sink_incremental_partitions",
    """
    SELECT part_date, count(DISTINCT role_id) AS dau FROM base_log
    WHERE part_date < '2024-01-15' OR part_date > '2024-01-25' OR event_name = 'purchase' AND part_date <= '2024-01-20'
    GROUP BY part_date
    """,
)
def _(t: Logs):
    """A rerun of some days: days with new rows are replaced, days left without rows disappear."""
    table, path = TABLES["ads_active_daily"], new_scratch(t.spark, "active")
    overwrite_range(upstream.active_daily(t.base_log), table, path, DAYS)
    rerun = t.base_log.where("event_name = 'purchase' and part_date between '2024-01-15' and '2024-01-20'")
    overwrite_range(upstream.active_daily(rerun), table, path, RunWindow("2024-01-15", "2024-01-25"))
    return read_table(t.spark, table, path)


@query(
    "sink_full_refresh",
    "SELECT role_id, max(flag_level) AS flag_level, max(flag_star) AS flag_star, max(flag_awake) AS flag_awake, flag_id "
    "FROM flag_rows JOIN (SELECT DISTINCT part_date, role_id FROM spine) AS active USING (part_date, role_id) GROUP BY ALL",
)
def _(t: Logs):
    table, path = TABLES["ads_flag"], new_scratch(t.spark, "flags")
    report = holdings.flag_best(t.flags)
    full_refresh(report.withColumn("flag_level", F.lit(-1)), table, path)
    full_refresh(report, table, path)
    return read_table(t.spark, table, path)


@query("sink_by_name", "SELECT date, retention_day, active_users FROM (" + """
    SELECT i.install_date AS date, CAST(d.date - i.install_date AS BIGINT) AS retention_day, count(DISTINCT role_id) AS active_users
    FROM daily AS d LEFT JOIN all_info AS i USING (role_id) WHERE i.is_test IS NULL GROUP BY ALL)""")
def _(t: Logs):
    table, path = TABLES["ads_user_retention"], new_scratch(t.spark, "cohorts")
    report = upstream.user_retention(t.daily, t.all_info)
    full_refresh(report.select("active_users", "date", "retention_day"), table, path)
    return read_table(t.spark, table, path)


def _stored(t: Logs, rows, ddl: str, partition: str):
    table, path = Table("scratch", "df", ddl, partition), new_scratch(t.spark, partition)
    full_refresh(rows, table, path)
    return read_table(t.spark, table, path)


@query("partition_by_day", "SELECT role_id, CAST(sum(online_time) AS BIGINT) AS online_time, part_date FROM base_log GROUP BY ALL")
def _(t: Logs):
    rows = t.base_log.groupBy("part_date", "role_id").agg(F.sum("online_time").alias("online_time"))
    return _stored(t, rows, "role_id string, online_time bigint, part_date string", "part_date")


@query(
    "partition_by_month",
    "SELECT role_id, count(*) AS payments, strftime(date, '%Y-%m') || '-01' AS part_month FROM order_payments GROUP BY ALL",
)
def _(t: Logs):
    rows = t.order_payments.groupBy("role_id", F.trunc("date", "month").cast("string").alias("part_month")).agg(
        F.count(F.lit(1)).alias("payments")
    )
    return _stored(t, rows, "role_id string, payments bigint, part_month string", "part_month")


@query("partition_by_entity", "SELECT role_id, max(herostar) AS hero_star, CAST(hero_id AS VARCHAR) AS hero_id FROM herosnap_log GROUP BY ALL")
def _(t: Logs):
    rows = t.herosnap_log.groupBy("role_id", "hero_id").agg(F.max("herostar").alias("hero_star"))
    return _stored(t, rows, "role_id string, hero_star bigint, hero_id string", "hero_id")


@query(
    "run_params",
    "SELECT date, count(DISTINCT role_id) AS users FROM base_log WHERE part_date BETWEEN '2024-01-01' AND '2024-01-31' GROUP BY date",
)
def _(t: Logs):
    return user_metrics(in_window(t.base_log, DAYS), ["date"], {"users": None})
