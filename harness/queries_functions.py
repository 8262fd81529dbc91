"""Scalar, date, money, array, map and JSON functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from harness.logs import LEDGER_AS_OF, Logs
from harness.registry import query
from rolemart.functions import dates, money, nested, text
from rolemart.operators.details import explode_details
from rolemart.operators.lookups import join_lookup


@query(
    "fn_split_part",
    "SELECT role_id, event_time, payment_itemid, CASE WHEN contains(payment_itemid, ';') "
    "THEN CAST(string_split(payment_itemid, ';')[2] AS BIGINT) END AS token_num FROM order_payments",
)
def _(t: Logs):
    return t.order_payments.select(
        "role_id", "event_time", "payment_itemid", text.part_of(F.col("payment_itemid"), ";", 2).cast("bigint").alias("token_num")
    )


@query(
    "fn_substring",
    "SELECT role_id, event_time, CAST(fromrare % 10 AS BIGINT) AS hero_star, CAST(torare % 10 AS BIGINT) AS target_star FROM upgraderare_log",
)
def _(t: Logs):
    return t.upgraderare_log.select(
        "role_id", "event_time",
        *[text.digit_at(F.col(c), 3).alias(n) for c, n in (("fromrare", "hero_star"), ("torare", "target_star"))],
    )


@query(
    "fn_concat",
    "SELECT role_id, event_time, level, '[' || (level // 5 * 5) || ',' || (level // 5 * 5 + 5) || ')' AS level_hist FROM base_log",
)
def _(t: Logs):
    label = text.bucket_label(text.bucket_floor(F.col("level"), 5), 5)
    return t.base_log.select("role_id", "event_time", "level", label.alias("level_hist"))


@query(
    "fn_cast",
    "SELECT event_id, CAST(round(CAST(value AS DECIMAL(32,4)), 0) AS BIGINT) AS rounded, CAST(value AS DECIMAL(32,4)) AS amount, "
    "CAST(user_id AS VARCHAR) AS role_id, CAST(ts AS DATE) AS day, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS midnight, "
    "CAST(CAST(ts AS DATE) AS VARCHAR) AS day_text FROM events",
)
def _(t: Logs):
    amount = F.col("value").cast("decimal(32,4)")
    return t.events.select(
        "event_id", money.rounded_long(amount).alias("rounded"), amount.alias("amount"), "role_id",
        F.col("event_time").cast("date").alias("day"), F.col("date").cast("timestamp_ntz").alias("midnight"),
        F.col("date").cast("string").alias("day_text"),
    )


@query("fn_date", "SELECT event_id, CAST(ts AS DATE) AS day FROM events")
def _(t: Logs):
    return t.events.select("event_id", F.to_date("event_time").alias("day"))


@query(
    "fn_date_diff_day",
    "SELECT d.role_id, d.date, CAST(d.date - i.install_date AS INTEGER) AS retention_day, "
    "CAST(d.date - i.firstpay_date AS INTEGER) AS pay_retention_day FROM daily AS d LEFT JOIN info AS i USING (role_id)",
)
def _(t: Logs):
    joined = t.daily.select("role_id", "date").join(t.info.select("role_id", "install_date", "firstpay_date"), "role_id", "left")
    return joined.select(
        "role_id", "date", dates.days_between(F.col("install_date"), F.col("date")).alias("retention_day"),
        dates.days_between(F.col("firstpay_date"), F.col("date")).alias("pay_retention_day"),
    )


@query(
    "fn_date_diff_month",
    "SELECT o.role_id, o.date, CAST(date_diff('month', date_trunc('month', f.first), date_trunc('month', o.date)) AS INTEGER) AS months "
    "FROM order_payments AS o JOIN (SELECT role_id, min(date) AS first FROM order_payments GROUP BY role_id) AS f USING (role_id)",
)
def _(t: Logs):
    first = t.order_payments.groupBy("role_id").agg(F.min("date").alias("first"))
    return t.order_payments.select("role_id", "date").join(first, "role_id").select(
        "role_id", "date", dates.months_between(F.col("first"), F.col("date")).alias("months")
    )


@query("fn_date_add_day", "SELECT event_id, CAST(ts AS DATE) - 15 AS before, CAST(ts AS DATE) + 1 AS after FROM events")
def _(t: Logs):
    return t.events.select("event_id", F.date_add("date", -15).alias("before"), F.date_add("date", 1).alias("after"))


@query("fn_date_trunc_month", "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders")
def _(t: Logs):
    return t.read("orders").select("o_orderkey", dates.month_of(F.to_date("o_orderdate")).alias("month"))


@query(
    "fn_date_format",
    "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m') AS month, date_trunc('hour', ts) AS hour FROM events",
)
def _(t: Logs):
    ts = F.col("event_time")
    return t.events.select(
        "event_id", dates.day_text(ts).alias("day"), dates.month_text(ts).alias("month"), dates.hour_of(ts).alias("hour")
    )


@query(
    "fn_now",
    "SELECT o_orderkey, CAST(DATE '2001-08-31' - CAST(o_orderdate AS DATE) AS INTEGER) AS age_days FROM orders "
    "WHERE strftime(o_orderdate, '%Y-%m-%d') <= '2001-08-31'",
)
def _(t: Logs):
    as_of = F.lit(LEDGER_AS_OF).cast("date")
    day = F.to_date("o_orderdate")
    return t.read("orders").where(day <= as_of).select("o_orderkey", dates.days_between(day, as_of).alias("age_days"))


@query("fn_int_div", "SELECT role_id, event_time, level // 5 * 5 AS level_hs, level // 10 AS tens FROM base_log")
def _(t: Logs):
    return t.base_log.select(
        "role_id", "event_time", text.bucket_floor(F.col("level"), 5).alias("level_hs"),
        F.call_function("div", F.col("level"), F.lit(10)).alias("tens"),
    )


@query(
    "fn_decimal_div",
    "SELECT role_id, CAST(round(money / nullif(units, 0), 4) AS DECIMAL(32,4)) AS price FROM ("
    "SELECT role_id, sum(money) AS money, sum(CASE WHEN level > 30 THEN level ELSE 0 END) AS units FROM payment_log GROUP BY role_id)",
)
def _(t: Logs):
    sums = t.payment_log.groupBy("role_id").agg(
        F.sum("money").alias("money"), F.sum(F.when(F.col("level") > 30, F.col("level")).otherwise(0)).alias("units")
    )
    return sums.select("role_id", money.unit_price(F.col("money"), F.col("units")).alias("price"))


@query(
    "fn_currency_convert",
    "SELECT p.role_id, p.event_time, CAST(p.money * CAST(r.rate AS DECIMAL(9,4)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(32,4)) AS money_rmb "
    "FROM order_payments AS p LEFT JOIN rates AS r ON r.currency = p.currency AND r.currency_time = strftime(p.date, '%Y-%m')",
)
def _(t: Logs):
    dated = t.order_payments.withColumn("currency_time", dates.month_text(F.col("date")))
    rated = join_lookup(dated, t.home_rates, ["currency_time"])
    return rated.select("role_id", "event_time", money.minor_to_home(F.col("money"), F.col("exchange_rate")).alias("money_rmb"))


@query("fn_abs", "SELECT event_id, abs(250 - CAST(value AS DECIMAL(32,4))) AS distance FROM events")
def _(t: Logs):
    return t.events.select("event_id", F.abs(F.lit(250) - F.col("value").cast("decimal(32,4)")).cast("decimal(33,4)").alias("distance"))


@query(
    "fn_case_label",
    "SELECT role_id, CASE WHEN firstpay_date IS NULL THEN 'not_break' WHEN firstpay_date = install_date THEN 'firstdate_break' "
    "ELSE 'other_break' END AS break_type FROM all_info",
)
def _(t: Logs):
    label = (
        F.when(F.col("install_date") == F.col("firstpay_date"), "firstdate_break")
        .when(F.col("firstpay_date").isNotNull(), "other_break").otherwise("not_break")
    )
    return t.all_info.select("role_id", label.alias("break_type"))


@query("fn_coalesce", "SELECT role_id, event_time, coalesce(free_num, 0) + coalesce(paid_num, 0) AS amount FROM core_log")
def _(t: Logs):
    amount = F.coalesce("free_num", F.lit(0)) + F.coalesce("paid_num", F.lit(0))
    return t.core_log.select("role_id", "event_time", amount.alias("amount"))


@query(
    "fn_unnest_array",
    "SELECT s.part_date, s.date, s.role_id, f.flag_id, f.flag_level, f.flag_star, f.flag_awake FROM spine AS s JOIN flag_rows AS f USING (part_date, role_id)",
)
def _(t: Logs):
    return explode_details(t.flags, "flag_detail", ["part_date", "date", "role_id"])


_SLOT_LISTS = """
    SELECT s.part_date, s.date, s.role_id, x.ids AS one, y.ids AS two FROM spine AS s
    LEFT JOIN (SELECT part_date, role_id, list(artifact1_id ORDER BY artifact1_id) AS ids FROM artifact1_rows GROUP BY ALL) AS x USING (part_date, role_id)
    LEFT JOIN (SELECT part_date, role_id, list(artifact2_id ORDER BY artifact2_id) AS ids FROM artifact2_rows GROUP BY ALL) AS y USING (part_date, role_id)
"""


@query(
    "fn_unnest_zip",
    f"SELECT part_date, date, role_id, one[i] AS first_id, two[i] AS second_id FROM (SELECT *, "
    f"unnest(range(1, greatest(coalesce(len(one), 0), coalesce(len(two), 0)) + 1)) AS i FROM ({_SLOT_LISTS}))",
)
def _(t: Logs):
    pairs = t.artifacts.select("part_date", "date", "role_id", F.inline(nested.zipped(F.col("artifact1_detail"), F.col("artifact2_detail"))))
    return pairs.select(
        "part_date", "date", "role_id", F.col("left.artifact1_id").alias("first_id"), F.col("right.artifact2_id").alias("second_id")
    )


@query(
    "fn_sequence_day",
    "SELECT role_id, CAST(unnest(generate_series(install_date, DATE '2024-01-31', INTERVAL 1 DAY)) AS DATE) AS day FROM all_info",
)
def _(t: Logs):
    return t.all_info.select(
        "role_id", F.explode(dates.days_from_to(F.col("install_date"), F.lit("2024-01-31").cast("date"))).alias("day")
    )


@query(
    "fn_sequence_month",
    "SELECT o_orderkey, CAST(unnest(generate_series(date_trunc('month', o_orderdate), TIMESTAMP '2001-08-01', INTERVAL 1 MONTH)) AS DATE) AS cal_month FROM orders",
)
def _(t: Logs):
    start = dates.month_of(F.to_date("o_orderdate"))
    return t.read("orders").select(
        "o_orderkey", F.explode(dates.months_from_to(start, F.lit("2001-08-01").cast("date"))).alias("cal_month")
    )


@query(
    "fn_reduce",
    "SELECT part_date, role_id, CAST(coalesce(sum(gain), 0) AS BIGINT) AS core_add, CAST(coalesce(sum(cost), 0) AS BIGINT) AS core_cost FROM core_reason GROUP BY ALL",
)
def _(t: Logs):
    return t.core.select(
        "part_date", "role_id", nested.map_total(F.col("coregain_detail")).alias("core_add"),
        nested.map_total(F.col("corecost_detail")).alias("core_cost"),
    )


@query(
    "fn_map_values",
    "SELECT part_date, role_id, count(gain) AS reasons, max(gain) AS largest FROM core_reason GROUP BY ALL",
)
def _(t: Logs):
    values = F.map_values("coregain_detail")
    return t.core.select("part_date", "role_id", F.size(values).cast("bigint").alias("reasons"), F.array_max(values).alias("largest"))


@query("fn_json_to_map", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(1 AS BIGINT) AS members FROM events")
def _(t: Logs):
    amounts = nested.amounts_from_json(F.col("props"))
    return t.read("events").select("event_id", amounts["k"].alias("k"), F.size(amounts).cast("bigint").alias("members"))


@query("fn_unnest_map", "SELECT part_date, role_id, reason, cost AS amount FROM core_reason WHERE cost IS NOT NULL")
def _(t: Logs):
    return t.core.select("part_date", "role_id", F.explode("corecost_detail").alias("reason", "amount"))


@query(
    "fn_json_object",
    "SELECT role_id, event_time, CAST(json_object('item_id', item_id, 'item_add', item_add, 'item_cost', item_cost) AS VARCHAR) AS detail FROM item_log",
)
def _(t: Logs):
    return t.item_log.select(
        "role_id", "event_time", nested.json_text(F.struct("item_id", "item_add", "item_cost")).alias("detail")
    )


@query("fn_json_parse", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def _(t: Logs):
    return t.read("events").select("event_id", F.from_json("props", "k int").alias("p")).select("event_id", "p.k")


@query(
    "fn_json_extract_cast",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.k') AS k_text, "
    "json_extract_string(props, '$.absent') AS absent FROM events",
)
def _(t: Logs):
    k = F.get_json_object("props", "$.k")
    return t.read("events").select(
        "event_id", k.cast("bigint").alias("k"), k.alias("k_text"), F.get_json_object("props", "$.absent").alias("absent")
    )
