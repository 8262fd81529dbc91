"""Projections, filters, joins, aggregations, windows, ordering and set operations."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from harness.logs import CHECK_MOMENT, DAYS, GAME, Logs
from harness.registry import query
from rolemart.functions.dates import month_of, month_text
from rolemart.functions.text import bucket_floor
from rolemart.operators.compare import difference_by_key, difference_of_totals, duplicates
from rolemart.operators.details import (
    active_spine, collect_details, explode_details, latest_non_null, newest_row_value,
)
from rolemart.operators.grids import axis_grid, fill_days, running_total
from rolemart.operators.lookups import join_lookup
from rolemart.operators.months import carry_forward, with_previous_month
from rolemart.operators.users import user_metrics, with_user_attrs, without_test_accounts
from rolemart.plans import checks
from rolemart.session import settle

# ---- projections and filters


@query(
    "project_cast_rename",
    "SELECT part_date, role_id, CAST(recruitid AS VARCHAR) AS summon_id, CAST(count AS BIGINT) AS summon_count, "
    "CAST(NULL AS BIGINT) AS core_summon FROM summon_log",
)
def _(t: Logs):
    return t.summon_log.select(
        "part_date", "role_id", F.col("recruitid").cast("string").alias("summon_id"),
        F.col("count").cast("bigint").alias("summon_count"), F.lit(None).cast("bigint").alias("core_summon"),
    )


@query(
    "filter_is_test_null",
    "SELECT d.date, d.role_id, d.pay_count, i.zone_id FROM daily AS d LEFT JOIN info AS i USING (role_id) WHERE i.is_test IS NULL",
)
def _(t: Logs):
    return with_user_attrs(t.daily, t.info.withColumnRenamed("zone_id", "zone"), ["zone"]).select(
        "date", "role_id", "pay_count", F.col("zone").alias("zone_id")
    )


@query("filter_column_is_null", "SELECT date, role_id, money FROM daily WHERE is_test IS NULL")
def _(t: Logs):
    return t.daily.where(F.col("is_test").isNull()).select("date", "role_id", "money")


@query(
    "filter_string_range",
    "SELECT role_id, item_id, event_time, item_remain FROM item_log WHERE item_id >= '13000' AND item_id <= '14000'",
)
def _(t: Logs):
    low, high = GAME.tracked_items
    return t.item_log.where(F.col("item_id").between(low, high)).select("role_id", "item_id", "event_time", "item_remain")


@query(
    "filter_neq_or",
    "SELECT role_id, event_time, artifact1_id, artifact2_id FROM herosnap_log WHERE artifact1_id <> 0 OR artifact2_id <> 0",
)
def _(t: Logs):
    return t.herosnap_log.where((F.col("artifact1_id") != 0) | (F.col("artifact2_id") != 0)).select(
        "role_id", "event_time", "artifact1_id", "artifact2_id"
    )


@query("filter_in_list", "SELECT role_id, date, payment_itemid, money FROM order_payments SEMI JOIN prices USING (payment_itemid)")
def _(t: Logs):
    return t.order_payments.where(F.col("payment_itemid").isin([p for p, _n in GAME.token_packs])).select(
        "role_id", "date", "payment_itemid", "money"
    )


@query("filter_eq_literal", "SELECT role_id, date, item_num, item_end FROM token_log WHERE item_id = '2' AND reason <> '638'")
def _(t: Logs):
    kept = (F.col("item_id") == GAME.token_item_id) & (F.col("reason") != GAME.excluded_reason)
    return t.token_log.where(kept).select("role_id", "date", "item_num", "item_end")


@query(
    "filter_rank_one",
    "SELECT role_id, date, token_remain FROM (SELECT role_id, date, item_end AS token_remain, row_number() OVER "
    "(PARTITION BY role_id, part_date ORDER BY event_time DESC, item_end NULLS LAST) AS nth FROM token_log) WHERE nth = 1",
)
def _(t: Logs):
    return t.token_log.groupBy("role_id", "part_date").agg(
        F.to_date(F.max("event_time")).alias("date"), newest_row_value("item_end", "event_time").alias("token_remain")
    ).drop("part_date")


@query(
    "filter_coalesce_mismatch",
    """
    SELECT e.part_date, e.expected, a.actual, coalesce(e.expected, 0) - coalesce(a.actual, 0) AS difference
    FROM (SELECT part_date, count(DISTINCT role_id) AS expected FROM base_log GROUP BY part_date) AS e
    LEFT JOIN (SELECT part_date, count(DISTINCT role_id) AS actual FROM payment_log GROUP BY part_date) AS a USING (part_date)
    WHERE coalesce(e.expected, 0) <> coalesce(a.actual, 0)
    """,
)
def _(t: Logs):
    users = {"value": None}
    return difference_by_key(
        user_metrics(t.base_log, ["part_date"], users), user_metrics(t.payment_log, ["part_date"], users),
        ["part_date"], "value", signed=True, only_mismatch=True,
    )


@query("filter_having_dup", "SELECT role_id, part_date, count(*) AS row_count FROM payment_log GROUP BY ALL HAVING count(*) > 1")
def _(t: Logs):
    return duplicates(t.payment_log, ["role_id", "part_date"])


@query(
    "filter_before_hour",
    "SELECT role_id, event_time FROM base_log WHERE part_date BETWEEN '2024-01-29' AND '2024-01-30' "
    "AND event_time < date_trunc('hour', TIMESTAMP '2024-01-30 15:30:00')",
)
def _(t: Logs):
    return checks.until_hour(t.base_log, CHECK_MOMENT, "event_time").select("role_id", "event_time")


# ---- joins


@query(
    "join_left_user_attr",
    "SELECT d.role_id, d.date, d.level_max, i.zone_id, i.channel, i.install_date FROM daily AS d LEFT JOIN info AS i USING (role_id)",
)
def _(t: Logs):
    return t.daily.select("role_id", "date", "level_max").join(
        t.info.select("role_id", "zone_id", "channel", "install_date"), "role_id", "left"
    )


@query(
    "join_left_multi_key",
    "SELECT h.role_id, h.part_date, h.hour, h.money, d.moneyrmb_ac FROM hourly AS h LEFT JOIN derive AS d USING (role_id, part_date)",
)
def _(t: Logs):
    return t.hourly.select("role_id", "part_date", "hour", "money").join(
        t.derive.select("role_id", "part_date", "moneyrmb_ac"), ["role_id", "part_date"], "left"
    )


@query(
    "join_left_two_details",
    """
    SELECT s.part_date, s.date, s.role_id, coalesce(f.n, -1) AS slot1, coalesce(g.n, -1) AS slot2
    FROM spine AS s
    LEFT JOIN (SELECT part_date, role_id, count(*) AS n FROM artifact1_rows GROUP BY ALL) AS f USING (part_date, role_id)
    LEFT JOIN (SELECT part_date, role_id, count(*) AS n FROM artifact2_rows GROUP BY ALL) AS g USING (part_date, role_id)
    """,
)
def _(t: Logs):
    def sized(slot: str):
        return F.when(F.col(slot).isNull(), -1).otherwise(F.size(slot)).cast("bigint")

    return t.artifacts.select(
        "part_date", "date", "role_id", sized("artifact1_detail").alias("slot1"), sized("artifact2_detail").alias("slot2")
    )


_METRICS_SQL = """
    SELECT b.date, i.zone_id, i.channel, count(DISTINCT b.role_id) AS users,
           count(DISTINCT b.role_id) FILTER (b.date = i.install_date) AS new_users
    FROM base_log AS b LEFT JOIN info AS i USING (role_id) WHERE i.is_test IS NULL GROUP BY ALL
"""
_GRID_SQL = f"""
    WITH m AS ({_METRICS_SQL}), g AS (
      SELECT zone_id, channel, CAST(d AS DATE) AS date FROM (SELECT DISTINCT zone_id, channel FROM m),
             generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY) AS s(d))
"""


def _metrics(t: Logs):
    rows = with_user_attrs(t.daily.select("date", "role_id"), t.info, ["zone_id", "channel", "install_date"])
    return user_metrics(rows, ["date", "zone_id", "channel"], {"users": None, "new_users": F.col("date") == F.col("install_date")})


@query(
    "join_spine_metrics",
    _GRID_SQL + "SELECT g.date, g.zone_id, g.channel, m.users, m.new_users FROM g LEFT JOIN m "
    "ON m.date = g.date AND m.zone_id = g.zone_id AND m.channel = g.channel",
)
def _(t: Logs):
    return fill_days(_metrics(t), ["zone_id", "channel"], ["users", "new_users"], DAYS.start_date, DAYS.end_date)


@query(
    "join_shifted_day",
    f"WITH m AS ({_METRICS_SQL}) SELECT a.date, a.zone_id, a.channel, a.users, c.new_users AS new_users_before FROM m AS a "
    "LEFT JOIN m AS c ON a.date = c.date + 1 AND a.zone_id = c.zone_id AND a.channel = c.channel",
)
def _(t: Logs):
    metrics = settle(_metrics(t))
    before = metrics.select(F.date_add("date", 1).alias("date"), "zone_id", "channel", F.col("new_users").alias("new_users_before"))
    return metrics.drop("new_users").join(before, ["date", "zone_id", "channel"], "left")


@query(
    "join_history_baseline",
    f"""
    WITH m AS ({_METRICS_SQL}), past AS (
      SELECT zone_id, channel, CAST(sum(new_users) AS BIGINT) AS reached FROM m WHERE date < DATE '2024-01-03' GROUP BY ALL)
    SELECT m.date, m.zone_id, m.channel, m.new_users + coalesce(past.reached, 0) AS reached
    FROM m LEFT JOIN past ON past.zone_id = m.zone_id AND past.channel = m.channel WHERE m.date >= DATE '2024-01-03'
    """,
)
def _(t: Logs):
    dims = ["zone_id", "channel"]
    metrics = settle(_metrics(t))
    first = F.lit("2024-01-03").cast("date")
    past = metrics.where(F.col("date") < first).groupBy(*dims).agg(F.sum("new_users").alias("_reached"))
    return metrics.where(F.col("date") >= first).join(past, dims, "left").select(
        "date", *dims, (F.col("new_users") + F.coalesce("_reached", F.lit(0))).alias("reached")
    )


@query(
    "join_rate_by_month",
    "SELECT p.role_id, p.event_time, p.money, r.rate AS exchange_rate FROM order_payments AS p "
    "LEFT JOIN rates AS r ON r.currency = 'JPY' AND r.currency_time = strftime(p.event_time, '%Y-%m')",
)
def _(t: Logs):
    dated = t.order_payments.withColumn("currency_time", month_text(F.col("event_time")))
    return join_lookup(dated, t.home_rates, ["currency_time"]).select("role_id", "event_time", "money", "exchange_rate")


@query(
    "join_config_lookup",
    "SELECT p.role_id, p.event_time, p.payment_itemid, CAST(c.token_num AS BIGINT) AS token_num "
    "FROM order_payments AS p LEFT JOIN prices AS c USING (payment_itemid)",
)
def _(t: Logs):
    return join_lookup(t.order_payments, t.prices, ["payment_itemid"]).select(
        "role_id", "event_time", "payment_itemid", "token_num"
    )


@query(
    "join_entity_stats",
    """
    SELECT u.hero_id, u.zone_id, u.upgrades, s.start_date, a.users
    FROM (SELECT CAST(hero AS VARCHAR) AS hero_id, zone_id, count(*) AS upgrades FROM upgraderare_log GROUP BY ALL) AS u
    LEFT JOIN (SELECT CAST(hero_id AS VARCHAR) AS hero_id, zone_id, min(date) AS start_date FROM herosnap_log GROUP BY ALL) AS s
           USING (hero_id, zone_id)
    LEFT JOIN (SELECT zone_id, count(DISTINCT role_id) AS users FROM base_log GROUP BY ALL) AS a USING (zone_id)
    """,
)
def _(t: Logs):
    upgrades = t.upgraderare_log.groupBy(F.col("hero").cast("string").alias("hero_id"), "zone_id").agg(F.count(F.lit(1)).alias("upgrades"))
    first = t.herosnap_log.groupBy(F.col("hero_id").cast("string").alias("hero_id"), "zone_id").agg(F.min("date").alias("start_date"))
    active = user_metrics(t.base_log, ["zone_id"], {"users": None})
    return upgrades.join(first, ["hero_id", "zone_id"], "left").join(active, "zone_id", "left")


@query(
    "join_dau",
    "SELECT r.date, r.summon_id, r.draws, a.dau FROM (SELECT date, CAST(recruitid AS VARCHAR) AS summon_id, "
    "CAST(sum(count) AS BIGINT) AS draws FROM summon_log GROUP BY ALL) AS r "
    "LEFT JOIN (SELECT date, count(DISTINCT role_id) AS dau FROM base_log GROUP BY date) AS a USING (date)",
)
def _(t: Logs):
    report = t.summon_log.groupBy("date", F.col("recruitid").cast("string").alias("summon_id")).agg(F.sum("count").alias("draws"))
    return report.join(user_metrics(t.base_log, ["date"], {"dau": None}), "date", "left")


@query(
    "join_full_outer",
    """
    SELECT coalesce(s.role_id, l.role_id) AS role_id, coalesce(s.hero, l.hero) AS hero, s.chips, l.best
    FROM (SELECT role_id, hero, CAST(sum(costchip) AS BIGINT) AS chips FROM upgraderare_log GROUP BY ALL) AS s
    FULL JOIN (SELECT role_id, hero, max(tolv) AS best FROM upgradehero_log GROUP BY ALL) AS l
      ON s.role_id = l.role_id AND s.hero = l.hero
    """,
)
def _(t: Logs):
    chips = t.upgraderare_log.groupBy("role_id", "hero").agg(F.sum("costchip").alias("chips"))
    best = t.upgradehero_log.groupBy("role_id", "hero").agg(F.max("tolv").alias("best"))
    return chips.join(best, ["role_id", "hero"], "full")


@query(
    "join_anti_test_accounts",
    "SELECT role_id, event_time, online_time FROM base_log ANTI JOIN test_accounts USING (role_id)",
)
def _(t: Logs):
    return without_test_accounts(t.base_log, t.test_accounts).select("role_id", "event_time", "online_time")


@query(
    "join_check_left",
    """
    SELECT e.role_id, e.expected, a.actual, abs(coalesce(e.expected, 0) - coalesce(a.actual, 0)) AS difference
    FROM (SELECT role_id, CAST(sum(online_time) AS BIGINT) AS expected FROM base_log GROUP BY role_id) AS e
    LEFT JOIN (SELECT role_id, CAST(sum(level) AS BIGINT) AS actual FROM payment_log GROUP BY role_id) AS a USING (role_id)
    """,
)
def _(t: Logs):
    return difference_by_key(
        t.base_log.groupBy("role_id").agg(F.sum("online_time").alias("value")),
        t.payment_log.groupBy("role_id").agg(F.sum("level").alias("value")), ["role_id"], "value",
    )


@query(
    "cross_scalar",
    "SELECT expected, actual, abs(expected - actual) AS difference FROM "
    "(SELECT count(*) AS expected FROM base_log) , (SELECT count(*) AS actual FROM payment_log)",
)
def _(t: Logs):
    one = F.count(F.lit(1)).alias("value")
    return difference_of_totals(t.base_log.agg(one), t.payment_log.agg(one), "value")


@query(
    "cross_grid",
    f"WITH m AS ({_METRICS_SQL}) SELECT zone_id, channel, date FROM (SELECT DISTINCT zone_id FROM m), "
    "(SELECT DISTINCT channel FROM m), (SELECT DISTINCT date FROM m)",
)
def _(t: Logs):
    metrics = settle(_metrics(t))
    return axis_grid(metrics.select("zone_id").distinct(), metrics, ["channel", "date"])


@query(
    "lateral_unnest",
    "SELECT s.part_date, s.date, s.role_id, r.item_id, r.item_end FROM spine AS s JOIN item_rows AS r USING (part_date, role_id)",
)
def _(t: Logs):
    return explode_details(t.items, "item_detail", ["part_date", "date", "role_id"]).drop("item_add", "item_cost")


# ---- aggregations


@query("agg_distinct_spine", "SELECT DISTINCT part_date, date, role_id FROM base_log_late")
def _(t: Logs):
    return active_spine(t.base_log_late)


@query(
    "agg_group_ordinal",
    "SELECT date, part_date, zone_id, channel, os, event_name, count(*) AS row_count FROM base_log_late GROUP BY ALL",
)
def _(t: Logs):
    return t.base_log_late.groupBy("date", "part_date", "zone_id", "channel", "os", "event_name").agg(
        F.count(F.lit(1)).alias("row_count")
    )


@query(
    "agg_sum",
    "SELECT part_date, CAST(sum(money) AS DECIMAL(32,4)) AS money, CAST(sum(web_rmb) AS DECIMAL(32,4)) AS web_rmb, "
    "CAST(sum(level) AS BIGINT) AS levels FROM payment_log GROUP BY part_date",
)
def _(t: Logs):
    return t.payment_log.groupBy("part_date").agg(
        *[F.sum(c).cast("decimal(32,4)").alias(c) for c in ("money", "web_rmb")], F.sum("level").alias("levels")
    )


@query(
    "agg_sum_if",
    "SELECT role_id, item_id, CAST(sum(CASE WHEN event_name = 'AddItem' THEN item_add END) AS BIGINT) AS item_add, "
    "CAST(sum(CASE WHEN event_name = 'CostItem' THEN item_cost END) AS BIGINT) AS item_cost FROM item_log GROUP BY ALL",
)
def _(t: Logs):
    return t.item_log.groupBy("role_id", "item_id").agg(
        F.sum(F.when(F.col("event_name") == "AddItem", F.col("item_add"))).alias("item_add"),
        F.sum(F.when(F.col("event_name") == "CostItem", F.col("item_cost"))).alias("item_cost"),
    )


@query("agg_count_distinct", "SELECT zone_id, channel, count(DISTINCT role_id) AS users FROM base_log GROUP BY ALL")
def _(t: Logs):
    return user_metrics(t.base_log, ["zone_id", "channel"], {"users": None})


@query(
    "agg_count_distinct_if",
    "SELECT date, channel, count(DISTINCT role_id) AS users, count(DISTINCT CASE WHEN level > 50 THEN role_id END) AS strong, "
    "count(DISTINCT CASE WHEN vip_level = 0 THEN role_id END) AS plain, "
    "CAST(sum(CASE WHEN level > 50 THEN online_time END) AS BIGINT) AS strong_time FROM base_log GROUP BY ALL",
)
def _(t: Logs):
    return user_metrics(
        t.base_log, ["date", "channel"],
        {"users": None, "strong": F.col("level") > 50, "plain": F.col("vip_level") == 0},
        {"strong_time": F.when(F.col("level") > 50, F.col("online_time"))},
    )


@query(
    "agg_count_rows",
    "SELECT hero, count(*) AS row_count, count(costchip) AS costs, count(CASE WHEN costchip > 250 THEN 1 END) AS dear "
    "FROM upgraderare_log GROUP BY hero",
)
def _(t: Logs):
    return t.upgraderare_log.groupBy("hero").agg(
        F.count(F.lit(1)).alias("row_count"), F.count("costchip").alias("costs"),
        F.count(F.when(F.col("costchip") > 250, 1)).alias("dear"),
    )


@query("agg_max", "SELECT role_id, flag_id, max(flag_level) AS best_level, max(event_time) AS last_seen FROM herosnap_log GROUP BY ALL")
def _(t: Logs):
    return t.herosnap_log.groupBy("role_id", "flag_id").agg(
        F.max("flag_level").alias("best_level"), F.max("event_time").alias("last_seen")
    )


@query("agg_min", "SELECT hero_id, zone_id, min(date) AS start_date, min(item) AS low FROM (SELECT *, flag_level AS item FROM herosnap_log) GROUP BY ALL")
def _(t: Logs):
    return t.herosnap_log.groupBy("hero_id", "zone_id").agg(F.min("date").alias("start_date"), F.min("flag_level").alias("low"))


@query(
    "agg_array",
    "SELECT part_date, role_id, CAST(to_json(list({'flag_id': flag_id, 'flag_level': flag_level} ORDER BY flag_id)) AS VARCHAR) AS detail "
    "FROM flag_rows GROUP BY ALL",
)
def _(t: Logs):
    best = t.herosnap_log.where("flag_id != 0").groupBy("role_id", "part_date", F.col("flag_id").cast("string").alias("flag_id")).agg(
        F.max("flag_level").alias("flag_level")
    )
    return collect_details(best, ["flag_id", "flag_level"], "detail").select("part_date", "role_id", F.to_json("detail").alias("detail"))


@query(
    "agg_rollup_user_day",
    "SELECT date, part_date, role_id, CAST(sum(money) AS DECIMAL(32,4)) AS money, min(exchange_rate) AS exchange_rate FROM hourly GROUP BY ALL",
)
def _(t: Logs):
    return t.hourly.groupBy("date", "part_date", "role_id").agg(
        F.sum("money").cast("decimal(32,4)").alias("money"), F.min("exchange_rate").alias("exchange_rate")
    )


@query(
    "agg_rollup_user_month",
    "SELECT CAST(date_trunc('month', date) AS DATE) AS month, role_id, min(level) AS level_min, max(level) AS level_max, "
    "count(*) AS pay_count, CAST(sum(money) AS DECIMAL(32,4)) AS money FROM order_payments GROUP BY ALL",
)
def _(t: Logs):
    return t.order_payments.groupBy(month_of(F.col("date")).alias("month"), "role_id").agg(
        F.min("level").alias("level_min"), F.max("level").alias("level_max"), F.count(F.lit(1)).alias("pay_count"),
        F.sum("money").cast("decimal(32,4)").alias("money"),
    )


@query("agg_histogram_bucket", "SELECT level // 5 * 5 AS level_hs, count(*) AS row_count, count(DISTINCT role_id) AS users FROM base_log GROUP BY ALL")
def _(t: Logs):
    return user_metrics(
        t.base_log.withColumn("level_hs", bucket_floor(F.col("level"), 5)), ["level_hs"], {"users": None}, {"row_count": F.lit(1)}
    )


@query("agg_global", "SELECT CAST(sum(money) AS DECIMAL(32,4)) AS money, count(*) AS payments, count(DISTINCT role_id) AS users FROM payment_log")
def _(t: Logs):
    return user_metrics(t.payment_log, [], {"users": None}, {"money": F.col("money"), "payments": F.lit(1)}).withColumn(
        "money", F.col("money").cast("decimal(32,4)")
    )


# ---- windows


@query(
    "win_row_number_latest",
    "SELECT role_id, part_date, item_end FROM (SELECT *, row_number() OVER (PARTITION BY role_id, part_date "
    "ORDER BY event_time DESC, item_end NULLS LAST) AS rn FROM token_log WHERE item_id = '2') WHERE rn = 1",
)
def _(t: Logs):
    return t.token_log.where(F.col("item_id") == GAME.token_item_id).groupBy("role_id", "part_date").agg(
        newest_row_value("item_end", "event_time").alias("item_end")
    )


def _user_days(t: Logs):
    return t.order_payments.groupBy("role_id", "date").agg(F.sum("money").cast("decimal(32,4)").alias("money"))


_USER_DAYS_SQL = "SELECT role_id, date, CAST(sum(money) AS DECIMAL(32,4)) AS money FROM order_payments GROUP BY ALL"


@query(
    "win_row_number_month_last",
    f"SELECT role_id, CAST(date_trunc('month', date) AS DATE) AS month, date, money FROM ({_USER_DAYS_SQL}) "
    "QUALIFY row_number() OVER (PARTITION BY role_id, date_trunc('month', date) ORDER BY date DESC) = 1",
)
def _(t: Logs):
    latest = Window.partitionBy("role_id", "month").orderBy(F.col("date").desc_nulls_last())
    ranked = _user_days(t).withColumn("month", month_of(F.col("date"))).withColumn("nth", F.row_number().over(latest))
    return ranked.where("nth = 1").select("role_id", "month", "date", "money")


_OBSERVED_SQL = f"""
    SELECT role_id, CAST(date_trunc('month', date) AS DATE) AS month, last(money ORDER BY date) AS balance
    FROM ({_USER_DAYS_SQL}) GROUP BY ALL
"""


@query(
    "win_row_number_locf",
    f"""
    SELECT role_id, cal_month, month, balance FROM (
      SELECT *, unnest(generate_series(month, DATE '2001-08-01', INTERVAL 1 MONTH))::DATE AS cal_month FROM ({_OBSERVED_SQL}))
    QUALIFY row_number() OVER (PARTITION BY role_id, cal_month ORDER BY month DESC) = 1
    """,
)
def _(t: Logs):
    observed = _user_days(t).groupBy("role_id", month_of(F.col("date")).alias("month")).agg(F.max_by("money", "date").alias("balance"))
    return carry_forward(observed, F.lit("2001-08-01").cast("date")).select("role_id", "cal_month", "month", "balance")


@query(
    "win_last_value_ignore_nulls",
    "SELECT DISTINCT part_date, role_id, item_id, last_value(item_remain IGNORE NULLS) OVER (PARTITION BY role_id, part_date, item_id "
    "ORDER BY event_time, item_remain ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS item_end FROM item_log",
)
def _(t: Logs):
    return t.item_log.groupBy("role_id", "part_date", "item_id").agg(
        latest_non_null("item_remain", "event_time", "item_remain").alias("item_end")
    )


@query(
    "win_last_value_default_frame",
    "SELECT role_id, item_id, date, last_value(held) OVER (PARTITION BY role_id, item_id ORDER BY date) AS item_end FROM "
    "(SELECT role_id, item_id, date, max(item_remain) AS held FROM item_log GROUP BY ALL)",
)
def _(t: Logs):
    held = t.item_log.groupBy("role_id", "item_id", "date").agg(F.max("item_remain").alias("held"))
    return held.select(
        "role_id", "item_id", "date",
        F.last("held").over(Window.partitionBy("role_id", "item_id").orderBy("date")).alias("item_end"),
    )


_MONTH_COUNT_SQL = "SELECT CAST(date_trunc('month', date) AS DATE) AS cal_month, count(*) AS n FROM order_payments GROUP BY ALL"


def _month_count(t: Logs):
    return t.order_payments.groupBy(month_of(F.col("date")).alias("cal_month")).agg(F.count(F.lit(1)).alias("n"))


@query("win_lag", f"SELECT cal_month, n, lag(n, 1) OVER (ORDER BY cal_month) AS n_before FROM ({_MONTH_COUNT_SQL})")
def _(t: Logs):
    return with_previous_month(_month_count(t), "cal_month", "n", "n_before").drop("has_previous")


@query("win_lag_default", f"SELECT cal_month, n, lag(n, 1, 0) OVER (ORDER BY cal_month) AS n_before FROM ({_MONTH_COUNT_SQL})")
def _(t: Logs):
    months = with_previous_month(_month_count(t), "cal_month", "n", "before")
    return months.select("cal_month", "n", F.when(F.col("has_previous"), F.col("before")).otherwise(F.lit(0)).alias("n_before"))


@query(
    "win_running_sum",
    f"SELECT role_id, date, money, CAST(sum(money) OVER (PARTITION BY role_id ORDER BY date ROWS UNBOUNDED PRECEDING) AS DECIMAL(32,4)) AS money_ac FROM ({_USER_DAYS_SQL})",
)
def _(t: Logs):
    return _user_days(t).withColumn("money_ac", running_total("money", ["role_id"], "date").cast("decimal(32,4)"))


# ---- ordering and sets


@query("sort_final", f"SELECT * FROM ({_MONTH_COUNT_SQL}) ORDER BY 1, 2")
def _(t: Logs):
    return _month_count(t).orderBy("cal_month", "n")


@query(
    "topk_per_group_1",
    "SELECT item_id, role_id, date, item_num FROM (SELECT item_id, role_id, date, CAST(sum(item_num) AS BIGINT) AS item_num "
    "FROM token_log GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY item_id, date ORDER BY item_num DESC, role_id) = 1",
)
def _(t: Logs):
    sums = t.token_log.groupBy("item_id", "role_id", "date").agg(F.sum("item_num").alias("item_num"))
    best = Window.partitionBy("item_id", "date").orderBy(F.col("item_num").desc_nulls_last(), "role_id")
    return sums.withColumn("nth", F.row_number().over(best)).where("nth = 1").drop("nth")


@query(
    "union_all",
    "SELECT role_id, artifact1_id AS artifact_id, artifact1_level AS level FROM artifact1_rows UNION ALL "
    "SELECT role_id, artifact2_id, artifact2_level FROM artifact2_rows",
)
def _(t: Logs):
    def slot(n: int):
        rows = t.herosnap_log.where(F.col(f"artifact{n}_id") != 0).groupBy(
            "part_date", "role_id", F.col(f"artifact{n}_id").cast("string").alias("artifact_id")
        )
        return rows.agg(F.max(f"artifact{n}_level").alias("level")).drop("part_date")

    return slot(1).unionByName(slot(2))


@query("select_distinct", "SELECT DISTINCT zone_id, channel, os FROM base_log")
def _(t: Logs):
    return t.base_log.select("zone_id", "channel", "os").distinct()
