"""Snapshots, user-level summaries and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from harness.logs import DAYS, GAME, LAST_DAY, LEDGER_AS_OF, MONTHS, Logs
from harness.registry import query
from rolemart.config import TRAILING_DAYS, RunWindow
from rolemart.functions.nested import json_text
from rolemart.operators.details import active_spine
from rolemart.operators.users import lifecycle_days, with_user_attrs
from rolemart.plans import actives, distribution, holdings, kpi, ledger, upstream
from rolemart.sources.tables import TABLES, conform

# ---- user-day snapshots; the detail arrays are shown as JSON text


def _as_text(snapshot: DataFrame, *details: str) -> DataFrame:
    return snapshot.select("date", "role_id", *[json_text(F.col(d)).alias(d) for d in details], "part_date")


def _snapshot_sql(name: str, rows: str, fields: list[str]) -> str:
    packed = ", ".join(f"'{f}': {f}" for f in fields)
    order = ", ".join(f"{f} NULLS FIRST" for f in fields)
    return f"""
    SELECT s.date, s.role_id, r.{name}, s.part_date FROM spine AS s
    LEFT JOIN (SELECT part_date, role_id, CAST(to_json(list({{{packed}}} ORDER BY {order})) AS VARCHAR) AS {name}
               FROM {rows} GROUP BY ALL) AS r USING (part_date, role_id)
    """


@query("dws_item_snapshot", _snapshot_sql("item_detail", "item_rows", ["item_id", "item_add", "item_cost", "item_end"]))
def _(t: Logs):
    return _as_text(conform(t.items, TABLES["dws_item_snapshot"]), "item_detail")


@query(
    "dws_summon_snapshot",
    _snapshot_sql(
        "summon_detail", "summon_rows",
        ["summon_id", "currency_id", "currency_num", "summon_free", "summon_valid", "summon_count", "summon_continue"],
    ),
)
def _(t: Logs):
    return _as_text(conform(t.draws, TABLES["dws_summon_snapshot"]), "summon_detail")


@query("dws_hero_snapshot", _snapshot_sql("hero_detail", "hero_rows", ["hero_id", "hero_level", "hero_star", "chip_cost"]))
def _(t: Logs):
    return _as_text(conform(t.heroes, TABLES["dws_hero_snapshot"]), "hero_detail")


@query("dws_flag_snapshot", _snapshot_sql("flag_detail", "flag_rows", ["flag_id", "flag_level", "flag_star", "flag_awake"]))
def _(t: Logs):
    return _as_text(conform(t.flags, TABLES["dws_flag_snapshot"]), "flag_detail")


@query(
    "dws_artifact_snapshot",
    "SELECT a.date, a.role_id, a.artifact1_detail, b.artifact2_detail, a.part_date FROM ("
    + _snapshot_sql("artifact1_detail", "artifact1_rows", ["artifact1_id", "artifact1_level"])
    + ") AS a JOIN ("
    + _snapshot_sql("artifact2_detail", "artifact2_rows", ["artifact2_id", "artifact2_level"])
    + ") AS b USING (date, role_id, part_date)",
)
def _(t: Logs):
    return _as_text(conform(t.artifacts, TABLES["dws_artifact_snapshot"]), "artifact1_detail", "artifact2_detail")


# ---- user-level summaries

_DAILY_COLUMNS = (
    "date", "part_date", "role_id", "level_min", "level_max", "viplevel_min", "viplevel_max", "online_time",
    "exchange_rate", "pay_count", "money", "money_rmb", "web_rmb", "is_test",
)
_INFO_COLUMNS = (
    "role_id", "install_date", "lastlogin_ts", "moneyrmb_ac", "firstpay_date", "firstpay_goodid", "firstpay_level",
    "zone_id", "channel", "os", "vip_level", "is_test",
)


@query("dws_user_daily", f"SELECT {', '.join(_DAILY_COLUMNS)} FROM daily")
def _(t: Logs):
    return conform(t.daily, TABLES["dws_user_daily"]).select(*_DAILY_COLUMNS)


@query("dws_user_daily_late", f"SELECT {', '.join(_DAILY_COLUMNS)} FROM daily_late")
def _(t: Logs):
    """The same model over logs with late events: still one row per user and partition day."""
    return conform(t.daily_late, TABLES["dws_user_daily"]).select(*_DAILY_COLUMNS)


@query("dws_user_daily_event_days_late", "SELECT * FROM event_days_late")
def _(t: Logs):
    """Every late event in its own day; the SQL side groups the raw logs by event date and knows no user-day."""
    return upstream.event_days(t.daily_late).select("role_id", "part_date", "date", *upstream.EVENT_DAY)


@query("dws_user_info_late", f"SELECT {', '.join(_INFO_COLUMNS)} FROM info_late")
def _(t: Logs):
    """Install dates are the first event dates, however late the events came."""
    return conform(t.info_late, TABLES["dws_user_info"])


@query("dws_user_info", f"SELECT {', '.join(_INFO_COLUMNS)} FROM all_info")
def _(t: Logs):
    return conform(t.all_info, TABLES["dws_user_info"])


@query("dws_user_daily_derive", "SELECT * FROM derive")
def _(t: Logs):
    return conform(t.derive, TABLES["dws_user_daily_derive"])


@query("dws_user_daily_derive_late", "SELECT * FROM derive_late")
def _(t: Logs):
    return conform(upstream.user_daily_derive(t.daily_late), TABLES["dws_user_daily_derive"])


@query("dws_user_hourly", "SELECT * FROM hourly")
def _(t: Logs):
    return conform(t.hourly, TABLES["dws_user_hourly"])


@query(
    "dws_core_snapshot",
    """
    SELECT r.date, r.part_date, r.role_id, r.coregain_detail, r.corecost_detail, c.core_end
    FROM (SELECT date, part_date, role_id,
                 '{' || coalesce(string_agg('"' || reason || '":' || gain, ',' ORDER BY reason), '') || '}' AS coregain_detail,
                 '{' || coalesce(string_agg('"' || reason || '":' || cost, ',' ORDER BY reason), '') || '}' AS corecost_detail
          FROM core_reason GROUP BY ALL) AS r
    LEFT JOIN core_close AS c USING (date, part_date, role_id)
    """,
)
def _(t: Logs):
    core = conform(t.core, TABLES["dws_core_snapshot"])
    return core.withColumns({c: F.to_json(c) for c in ("coregain_detail", "corecost_detail")})


@query("ads_active_daily", "SELECT part_date, count(DISTINCT role_id) AS dau FROM daily GROUP BY part_date")
def _(t: Logs):
    return conform(upstream.active_daily(t.daily), TABLES["ads_active_daily"])


for _model, _detail, _side in (("ads_core_addreason", "coregain_detail", "gain"), ("ads_core_costreason", "corecost_detail", "cost")):
    _value = "core_add" if _side == "gain" else "core_cost"

    def _report(t: Logs, model=_model, detail=_detail, value=_value):
        return conform(upstream.core_by_reason(t.core, t.info, detail, value), TABLES[model])

    query(
        _model,
        f"SELECT c.part_date, c.reason, CAST(sum(c.{_side}) AS BIGINT) AS {_value} FROM core_reason AS c LEFT JOIN info AS i USING (role_id) "
        f"WHERE i.is_test IS NULL AND c.{_side} IS NOT NULL GROUP BY ALL",
    )(_report)


_REAL_DAYS = "(SELECT DISTINCT d.role_id, CAST(d.part_date AS DATE) AS day FROM daily AS d LEFT JOIN info AS i USING (role_id) WHERE i.is_test IS NULL)"


@query(
    "ads_retention_daily",
    f"SELECT strftime(a.day, '%Y-%m-%d') AS part_date, CAST(b.day - a.day AS BIGINT) AS retention_day, count(*) AS dau "
    f"FROM {_REAL_DAYS} AS a JOIN {_REAL_DAYS} AS b ON a.role_id = b.role_id AND b.day >= a.day GROUP BY ALL",
)
def _(t: Logs):
    return conform(upstream.retention_daily(t.daily, t.info), TABLES["ads_retention_daily"])


# ---- distinct users of longer periods, from bitmaps of days


def _bitmaps(t: Logs) -> DataFrame:
    return actives.day_bitmaps(t.daily, actives.number_users(t.daily))


@query(
    "active_users_monthly",
    "SELECT CAST(date_trunc('month', CAST(part_date AS DATE)) AS DATE) AS month, count(DISTINCT role_id) AS active_users FROM daily GROUP BY ALL",
)
def _(t: Logs):
    return actives.monthly_users(_bitmaps(t))


@query(
    "active_users_trailing",
    "SELECT a.part_date, count(DISTINCT b.role_id) AS active_users FROM (SELECT DISTINCT part_date FROM daily) AS a JOIN daily AS b "
    "ON CAST(a.part_date AS DATE) - CAST(b.part_date AS DATE) BETWEEN 0 AND 6 GROUP BY ALL",
)
def _(t: Logs):
    return actives.trailing_users(_bitmaps(t), 7)


@query(
    "ads_user_retention",
    "SELECT i.install_date AS date, CAST(d.date - i.install_date AS BIGINT) AS retention_day, count(DISTINCT d.role_id) AS active_users "
    "FROM daily AS d LEFT JOIN info AS i USING (role_id) WHERE i.is_test IS NULL GROUP BY ALL",
)
def _(t: Logs):
    return conform(upstream.user_retention(t.daily, t.info), TABLES["ads_user_retention"])


@query(
    "ads_kpi_hourly_hi",
    """
    SELECT part_date, hour, count(*) FILTER (hour = first_hour) AS dau, CAST(sum(money) AS DECIMAL(32,4)) AS money_hourly,
           count(*) FILTER (hour = first_hour AND install_date = date) AS new_users
    FROM (SELECT h.*, i.install_date, min(h.hour) OVER (PARTITION BY h.part_date, h.role_id) AS first_hour
          FROM hourly AS h LEFT JOIN info AS i USING (role_id) WHERE i.is_test IS NULL)
    GROUP BY ALL
    """,
)
def _(t: Logs):
    return conform(upstream.kpi_hourly(t.hourly, t.info), TABLES["ads_kpi_hourly_hi"])


@query(
    "ads_kpi_hourly_hf",
    "SELECT h.part_date, h.hour, CAST(sum(h.money) AS DECIMAL(32,4)) AS money FROM hourly AS h LEFT JOIN info AS i USING (role_id) "
    "WHERE i.is_test IS NULL GROUP BY ALL",
)
def _(t: Logs):
    return conform(upstream.kpi_hourly_full(t.hourly, t.info), TABLES["ads_kpi_hourly_hf"])


# ---- KPI reports


def _kpi_sql(info: str) -> str:
    """Facts per day and dimension, then the gapless grid beside them."""
    return f"""
    WITH facts AS (
      SELECT u.date, i.zone_id, i.channel, i.os,
             count(DISTINCT u.role_id) FILTER (u.date = i.install_date) AS new_users,
             count(DISTINCT u.role_id) AS active_users,
             count(DISTINCT u.role_id) FILTER (u.money_rmb > 0) AS pay_users,
             count(DISTINCT u.role_id) FILTER (v.moneyrmb_ac > 0) AS paid_users,
             count(DISTINCT u.role_id) FILTER (u.money_rmb > 0 AND u.date = i.install_date AND u.date = i.firstpay_date) AS install_pay,
             count(DISTINCT u.role_id) FILTER (u.money_rmb > 0 AND u.date = i.firstpay_date) AS newpay_users,
             sum(u.online_time) AS online_time, sum(u.pay_count) AS pay_count, sum(u.money_rmb) AS money_rmb,
             sum(u.money_rmb) FILTER (u.money_rmb > 0 AND u.date = i.install_date AND u.date = i.firstpay_date) AS install_moneyrmb,
             sum(u.money_rmb) FILTER (u.money_rmb > 0 AND u.date = i.firstpay_date) AS newpay_moneyrmb,
             sum(u.web_rmb) AS web_rmb, count(DISTINCT u.role_id) FILTER (u.web_rmb > 0) AS webpay_users,
             sum(v.moneyrmb_ac) AS moneyrmb_ac
      FROM daily AS u LEFT JOIN derive AS v USING (role_id, part_date) LEFT JOIN {info} AS i USING (role_id)
      WHERE i.is_test IS NULL AND u.part_date BETWEEN '2024-01-01' AND '2024-01-31' GROUP BY 1, 2, 3, 4),
    grid AS (
      SELECT zone_id, channel, os, CAST(d AS DATE) AS date
      FROM (SELECT DISTINCT zone_id, channel, os FROM facts),
           generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY) AS s(d))
    SELECT g.date, g.zone_id, g.channel, g.os, f.new_users, f.active_users, f.pay_users, f.paid_users, f.install_pay,
           f.newpay_users, CAST(f.online_time AS BIGINT) AS online_time, CAST(f.pay_count AS BIGINT) AS pay_count,
           CAST(f.money_rmb AS DECIMAL(36,2)) AS money_rmb, CAST(f.install_moneyrmb AS DECIMAL(36,2)) AS install_moneyrmb,
           CAST(f.newpay_moneyrmb AS DECIMAL(36,2)) AS newpay_moneyrmb, CAST(f.web_rmb AS DECIMAL(36,2)) AS web_rmb,
           f.webpay_users, CAST(f.moneyrmb_ac AS DECIMAL(36,2)) AS moneyrmb_ac,
           CAST(sum(f.new_users) OVER (PARTITION BY g.zone_id, g.channel, g.os ORDER BY g.date) AS BIGINT) AS newuser_ac,
           strftime(g.date, '%Y-%m-%d') AS part_date
    FROM grid AS g LEFT JOIN facts AS f ON f.date = g.date AND f.zone_id = g.zone_id AND f.channel = g.channel AND f.os = g.os
    """


@query(
    "ads_kpi_daily_late",
    f"""
    SELECT * FROM (WITH daily AS (
      SELECT role_id, date, strftime(date, '%Y-%m-%d') AS part_date, sum(online_time) AS online_time, sum(pay_count) AS pay_count,
             sum(money_rmb) AS money_rmb, sum(web_rmb) AS web_rmb FROM event_days_late GROUP BY role_id, date),
    derive AS (
      SELECT e.role_id, strftime(e.date, '%Y-%m-%d') AS part_date, max(v.moneyrmb_ac) AS moneyrmb_ac
      FROM event_days_late AS e JOIN derive_late AS v USING (role_id, part_date) GROUP BY e.role_id, e.date)
    SELECT * FROM ({_kpi_sql("info_late")}))
    """,
)
def _(t: Logs):
    """Daily KPIs by event date; the SQL side counts the raw logs by event date."""
    derive = upstream.user_daily_derive(t.daily_late)
    return conform(kpi.kpi_daily(t.daily_late, derive, t.info_late, DAYS, by_event_day=True), TABLES["ads_kpi_daily"])


@query("ads_kpi_daily", _kpi_sql("info"))
def _(t: Logs):
    return conform(kpi.kpi_daily(t.daily, t.derive, t.info, DAYS), TABLES["ads_kpi_daily"])


@query(
    "ads_kpi_daily_carry",
    "SELECT * REPLACE (coalesce(newuser_ac, 0) AS newuser_ac) FROM (" + _kpi_sql("info") + ") WHERE part_date >= '2024-01-11'"
    " AND zone_id IS NOT NULL AND channel IS NOT NULL AND os IS NOT NULL AND (zone_id, channel, os) IN (SELECT (i.zone_id, i.channel, i.os) FROM daily AS u JOIN info AS i USING (role_id)"
    " WHERE i.is_test IS NULL AND u.part_date >= '2024-01-11') UNION ALL "
    "SELECT CAST(d AS DATE), x.zone_id, x.channel, x.os, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 0,"
    " strftime(d, '%Y-%m-%d') FROM (SELECT DISTINCT i.zone_id, i.channel, i.os FROM daily AS u LEFT JOIN info AS i USING (role_id)"
    " WHERE i.is_test IS NULL AND u.part_date >= '2024-01-11' AND (i.zone_id IS NULL OR i.channel IS NULL OR i.os IS NULL)) AS x,"
    " generate_series(DATE '2024-01-11', DATE '2024-01-31', INTERVAL 1 DAY) AS s(d)",
)
def _(t: Logs):
    """A run over later days that continues the running number of an earlier, stored run."""
    earlier = kpi.kpi_daily(t.daily, t.derive, t.info, RunWindow("2024-01-01", "2024-01-10"))
    later = kpi.kpi_daily(t.daily, t.derive, t.info, RunWindow("2024-01-11", "2024-01-31"), history=earlier)
    return conform(later, TABLES["ads_kpi_daily"])


@query(
    "ads_kpi_daily_hf",
    """
    WITH facts AS (
      SELECT h.date, i.zone_id, i.channel, i.os, count(DISTINCT h.role_id) AS active_users,
             count(DISTINCT h.role_id) FILTER (h.date = i.install_date) AS new_users,
             count(DISTINCT h.role_id) FILTER (h.date - i.install_date = 1) AS retention1_users,
             sum(v.is_paid) AS paid_users, count(DISTINCT h.role_id) FILTER (h.money_rmb > 0) AS pay_users,
             count(DISTINCT h.role_id) FILTER (h.money_rmb > 0 AND i.firstpay_date = h.date) AS firstpay_users,
             count(DISTINCT h.role_id) FILTER (i.firstpay_date = h.date AND h.date = i.install_date) AS firstdaypay_users,
             sum(h.money_rmb) AS money_rmb, sum(h.money_rmb) FILTER (i.firstpay_date = h.date) AS firstpay_rmb,
             sum(h.money_rmb) FILTER (i.firstpay_date = h.date AND h.date = i.install_date) AS firstdaypay_rmb
      FROM (SELECT date, part_date, role_id, sum(money_rmb) AS money_rmb FROM hourly
            WHERE part_date BETWEEN '2024-01-15' AND '2024-01-30' GROUP BY ALL) AS h
      LEFT JOIN derive AS v USING (date, role_id) LEFT JOIN info AS i USING (role_id)
      WHERE i.is_test IS NULL GROUP BY 1, 2, 3, 4),
    grid AS (SELECT * FROM (SELECT DISTINCT zone_id, channel, os FROM facts), (SELECT DISTINCT date FROM facts))
    SELECT g.date, g.zone_id, g.channel, g.os, f.active_users, f.new_users, p.new_users AS retention1_newusers,
           f.retention1_users, CAST(f.paid_users AS BIGINT) AS paid_users, f.pay_users, f.firstpay_users, f.firstdaypay_users,
           CAST(f.money_rmb AS DECIMAL(36,2)) AS money_rmb, CAST(f.firstpay_rmb AS DECIMAL(36,2)) AS firstpay_rmb,
           CAST(f.firstdaypay_rmb AS DECIMAL(36,2)) AS firstdaypay_rmb, strftime(g.date, '%Y-%m-%d') AS part_date
    FROM grid AS g
    LEFT JOIN facts AS f ON f.date = g.date AND f.zone_id = g.zone_id AND f.channel = g.channel AND f.os = g.os
    LEFT JOIN facts AS p ON p.date = g.date - 1 AND p.zone_id = g.zone_id AND p.channel = g.channel AND p.os = g.os
    """,
)
def _(t: Logs):
    window = RunWindow.trailing(LAST_DAY, TRAILING_DAYS)
    return conform(kpi.kpi_daily_intraday(t.hourly, t.derive, t.info, window), TABLES["ads_kpi_daily_hf"])


@query(
    "ads_kpi_monthly",
    """
    WITH user_month AS (
      SELECT CAST(date_trunc('month', date) AS DATE) AS month, role_id, sum(pay_count) AS pay_count, sum(money) AS money,
             sum(money_rmb) AS money_rmb FROM order_daily GROUP BY ALL),
    facts AS (
      SELECT m.month, i.zone_id, i.channel, i.os, count(DISTINCT m.role_id) AS active_users,
             count(DISTINCT m.role_id) FILTER (date_trunc('month', i.install_date) = m.month) AS new_users,
             count(DISTINCT m.role_id) FILTER (m.money > 0) AS pay_users,
             count(DISTINCT m.role_id) FILTER (m.money > 0 AND date_trunc('month', i.install_date) = m.month
                                               AND date_trunc('month', i.firstpay_date) = m.month) AS new_users_pay,
             count(DISTINCT m.role_id) FILTER (m.money > 0 AND date_trunc('month', i.firstpay_date) = m.month) AS users_new_pay,
             sum(m.pay_count) AS pay_count, sum(m.money_rmb) AS money_rmb,
             sum(m.money_rmb) FILTER (m.money > 0 AND date_trunc('month', i.install_date) = m.month
                                      AND date_trunc('month', i.firstpay_date) = m.month) AS new_users_moneyrmb,
             sum(m.money_rmb) FILTER (m.money > 0 AND date_trunc('month', i.firstpay_date) = m.month) AS users_new_moneyrmb
      FROM user_month AS m LEFT JOIN order_info AS i USING (role_id) WHERE i.is_test IS NULL GROUP BY 1, 2, 3, 4),
    grid AS (SELECT * FROM (SELECT DISTINCT month FROM facts), (SELECT DISTINCT zone_id FROM facts),
                           (SELECT DISTINCT channel FROM facts), (SELECT DISTINCT os FROM facts))
    SELECT g.month, g.zone_id, g.channel, g.os, f.new_users, f.active_users, f.pay_users, f.new_users_pay, f.users_new_pay,
           CAST(f.pay_count AS BIGINT) AS pay_count, CAST(f.money_rmb AS DECIMAL(36,2)) AS money_rmb,
           CAST(f.new_users_moneyrmb AS DECIMAL(36,2)) AS new_users_moneyrmb,
           CAST(f.users_new_moneyrmb AS DECIMAL(36,2)) AS users_new_moneyrmb,
           CAST(sum(f.new_users) OVER w AS BIGINT) AS new_users_ac, CAST(sum(f.money_rmb) OVER w AS DECIMAL(36,2)) AS moneyrmb_ac,
           strftime(g.month, '%Y-%m-%d') AS part_month
    FROM grid AS g LEFT JOIN facts AS f ON f.month = g.month AND f.zone_id = g.zone_id AND f.channel = g.channel AND f.os = g.os
    WINDOW w AS (PARTITION BY g.zone_id, g.channel, g.os ORDER BY g.month)
    """,
)
def _(t: Logs):
    return conform(kpi.kpi_monthly(t.order_daily, t.order_info, MONTHS), TABLES["ads_kpi_monthly"])


# ---- distributions


@query(
    "ads_level_daily",
    """
    SELECT u.date, i.zone_id, i.channel, u.level_max AS level_max_daily, u.level_max // 5 * 5 AS level_hs,
           '[' || (u.level_max // 5 * 5) || ',' || (u.level_max // 5 * 5 + 5) || ')' AS level_hist,
           count(DISTINCT u.role_id) AS users, count(DISTINCT u.role_id) FILTER (u.money > 0) AS pay_users,
           count(DISTINCT u.role_id) FILTER (i.moneyrmb_ac > 0) AS paid_users, CAST(sum(u.pay_count) AS BIGINT) AS pay_count_daily,
           CAST(sum(u.money_rmb) AS DECIMAL(36,2)) AS money_rmb_daily, u.part_date
    FROM daily AS u LEFT JOIN info AS i USING (role_id) WHERE i.is_test IS NULL GROUP BY ALL
    """,
)
def _(t: Logs):
    return conform(distribution.level_daily(t.daily, t.info, DAYS), TABLES["ads_level_daily"])


@query(
    "ads_viplevel_daily",
    """
    SELECT u.date, i.zone_id, i.channel, i.os, u.viplevel_max AS viplevel_max_daily, count(DISTINCT u.role_id) AS users,
           count(DISTINCT u.role_id) FILTER (u.money > 0) AS pay_users, CAST(sum(u.pay_count) AS BIGINT) AS pay_count_daily,
           CAST(sum(u.money_rmb) AS DECIMAL(36,2)) AS money_rmb_daily, u.part_date
    FROM daily AS u LEFT JOIN info AS i USING (role_id) WHERE i.is_test IS NULL GROUP BY ALL
    """,
)
def _(t: Logs):
    return conform(distribution.viplevel_daily(t.daily, t.info, DAYS), TABLES["ads_viplevel_daily"])


@query(
    "ads_core_daily",
    """
    SELECT u.date, i.zone_id, i.channel, CAST(sum(u.gained) AS BIGINT) AS core_add, CAST(sum(u.spent) AS BIGINT) AS core_cost,
           CAST(sum(c.core_end) AS BIGINT) AS core_end, count(DISTINCT u.role_id) AS users,
           count(DISTINCT u.role_id) FILTER (u.gained > 0) AS users_add, count(DISTINCT u.role_id) FILTER (u.spent > 0) AS users_cost,
           u.part_date
    FROM (SELECT date, part_date, role_id, coalesce(sum(gain), 0) AS gained, coalesce(sum(cost), 0) AS spent FROM core_reason GROUP BY ALL) AS u
    LEFT JOIN core_close AS c USING (date, part_date, role_id) LEFT JOIN info AS i USING (role_id)
    WHERE i.is_test IS NULL GROUP BY ALL
    """,
)
def _(t: Logs):
    return conform(distribution.core_daily(t.core, t.info, DAYS), TABLES["ads_core_daily"])


@query(
    "ads_item_daily",
    """
    SELECT s.date, i.zone_id, i.channel, i.vip_level, r.item_id, CAST(sum(r.item_add) AS BIGINT) AS item_add,
           CAST(sum(r.item_cost) AS BIGINT) AS item_cost, count(DISTINCT s.role_id) AS users, s.part_date
    FROM spine AS s JOIN item_rows AS r USING (part_date, role_id) LEFT JOIN info AS i USING (role_id)
    WHERE i.is_test IS NULL AND s.part_date BETWEEN '2024-01-01' AND '2024-01-31' GROUP BY ALL
    """,
)
def _(t: Logs):
    return conform(distribution.item_daily(t.items, t.info, DAYS), TABLES["ads_item"])


@query(
    "ads_summon_daily",
    """
    SELECT s.date, a.dau, r.summon_id, r.currency_id, count(DISTINCT s.role_id) AS users,
           CAST(sum(r.currency_num) AS BIGINT) AS currency_num, CAST(sum(r.summon_free) AS BIGINT) AS summon_free,
           CAST(sum(r.summon_valid) AS BIGINT) AS summon_valid, CAST(sum(r.summon_continue) AS BIGINT) AS summon_continue,
           CAST(sum(r.summon_count) AS BIGINT) AS summon_count, s.part_date
    FROM spine AS s JOIN summon_rows AS r USING (part_date, role_id) LEFT JOIN info AS i USING (role_id)
    LEFT JOIN (SELECT s2.date, count(DISTINCT s2.role_id) AS dau FROM spine AS s2 LEFT JOIN info AS i2 USING (role_id)
               WHERE i2.is_test IS NULL AND s2.part_date BETWEEN '2024-01-01' AND '2024-01-31' GROUP BY s2.date) AS a USING (date)
    WHERE i.is_test IS NULL AND s.part_date BETWEEN '2024-01-01' AND '2024-01-31' GROUP BY ALL
    """,
)
def _(t: Logs):
    return conform(distribution.summon_daily(t.draws, t.info, DAYS), TABLES["ads_summon"])


# ---- holdings

_ACTIVE = "(SELECT DISTINCT part_date, role_id FROM spine)"


@query(
    "ads_hero",
    f"SELECT role_id, max(hero_level) AS hero_level, CAST(NULL AS BIGINT) AS hero_power, max(hero_star) AS hero_star, hero_id "
    f"FROM hero_rows JOIN {_ACTIVE} AS a USING (part_date, role_id) GROUP BY role_id, hero_id",
)
def _(t: Logs):
    return conform(holdings.hero_best(t.heroes), TABLES["ads_hero"])


@query(
    "ads_flag",
    f"SELECT role_id, max(flag_level) AS flag_level, max(flag_star) AS flag_star, max(flag_awake) AS flag_awake, flag_id "
    f"FROM flag_rows JOIN {_ACTIVE} AS a USING (part_date, role_id) GROUP BY role_id, flag_id",
)
def _(t: Logs):
    return conform(holdings.flag_best(t.flags), TABLES["ads_flag"])


@query(
    "ads_artifact",
    f"""
    SELECT role_id, max(level) AS artifact_level, artifact_id FROM (
      SELECT role_id, artifact1_id AS artifact_id, artifact1_level AS level FROM artifact1_rows JOIN {_ACTIVE} AS a USING (part_date, role_id)
      UNION ALL
      SELECT role_id, artifact2_id, artifact2_level FROM artifact2_rows JOIN {_ACTIVE} AS a USING (part_date, role_id)
      UNION ALL
      SELECT role_id, NULL, NULL FROM {_ACTIVE} AS a
      LEFT JOIN (SELECT part_date, role_id, count(*) AS n FROM artifact1_rows GROUP BY ALL) AS x USING (part_date, role_id)
      LEFT JOIN (SELECT part_date, role_id, count(*) AS n FROM artifact2_rows GROUP BY ALL) AS y USING (part_date, role_id)
      WHERE coalesce(x.n, 0) <> coalesce(y.n, 0))
    GROUP BY role_id, artifact_id
    """,
)
def _(t: Logs):
    return conform(holdings.artifact_best(t.artifacts), TABLES["ads_artifact"])


_TRACKED = "SELECT s.role_id, s.date, s.part_date, r.item_id, r.item_end FROM spine AS s JOIN item_rows AS r USING (part_date, role_id) WHERE r.item_id BETWEEN '13000' AND '14000'"


@query(
    "ads_item_end",
    f"SELECT role_id, last_value(item_end) OVER (PARTITION BY role_id, item_id, date ORDER BY part_date "
    f"ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS item_end, item_id FROM ({_TRACKED})",
)
def _(t: Logs):
    return conform(holdings.item_end(t.items, GAME), TABLES["ads_item_end"])


@query(
    "ads_item_end_latest",
    f"SELECT role_id, item_end, item_id FROM ({_TRACKED}) QUALIFY row_number() OVER (PARTITION BY role_id, item_id ORDER BY date DESC, part_date DESC) = 1",
)
def _(t: Logs):
    return conform(holdings.item_end(t.items, GAME, latest_only=True), TABLES["ads_item_end"])


@query(
    "ads_hero_upgrade",
    """
    SELECT u.hero_id, u.zone_id, f.start_date, a.active_users, u.hero_star, h.hold_users, u.upgrade_users, u.upgrade_count, u.chip_cost
    FROM (SELECT CAST(hero AS VARCHAR) AS hero_id, zone_id, CAST(fromrare % 10 AS BIGINT) AS hero_star,
                 count(DISTINCT role_id) AS upgrade_users, count(*) AS upgrade_count, CAST(sum(costchip) AS BIGINT) AS chip_cost
          FROM upgraderare_log WHERE part_date BETWEEN '2024-01-15' AND '2024-01-30' GROUP BY ALL) AS u
    LEFT JOIN (SELECT hero_id, zone_id, hero_star, count(DISTINCT role_id) AS hold_users
               FROM (SELECT role_id, CAST(hero_id AS VARCHAR) AS hero_id, zone_id, max(herostar) AS hero_star FROM herosnap_log
                     WHERE part_date BETWEEN '2024-01-15' AND '2024-01-30' GROUP BY ALL) GROUP BY ALL) AS h
           USING (hero_id, zone_id, hero_star)
    LEFT JOIN (SELECT CAST(hero_id AS VARCHAR) AS hero_id, zone_id, min(date) AS start_date FROM herosnap_log GROUP BY ALL) AS f
           USING (hero_id, zone_id)
    LEFT JOIN (SELECT i.zone_id, count(DISTINCT d.role_id) AS active_users FROM daily AS d LEFT JOIN info AS i USING (role_id)
               WHERE d.part_date BETWEEN '2024-01-15' AND '2024-01-30' GROUP BY i.zone_id) AS a USING (zone_id)
    """,
)
def _(t: Logs):
    report = holdings.hero_upgrade(t.upgraderare_log, t.herosnap_log, t.daily, t.info, LAST_DAY)
    return conform(report, TABLES["ads_hero_upgrade"])


# ---- token ledger


@query(
    "dws_token_monthly",
    """
    WITH sold AS (
      SELECT p.role_id, p.date,
             CAST(p.money * CAST(r.rate AS DECIMAL(9,4)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(32,4)) AS money_rmb, n.tokens
      FROM order_payments AS p LEFT JOIN rates AS r ON r.currency = 'JPY' AND r.currency_time = strftime(p.date, '%Y-%m')
      LEFT JOIN prices AS c USING (payment_itemid),
           LATERAL (SELECT CASE WHEN contains(p.payment_itemid, ';') THEN CAST(string_split(p.payment_itemid, ';')[2] AS BIGINT) END AS tokens
                    WHERE p.pay_source = 'web' UNION ALL SELECT c.token_num WHERE c.token_num IS NOT NULL) AS n
      WHERE p.part_date BETWEEN '1995-01-01' AND '2001-08-31'),
    pay_day AS (SELECT role_id, date, sum(money_rmb) AS money_rmb, sum(tokens) AS token_get_by_pay FROM sold GROUP BY ALL),
    kept AS (SELECT * FROM token_log WHERE item_id = '2' AND reason <> '638' AND part_date BETWEEN '1995-01-01' AND '2001-08-31'),
    token_day AS (
      SELECT role_id, date, sum(item_num) FILTER (event_type = 'gain') AS token_get, sum(item_num) FILTER (event_type = 'cost') AS token_cost
      FROM kept GROUP BY ALL),
    day_end AS (
      SELECT role_id, date, item_end FROM kept
      QUALIFY row_number() OVER (PARTITION BY role_id, part_date ORDER BY event_time DESC, item_end NULLS LAST) = 1),
    day AS (
      SELECT p.role_id, p.date, p.money_rmb, p.token_get_by_pay, k.token_get, k.token_cost, e.item_end AS token_remain,
             CAST(date_trunc('month', p.date) AS DATE) AS month
      FROM pay_day AS p LEFT JOIN token_day AS k USING (role_id, date) LEFT JOIN day_end AS e USING (role_id, date)),
    flow AS (SELECT role_id, month, sum(money_rmb) AS money_rmb, sum(token_get_by_pay) AS token_get_by_pay, sum(token_get) AS token_get,
                    sum(token_cost) AS token_cost FROM day GROUP BY ALL),
    balance AS (SELECT role_id, month, token_remain FROM day QUALIFY row_number() OVER (PARTITION BY role_id, month ORDER BY date DESC) = 1),
    calendar AS (SELECT CAST(unnest(generate_series((SELECT min(month) FROM balance), DATE '2001-08-01', INTERVAL 1 MONTH)) AS DATE) AS cal_month),
    carried AS (
      SELECT b.role_id, c.cal_month, b.token_remain
      FROM (SELECT *, lead(month) OVER (PARTITION BY role_id ORDER BY month) AS next_month FROM balance) AS b
      JOIN calendar AS c ON c.cal_month >= b.month AND (b.next_month IS NULL OR c.cal_month < b.next_month)),
    totals AS (
      SELECT c.cal_month, sum(f.money_rmb) AS money_rmb, count(*) AS users, count(*) FILTER (f.money_rmb > 0) AS pay_users,
             count(*) FILTER (f.token_get > 0 OR f.token_cost > 0) AS token_users, sum(f.token_get_by_pay) AS token_get_by_pay,
             sum(f.token_get) AS token_get, sum(f.token_cost) AS token_cost, sum(c.token_remain) AS token_remain
      FROM carried AS c LEFT JOIN flow AS f ON f.role_id = c.role_id AND f.month = c.cal_month GROUP BY c.cal_month),
    ledger AS (SELECT *, lag(token_remain) OVER (ORDER BY cal_month) AS before, lag(token_remain, 1, 0) OVER (ORDER BY cal_month) AS opening FROM totals)
    SELECT cal_month, CAST(money_rmb AS DECIMAL(32,4)) AS money_rmb, users, pay_users, token_users,
           CAST(token_get_by_pay AS BIGINT) AS token_get_by_pay, CAST(token_get AS BIGINT) AS token_get,
           CAST(token_cost AS BIGINT) AS token_cost, CAST(token_remain AS BIGINT) AS token_remain,
           CAST(before AS BIGINT) AS token_remain_lastmonth,
           CAST(round(money_rmb / nullif(token_get + opening, 0), 4) AS DECIMAL(32,4)) AS price,
           CAST(token_get + coalesce(before, 0) - token_cost - token_remain AS BIGINT) AS diff
    FROM ledger ORDER BY cal_month
    """,
)
def _(t: Logs):
    report = ledger.token_monthly(t.order_payments, t.token_log, t.home_rates, GAME, LEDGER_AS_OF)
    return conform(report, TABLES["dws_token_monthly"]).orderBy("cal_month")


# ---- building blocks shared by the models


@query("active_spine", "SELECT part_date, date, role_id FROM base_log_late GROUP BY ALL")
def _(t: Logs):
    return active_spine(t.base_log_late)


@query(
    "lifecycle_days",
    "SELECT d.role_id, d.date, CAST(d.date - i.install_date AS INTEGER) AS retention_day, CAST(d.date - i.firstpay_date AS INTEGER) AS pay_retention_day, "
    "CAST(i.firstpay_date - i.install_date AS INTEGER) AS firstpay_interval_days FROM daily AS d LEFT JOIN info AS i USING (role_id) WHERE i.is_test IS NULL",
)
def _(t: Logs):
    rows = with_user_attrs(t.daily.select("role_id", "date"), t.info, ["install_date", "firstpay_date"])
    return rows.withColumns(lifecycle_days()).drop("install_date", "firstpay_date")
