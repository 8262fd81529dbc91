"""The same logs and summaries as SQL for the comparison engine, written independently of the library."""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {}


def view(name: str, body: str) -> None:
    VIEWS[name] = body.strip()


def complete(sql: str) -> str:
    """Put the views a statement uses in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for word in re.findall(r"[a-z_0-9]+", text):
            if word in VIEWS and word not in needed:
                visit(VIEWS[word])
                if word not in needed:
                    needed.append(word)

    visit(sql)
    if not needed:
        return sql.strip()
    views = ",\n".join(f"{n} AS (\n{VIEWS[n]}\n)" for n in needed)
    body = sql.strip()
    if body.startswith("WITH "):
        return f"WITH {views},\n{body[5:]}"
    return f"WITH {views}\n{body}"


view("ev", """
SELECT event_id, CAST(user_id AS VARCHAR) AS role_id, ts AS event_time, CAST(ts AS DATE) AS date,
       strftime(ts, '%Y-%m-%d') AS part_date, event_type AS event_name,
       CAST(user_id % 25 AS VARCHAR) AS zone_id,
       CASE WHEN user_id % 6 <> 0 THEN 'ch' || CAST(user_id % 6 AS VARCHAR) END AS channel,
       CASE WHEN user_id % 2 = 0 THEN 'ios' ELSE 'android' END AS os,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, value,
       CAST(floor(value) AS BIGINT) AS whole
FROM events
""")
view("ev_late", """
SELECT * REPLACE (CASE WHEN k = 97 THEN strftime(date + INTERVAL 1 DAY, '%Y-%m-%d') ELSE part_date END AS part_date)
FROM ev
""")
for _name, _from in (("base_log", "ev"), ("base_log_late", "ev_late")):
    view(_name, f"""
SELECT role_id, event_time, date, part_date, event_name, zone_id, channel, os,
       CAST(k + 1 AS BIGINT) AS level, CAST(k // 10 AS BIGINT) AS vip_level, whole AS online_time
FROM {_from}
""")
for _name, _from in (("payment_log", "ev"), ("payment_log_late", "ev_late")):
    view(_name, f"""
SELECT role_id, event_time, date, part_date, event_name, 'gold_10000' || CAST(1 + k % 6 AS VARCHAR) AS payment_itemid,
       CASE WHEN k % 3 = 0 THEN 'web' ELSE 'app' END AS pay_source,
       CAST(value AS DECIMAL(32,4)) AS money,
       CAST(CAST(value AS DECIMAL(32,4)) * 0.05 AS DECIMAL(32,4)) AS money_rmb,
       CASE WHEN k % 3 = 0 THEN CAST(CAST(value AS DECIMAL(32,4)) * 0.05 AS DECIMAL(32,4)) END AS web_rmb,
       CAST(0.05 AS DECIMAL(12,6)) AS exchange_rate, CAST(k + 1 AS BIGINT) AS level
FROM {_from} WHERE event_name = 'purchase'
""")
view("item_log", """
SELECT role_id, event_time, date, part_date,
       CASE event_name WHEN 'click' THEN 'AddItem' ELSE 'CostItem' END AS event_name,
       CASE WHEN k = 1 THEN '135' ELSE CAST(12990 + 15 * k AS VARCHAR) END AS item_id,
       CASE WHEN event_name = 'click' THEN whole END AS item_add,
       CASE WHEN event_name = 'view' THEN whole END AS item_cost,
       CASE WHEN k % 7 <> 0 THEN whole END AS item_remain
FROM ev_late WHERE event_name IN ('click', 'view')
""")
view("core_log", """
SELECT role_id, event_time, date, part_date,
       CASE event_name WHEN 'click' THEN 'gain' ELSE 'cost' END AS event_type,
       CASE WHEN k = 63 THEN '638' ELSE CAST(k % 10 AS VARCHAR) END AS reason,
       whole AS free_num, CASE WHEN k % 3 <> 0 THEN CAST(k AS BIGINT) END AS paid_num,
       CASE WHEN k % 7 <> 0 THEN CAST(k * 10 AS BIGINT) END AS core_end
FROM ev WHERE event_name IN ('click', 'view')
""")
view("summon_log", """
SELECT role_id, event_time, date, part_date, k % 5 AS recruitid,
       CASE WHEN k % 2 = 0 THEN 10 ELSE 1 END AS count, CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END AS is_free,
       k % 4 AS currency_id, whole AS currency_num
FROM ev_late WHERE event_name = 'purchase'
""")
view("herosnap_log", """
SELECT role_id, event_time, date, part_date, zone_id, CAST(k % 20 AS BIGINT) AS hero_id, CAST(k % 6 AS BIGINT) AS herostar,
       CAST(k % 8 AS BIGINT) AS flag_id, CAST(k AS BIGINT) AS flag_level, CAST(k % 5 AS BIGINT) AS flag_star,
       CAST(k % 3 AS BIGINT) AS flag_awake, CAST(k % 4 AS BIGINT) AS artifact1_id, CAST(k AS BIGINT) AS artifact1_level,
       CAST(k % 3 AS BIGINT) AS artifact2_id, CAST(k + 1 AS BIGINT) AS artifact2_level
FROM ev_late
""")
view("upgraderare_log", """
SELECT role_id, event_time, date, part_date, zone_id, k % 20 AS hero, 100 + k % 9 AS fromrare, 101 + k % 9 AS torare,
       whole AS costchip
FROM ev_late WHERE event_name = 'error'
""")
view("upgradehero_log", """
SELECT role_id, event_time, date, part_date, zone_id, k % 20 AS hero, CAST(k AS BIGINT) AS fromlv,
       CAST(k + 1 AS BIGINT) AS tolv
FROM ev_late WHERE event_name = 'signup'
""")
view("test_accounts", "SELECT CAST(c_custkey AS VARCHAR) AS role_id FROM customer WHERE c_acctbal >= 9000")
view("closed_accounts", "SELECT CAST(c_custkey AS VARCHAR) AS role_id FROM customer WHERE c_acctbal < -500")


def _daily(base: str, payments: str) -> str:
    """User-days: activity and payments aggregated apart and brought together on the user-day."""
    return f"""
SELECT greatest(a.date, p.date) AS date, a.part_date, a.role_id, a.level_min, a.level_max, a.viplevel_min, a.viplevel_max, a.online_time,
       p.exchange_rate, coalesce(p.pay_count, 0) AS pay_count,
       CAST(coalesce(p.money, 0) AS DECIMAL(32,4)) AS money,
       CAST(coalesce(p.money_rmb, 0) AS DECIMAL(32,4)) AS money_rmb,
       CAST(coalesce(p.web_rmb, 0) AS DECIMAL(32,4)) AS web_rmb,
       CASE WHEN t.role_id IS NOT NULL THEN 1 END AS is_test, a.login_ts
FROM (SELECT max(date) AS date, part_date, role_id, min(level) AS level_min, max(level) AS level_max, min(vip_level) AS viplevel_min,
             max(vip_level) AS viplevel_max, CAST(sum(online_time) AS BIGINT) AS online_time,
             max(event_time) AS login_ts
      FROM {base} GROUP BY part_date, role_id) AS a
LEFT JOIN (SELECT max(date) AS date, part_date, role_id, min(exchange_rate) AS exchange_rate, count(money) AS pay_count,
                  sum(money) AS money, sum(money_rmb) AS money_rmb, sum(web_rmb) AS web_rmb
           FROM {payments} GROUP BY part_date, role_id) AS p USING (part_date, role_id)
LEFT JOIN test_accounts AS t USING (role_id)
"""


def _info(daily: str, base: str, payments: str) -> str:
    return f"""
SELECT d.role_id, d.install_date, d.lastlogin_ts, CAST(d.moneyrmb_ac AS DECIMAL(32,4)) AS moneyrmb_ac,
       CAST(f.event_time AS DATE) AS firstpay_date, f.payment_itemid AS firstpay_goodid, f.level AS firstpay_level,
       z.zone_id, z.channel, z.os, d.vip_level, d.is_test
FROM (SELECT role_id, min(date) AS install_date, max(login_ts) AS lastlogin_ts, sum(money_rmb) AS moneyrmb_ac,
             max(viplevel_max) AS vip_level, max(is_test) AS is_test FROM {daily} GROUP BY role_id) AS d
LEFT JOIN (SELECT * FROM {payments}
           QUALIFY row_number() OVER (PARTITION BY role_id ORDER BY event_time, payment_itemid, level) = 1) AS f
       USING (role_id)
LEFT JOIN (SELECT role_id, zone_id, channel, os FROM {base}
           QUALIFY row_number() OVER (PARTITION BY role_id ORDER BY event_time DESC) = 1) AS z USING (role_id)
"""


view("daily", _daily("base_log", "payment_log"))
view("daily_late", _daily("base_log_late", "payment_log_late"))
view("all_info", _info("daily", "base_log", "payment_log"))
view("info", "SELECT i.* FROM all_info AS i ANTI JOIN closed_accounts AS c USING (role_id)")
for _name, _from in (("derive", "daily"), ("derive_late", "daily_late")):
    view(_name, f"""
SELECT date, part_date, role_id, CAST(m AS DECIMAL(32,4)) AS money_ac, CAST(r AS DECIMAL(32,4)) AS moneyrmb_ac,
       CAST(nth = 1 AS INTEGER) AS is_new, CAST(money_rmb > 0 AND r = money_rmb AS INTEGER) AS is_firstpay,
       CAST(money_rmb > 0 AS INTEGER) AS is_pay, CAST(r > 0 AS INTEGER) AS is_paid
FROM (SELECT *, sum(money) OVER w AS m, sum(money_rmb) OVER w AS r, row_number() OVER w AS nth FROM {_from}
      WINDOW w AS (PARTITION BY role_id ORDER BY part_date ROWS UNBOUNDED PRECEDING))
""")
view("event_days_late", """
SELECT role_id, part_date, date, a.online_time, coalesce(p.pay_count, 0) AS pay_count, CAST(coalesce(p.money, 0) AS DECIMAL(32,4)) AS money,
       CAST(coalesce(p.money_rmb, 0) AS DECIMAL(32,4)) AS money_rmb, CAST(coalesce(p.web_rmb, 0) AS DECIMAL(32,4)) AS web_rmb
FROM (SELECT role_id, part_date, date, CAST(sum(online_time) AS BIGINT) AS online_time FROM base_log_late GROUP BY ALL) AS a
FULL JOIN (SELECT role_id, part_date, date, count(money) AS pay_count, sum(money) AS money, sum(money_rmb) AS money_rmb, sum(web_rmb) AS web_rmb
           FROM payment_log_late GROUP BY ALL) AS p USING (role_id, part_date, date)
""")
view("info_late", """
SELECT i.* REPLACE (e.first AS install_date) FROM (""" + _info("daily_late", "base_log_late", "payment_log_late") + """) AS i
JOIN (SELECT role_id, min(date) AS first FROM event_days_late GROUP BY role_id) AS e USING (role_id)
ANTI JOIN closed_accounts AS c USING (role_id)
""")
view("hourly", """
SELECT b.date, b.part_date, b.hour, b.role_id, CAST(coalesce(p.money, 0) AS DECIMAL(32,4)) AS money,
       CAST(coalesce(p.money_rmb, 0) AS DECIMAL(32,4)) AS money_rmb, p.exchange_rate
FROM (SELECT DISTINCT date, part_date, CAST(date_trunc('hour', event_time) AS TIMESTAMP) AS hour, role_id FROM base_log) AS b
LEFT JOIN (SELECT part_date, date_trunc('hour', event_time) AS hour, role_id, sum(money) AS money,
                  sum(money_rmb) AS money_rmb, min(exchange_rate) AS exchange_rate
           FROM payment_log GROUP BY ALL) AS p
       ON p.part_date = b.part_date AND p.hour = b.hour AND p.role_id = b.role_id
""")
view("core_reason", """
SELECT date, part_date, role_id, reason,
       CAST(sum(coalesce(free_num, 0) + coalesce(paid_num, 0)) FILTER (event_type = 'gain') AS BIGINT) AS gain,
       CAST(sum(coalesce(free_num, 0) + coalesce(paid_num, 0)) FILTER (event_type = 'cost') AS BIGINT) AS cost
FROM core_log WHERE reason <> '638' GROUP BY ALL
""")
view("core_close", """
SELECT date, part_date, role_id, core_end FROM core_log WHERE reason <> '638' AND core_end IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY date, part_date, role_id ORDER BY event_time DESC, core_end DESC) = 1
""")
view("spine", "SELECT DISTINCT part_date, date, role_id FROM base_log_late")
view("item_rows", """
SELECT part_date, role_id, item_id, CAST(sum(item_add) FILTER (event_name = 'AddItem') AS BIGINT) AS item_add,
       CAST(sum(item_cost) FILTER (event_name = 'CostItem') AS BIGINT) AS item_cost,
       last(item_remain ORDER BY event_time, item_remain) FILTER (item_remain IS NOT NULL) AS item_end
FROM item_log GROUP BY ALL
""")
view("summon_rows", """
SELECT part_date, role_id, CAST(recruitid AS VARCHAR) AS summon_id, CAST(currency_id AS VARCHAR) AS currency_id,
       CAST(sum(currency_num) AS BIGINT) AS currency_num, CAST(sum(count) FILTER (is_free = 1) AS BIGINT) AS summon_free,
       CAST(sum(count) FILTER (is_free = 0) AS BIGINT) AS summon_valid, CAST(sum(count) AS BIGINT) AS summon_count,
       CAST(sum(10) FILTER (count = 10) AS BIGINT) AS summon_continue
FROM summon_log GROUP BY ALL
""")
view("hero_rows", """
SELECT part_date, role_id, hero_id, hero_level, hero_star, chip_cost
FROM (SELECT part_date, date, role_id, CAST(hero AS VARCHAR) AS hero_id,
             max(TRY_CAST(substr(CAST(fromrare AS VARCHAR), 3, 1) AS BIGINT)) AS hero_star, max(costchip) AS chip_cost
      FROM upgraderare_log GROUP BY ALL) AS s
FULL JOIN (SELECT part_date, date, role_id, CAST(hero AS VARCHAR) AS hero_id, max(tolv) AS hero_level
           FROM upgradehero_log GROUP BY ALL) AS l USING (part_date, role_id, hero_id)
""")
view("flag_rows", """
SELECT part_date, role_id, CAST(flag_id AS VARCHAR) AS flag_id, max(flag_level) AS flag_level, max(flag_star) AS flag_star,
       max(flag_awake) AS flag_awake
FROM herosnap_log WHERE flag_id <> 0 GROUP BY ALL
""")
view("artifact1_rows", """
SELECT part_date, role_id, CAST(artifact1_id AS VARCHAR) AS artifact1_id, max(artifact1_level) AS artifact1_level
FROM herosnap_log WHERE artifact1_id <> 0 GROUP BY ALL
""")
view("artifact2_rows", """
SELECT part_date, role_id, CAST(artifact2_id AS VARCHAR) AS artifact2_id, max(artifact2_level) AS artifact2_level
FROM herosnap_log WHERE artifact2_id <> 0 GROUP BY ALL
""")
view("order_payments", """
SELECT CAST(o_custkey AS VARCHAR) AS role_id, o_orderdate AS event_time, CAST(o_orderdate AS DATE) AS date,
       strftime(o_orderdate, '%Y-%m-%d') AS part_date,
       CASE o_orderstatus WHEN 'F' THEN 'pkg;' || CAST(o_orderkey % 500 AS VARCHAR)
                          WHEN 'O' THEN 'gold_10000' || CAST(1 + o_orderkey % 6 AS VARCHAR) ELSE 'other' END AS payment_itemid,
       CASE WHEN o_orderstatus = 'F' THEN 'web' ELSE 'app' END AS pay_source, 'JPY' AS currency,
       CAST(o_totalprice AS DECIMAL(18,4)) AS money,
       CAST(CAST(o_totalprice AS DECIMAL(18,4)) * 0.05 AS DECIMAL(32,4)) AS money_rmb,
       CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(o_totalprice AS DECIMAL(18,4)) * 0.05 AS DECIMAL(32,4)) END AS web_rmb,
       CAST(0.05 AS DECIMAL(12,6)) AS exchange_rate, CAST(1 AS BIGINT) AS online_time,
       CAST(o_orderkey % 60 AS BIGINT) AS level, CAST(o_orderkey % 9 AS BIGINT) AS vip_level,
       CAST(o_custkey % 25 AS VARCHAR) AS zone_id,
       CASE WHEN o_custkey % 6 <> 0 THEN 'ch' || CAST(o_custkey % 6 AS VARCHAR) END AS channel,
       CASE WHEN o_custkey % 2 = 0 THEN 'ios' ELSE 'android' END AS os
FROM orders
""")
view("token_log", """
SELECT CAST(o_custkey AS VARCHAR) AS role_id, o_orderdate AS event_time, CAST(o_orderdate AS DATE) AS date,
       strftime(o_orderdate, '%Y-%m-%d') AS part_date,
       CASE WHEN l_returnflag IN ('A', 'R') THEN 'gain' ELSE 'cost' END AS event_type,
       CASE WHEN l_suppkey % 10 = 0 THEN '638' ELSE CAST(l_suppkey % 10 AS VARCHAR) END AS reason,
       CASE WHEN l_partkey % 2 = 0 THEN '2' ELSE '1' END AS item_id, CAST(l_quantity AS BIGINT) AS item_num,
       CASE WHEN l_linenumber <> 7 THEN l_partkey END AS item_end
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
view("rates", """
SELECT c.currency, strftime(m.month, '%Y-%m') AS currency_time,
       CAST(4.80 + 0.01 * (row_number() OVER (PARTITION BY c.currency ORDER BY m.month) - 1) AS DECIMAL(12,6)) AS rate
FROM (SELECT CAST(unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)),
                                         INTERVAL 1 MONTH)) AS DATE) AS month FROM orders) AS m,
     (VALUES ('JPY'), ('USD')) AS c(currency)
""")
view("prices", """
SELECT * FROM (VALUES ('gold_100001', 660), ('gold_100002', 320), ('gold_100003', 120), ('gold_100004', 60),
                      ('gold_100005', 32), ('gold_100006', 4)) AS p(payment_itemid, token_num)
""")
view("order_daily", _daily("order_payments", "order_payments"))
view("order_info", """
SELECT i.* FROM (""" + _info("order_daily", "order_payments", "order_payments") + """) AS i
ANTI JOIN closed_accounts AS c USING (role_id)
""")
