"""Reconciliation checks. The SQL side recomputes both layers from the logs."""

from __future__ import annotations

from harness.logs import CHECK_DAY, CHECK_MOMENT, GAME, Logs
from harness.queries_models import _kpi_sql
from harness.registry import query
from rolemart.plans import checks, upstream
from rolemart.sources.tables import TABLES, conform

_D4 = "DECIMAL(38,4)"


def _totals(expected: str, actual: str, difference: str = "abs(expected - actual)") -> str:
    return f"SELECT expected, actual, {difference} AS difference FROM ({expected}) AS e(expected), ({actual}) AS a(actual)"


def _by_key(
    key: str, expected: str, actual: str, *, join: str = "LEFT", signed: bool = False, only_mismatch: bool = False, cast: str = "",
    missing_is_zero: bool = True,
) -> str:
    gap = "coalesce(expected, 0) - coalesce(actual, 0)" if missing_is_zero else "expected - actual"
    gap = gap if signed else f"abs({gap})"
    gap = f"CAST({gap} AS {cast})" if cast else gap
    tail = " WHERE coalesce(expected, 0) <> coalesce(actual, 0)" if only_mismatch else ""
    return (
        f"SELECT {key}, expected, actual, {gap} AS difference FROM ({expected}) AS e({key}, expected) "
        f"{join} JOIN ({actual}) AS a({key}, actual) USING ({key}){tail}"
    )


_YESTERDAY = "part_date = '2024-01-30'"
_RECENT = "part_date >= '2024-01-01'"
_CLOSED = "part_date >= '2024-01-01' AND part_date < '2024-01-31'"


@query(
    "chk_4_1",
    _totals(
        f"SELECT CAST(round(sum(money), 0) AS BIGINT) FROM payment_log WHERE {_YESTERDAY}",
        f"SELECT CAST(round(sum(money), 0) AS BIGINT) FROM daily WHERE {_YESTERDAY}",
    ),
)
def _(t: Logs):
    return checks.user_daily_money(t.payment_log, t.daily, CHECK_DAY)


@query("chk_4_2", f"SELECT role_id, count(*) AS row_count FROM daily WHERE {_YESTERDAY} GROUP BY role_id HAVING count(*) > 1")
def _(t: Logs):
    return checks.user_daily_unique(t.daily, CHECK_DAY)


@query(
    "chk_4_3",
    _by_key(
        "role_id",
        f"SELECT role_id, CAST(round(sum(money), 0) AS BIGINT) FROM payment_log WHERE {_YESTERDAY} GROUP BY role_id",
        f"SELECT role_id, CAST(round(sum(money), 0) AS BIGINT) FROM daily WHERE {_YESTERDAY} GROUP BY role_id",
    ),
)
def _(t: Logs):
    return checks.user_daily_money_by_user(t.payment_log, t.daily, CHECK_DAY)


@query(
    "chk_5_1",
    "SELECT *, CAST(round(difference * 100 / expected, 4) AS DECIMAL(20,4)) AS percent FROM ("
    + _totals("SELECT count(*) FROM info", "SELECT count(DISTINCT role_id) FROM base_log") + ")",
)
def _(t: Logs):
    return checks.user_info_coverage(t.base_log, t.info)


@query("chk_5_2", "SELECT role_id, count(*) AS row_count FROM all_info GROUP BY role_id HAVING count(*) > 1")
def _(t: Logs):
    return checks.user_info_unique(t.all_info)


@query(
    "chk_6_1",
    _totals(
        f"SELECT CAST(coalesce(sum(money), 0) AS {_D4}) FROM payment_log WHERE part_date < '2024-01-31'",
        f"SELECT CAST(coalesce(sum(m), 0) AS {_D4}) FROM (SELECT max(money_ac) AS m FROM derive WHERE date < DATE '2024-01-31' GROUP BY role_id)",
        "CAST(round(abs(expected - actual), 0) AS BIGINT)",
    ),
)
def _(t: Logs):
    return checks.derive_total(t.payment_log, t.derive, CHECK_DAY)


@query("chk_6_2", "SELECT part_date, role_id, count(*) AS row_count FROM derive GROUP BY ALL HAVING count(*) > 1")
def _(t: Logs):
    return checks.derive_unique(t.derive)


@query(
    "chk_6_3",
    f"""
    SELECT part_date, role_id, e.money_ac AS expected, v.money_ac AS actual,
           abs(coalesce(e.money_ac, 0) - coalesce(v.money_ac, 0)) AS difference
    FROM (SELECT * FROM (SELECT part_date, role_id,
                                CAST(sum(money) OVER (PARTITION BY role_id ORDER BY part_date ROWS UNBOUNDED PRECEDING) AS {_D4}) AS money_ac
                         FROM daily) WHERE {_RECENT}) AS e
    FULL JOIN (SELECT part_date, role_id, money_ac FROM derive WHERE {_RECENT}) AS v USING (part_date, role_id)
    WHERE coalesce(e.money_ac, 0) <> coalesce(v.money_ac, 0)
    """,
)
def _(t: Logs):
    return checks.derive_running_total(t.daily, t.derive, CHECK_DAY)


_UNTIL = "part_date BETWEEN '2024-01-29' AND '2024-01-30'"


@query(
    "chk_7_1",
    _totals(
        f"SELECT count(DISTINCT role_id) FROM base_log WHERE {_UNTIL} AND event_time < TIMESTAMP '2024-01-30 15:00:00'",
        f"SELECT count(DISTINCT role_id) FROM hourly WHERE {_UNTIL} AND hour < TIMESTAMP '2024-01-30 15:00:00'",
    ),
)
def _(t: Logs):
    return checks.hourly_users(t.base_log, t.hourly, CHECK_MOMENT)


@query(
    "chk_7_2",
    _by_key(
        "role_id",
        f"SELECT role_id, CAST(sum(money) AS {_D4}) FROM payment_log WHERE {_UNTIL} AND event_time < TIMESTAMP '2024-01-30 15:00:00' GROUP BY role_id",
        f"SELECT role_id, CAST(sum(money) AS {_D4}) FROM hourly WHERE {_UNTIL} AND hour < TIMESTAMP '2024-01-30 15:00:00' GROUP BY role_id",
        cast=_D4,
    ),
)
def _(t: Logs):
    return checks.hourly_money_by_user(t.payment_log, t.hourly, CHECK_MOMENT)


for _name, _type, _detail, _side in (
    ("chk_8_1_add", "gain", "coregain_detail", "gain"), ("chk_8_1_cost", "cost", "corecost_detail", "cost"),
):
    def _core_flow(t: Logs, event_type=_type, detail=_detail):
        return checks.core_flow_by_user(t.core_log, t.core, GAME, event_type, detail, CHECK_DAY)

    query(
        _name,
        _by_key(
            "role_id",
            f"SELECT role_id, CAST(sum(CASE WHEN event_type = '{_type}' THEN coalesce(free_num, 0) + coalesce(paid_num, 0) END) AS BIGINT) "
            f"FROM core_log WHERE {_YESTERDAY} AND reason <> '638' GROUP BY role_id",
            f"SELECT role_id, CAST(sum({_side}) AS BIGINT) FROM core_reason WHERE {_YESTERDAY} AND {_side} IS NOT NULL GROUP BY role_id",
        ),
    )(_core_flow)


@query(
    "chk_9_1",
    _by_key(
        "part_date",
        f"SELECT part_date, count(DISTINCT role_id) FROM daily WHERE {_RECENT} GROUP BY part_date",
        f"SELECT part_date, count(DISTINCT role_id) FROM base_log WHERE {_RECENT} GROUP BY part_date",
        missing_is_zero=False,
    ),
)
def _(t: Logs):
    return checks.active_users(t.daily, upstream.active_daily(t.daily), CHECK_DAY)


for _name, _detail, _side, _value in (
    ("chk_10_1", "coregain_detail", "gain", "core_add"), ("chk_11_1", "corecost_detail", "cost", "core_cost"),
):
    def _core_total(t: Logs, detail=_detail, value=_value, zero=_name == "chk_10_1"):
        report = upstream.core_by_reason(t.core, t.all_info, detail, value)
        return checks.core_by_reason_total(t.core, report, t.test_accounts, detail, value, CHECK_DAY, zero)

    query(
        _name,
        _by_key(
            "part_date",
            f"SELECT part_date, CAST(sum({_side}) AS BIGINT) FROM core_reason ANTI JOIN test_accounts USING (role_id) "
            f"WHERE {_RECENT} AND {_side} IS NOT NULL GROUP BY part_date",
            f"SELECT c.part_date, CAST(sum(c.{_side}) AS BIGINT) FROM core_reason AS c LEFT JOIN all_info AS i USING (role_id) "
            f"WHERE i.is_test IS NULL AND c.{_RECENT} AND c.{_side} IS NOT NULL GROUP BY c.part_date",
            missing_is_zero=_name == "chk_10_1",
        ),
    )(_core_total)


_REAL_DAU = "SELECT part_date, count(DISTINCT role_id) FROM daily WHERE is_test IS NULL AND {0} GROUP BY part_date"
_BASE_DAU = (
    "SELECT b.part_date, count(DISTINCT b.role_id) FROM base_log AS b LEFT JOIN all_info AS i USING (role_id) "
    "WHERE i.is_test IS NULL AND b.{0} GROUP BY b.part_date"
)
_INSTALLS = (
    "SELECT install_date, count(DISTINCT role_id) FROM all_info WHERE is_test IS NULL AND install_date >= DATE '2024-01-01' GROUP BY install_date"
)
_FIRST_DAYS = (
    "SELECT b.date, count(DISTINCT b.role_id) FROM base_log AS b JOIN all_info AS i USING (role_id) "
    "WHERE i.is_test IS NULL AND b.date = i.install_date AND b.date >= DATE '2024-01-01' GROUP BY b.date"
)

for _suffix, _only in (("", True), ("_all", False)):
    _DAYS = _CLOSED if _only else _RECENT
    _LAST_INSTALL = "2024-01-30" if _only else "2024-01-31"

    def _retention(t: Logs, only=_only):
        return checks.retention_base(t.daily, upstream.retention_daily(t.daily, t.all_info), CHECK_DAY, only)

    query("chk_12_1" + _suffix, _by_key("part_date", _REAL_DAU.format(_RECENT), _BASE_DAU.format(_RECENT), signed=True, only_mismatch=_only))(_retention)

    def _cohorts(t: Logs, only=_only):
        return checks.retention_installs(t.all_info, upstream.user_retention(t.daily, t.all_info), CHECK_DAY, only)

    query("chk_13_1" + _suffix, _by_key("install_date", _INSTALLS, _FIRST_DAYS, only_mismatch=_only))(_cohorts)

    def _hour_users(t: Logs, only=_only):
        return checks.hourly_report_users(t.daily, t.kpi_hourly, CHECK_DAY, only)

    query("chk_15_1" + _suffix, _by_key("part_date", _REAL_DAU.format(_DAYS), _BASE_DAU.format(_DAYS), only_mismatch=_only, missing_is_zero=_only))(_hour_users)

    def _hour_money(t: Logs, only=_only):
        return checks.hourly_report_money(t.daily, t.kpi_hourly, "money_hourly", CHECK_DAY, only)

    query(
        "chk_15_2" + _suffix,
        _by_key(
            "part_date",
            f"SELECT part_date, CAST(sum(money) AS {_D4}) FROM daily WHERE is_test IS NULL AND {_DAYS} GROUP BY part_date",
            f"SELECT h.part_date, CAST(sum(h.money) AS {_D4}) FROM hourly AS h LEFT JOIN all_info AS i USING (role_id) "
            f"WHERE i.is_test IS NULL AND h.{_DAYS.replace('AND part_date', 'AND h.part_date')} GROUP BY h.part_date",
            only_mismatch=_only, cast=_D4, missing_is_zero=_only,
        ),
    )(_hour_money)

    def _hour_installs(t: Logs, only=_only):
        return checks.hourly_report_installs(t.all_info, t.kpi_hourly, CHECK_DAY, only)

    query(
        "chk_15_3" + _suffix,
        _by_key(
            "part_date",
            "SELECT strftime(install_date, '%Y-%m-%d'), count(DISTINCT role_id) FROM all_info WHERE is_test IS NULL "
            f"AND install_date BETWEEN DATE '2024-01-01' AND DATE '{_LAST_INSTALL}' GROUP BY install_date",
            "SELECT strftime(b.date, '%Y-%m-%d'), count(DISTINCT b.role_id) FROM base_log AS b JOIN all_info AS i USING (role_id) "
            f"WHERE i.is_test IS NULL AND b.date = i.install_date AND b.date BETWEEN DATE '2024-01-01' AND DATE '{_LAST_INSTALL}' GROUP BY b.date",
            only_mismatch=_only, missing_is_zero=_only,
        ),
    )(_hour_installs)


@query(
    "chk_14_1",
    _by_key(
        "part_date",
        f"SELECT part_date, CAST(round(sum(money_rmb), 0) AS BIGINT) FROM daily WHERE {_RECENT} GROUP BY part_date",
        f"SELECT part_date, CAST(round(sum(money_rmb), 0) AS BIGINT) FROM ({_kpi_sql('all_info')}) WHERE {_RECENT} GROUP BY part_date",
    )
    + " ORDER BY part_date, difference",
)
def _(t: Logs):
    return checks.kpi_money(t.daily, conform(t.kpi, TABLES["ads_kpi_daily"]), CHECK_DAY)


@query(
    "chk_14_2",
    _totals(
        f"SELECT CAST(sum(money_rmb) AS {_D4}) FROM daily WHERE is_test IS NULL AND part_date <= '2024-01-30'",
        f"SELECT sum(moneyrmb_ac) FROM ({_kpi_sql('all_info')}) WHERE {_YESTERDAY}",
        f"CAST(abs(expected - actual) AS {_D4})",
    ),
)
def _(t: Logs):
    return checks.kpi_money_cumulative(t.daily, conform(t.kpi, TABLES["ads_kpi_daily"]), CHECK_DAY)


@query(
    "chk_14_3",
    _totals(
        "SELECT count(DISTINCT role_id) FROM daily WHERE is_test IS NULL AND part_date <= '2024-01-30'",
        f"SELECT CAST(sum(newuser_ac) AS BIGINT) FROM ({_kpi_sql('all_info')}) WHERE {_YESTERDAY}",
    ),
)
def _(t: Logs):
    return checks.kpi_users_cumulative(t.daily, t.kpi, CHECK_DAY)


@query(
    "chk_16_1",
    _by_key(
        "part_date",
        f"SELECT part_date, CAST(sum(money) AS {_D4}) FROM daily WHERE is_test IS NULL AND {_CLOSED} GROUP BY part_date",
        f"SELECT h.part_date, CAST(sum(h.money) AS {_D4}) FROM hourly AS h LEFT JOIN all_info AS i USING (role_id) "
        f"WHERE i.is_test IS NULL AND h.{_CLOSED.replace('AND part_date', 'AND h.part_date')} GROUP BY h.part_date",
        only_mismatch=True, cast=_D4,
    ),
)
def _(t: Logs):
    return checks.hourly_report_money(t.daily, upstream.kpi_hourly_full(t.hourly, t.all_info), "money", CHECK_DAY)
