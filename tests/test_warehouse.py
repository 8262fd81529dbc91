"""Stored tables end to end: raw logs on disk, every model refreshed, checks over the results."""

from __future__ import annotations

import os
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from harness.logs import DAYS, GAME, Logs
from harness.registry import spark_queries
from rolemart.config import Game, RunWindow
from rolemart.plans.reconcile import CHECKS, run_check
from rolemart.plans.warehouse import MODELS, Warehouse
from rolemart.sources.sinks import write_table
from rolemart.sources.tables import TABLES
from tests.conftest import rows_of

SF_DIR = "/root/testdata/sf0.001"
LOGS = ("payment_log", "core_log")
LATE = ("item_log", "summon_log", "herosnap_log", "upgraderare_log", "upgradehero_log")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root, t = str(tmp_path_factory.mktemp("wh")), Logs(spark, SF_DIR)
    raw = f"{root}/{GAME.raw_schema}"
    for name in ("base_log", *LOGS, *LATE):
        getattr(t, name).coalesce(1).write.partitionBy("part_date").parquet(f"{raw}/{name}")
    months = F.concat(F.substring("part_date", 1, 7), F.lit("-01"))
    tokens = t.token_log.withColumns({"part_date": months, "date": F.to_date(months)})
    tokens.coalesce(1).write.partitionBy("part_date").parquet(f"{raw}/token_log")
    t.test_accounts.write.parquet(f"{raw}/test_accounts")
    t.rates.write.parquet(f"{raw}/currency_rate")
    wh = Warehouse(spark, root, GAME)
    for model in MODELS:
        wh.refresh(model, DAYS)
    return wh


def test_every_declared_table_has_a_model():
    assert set(MODELS) == set(TABLES)


@pytest.mark.parametrize("model", sorted(MODELS))
def test_stored_types_are_the_declared_ones(stored, model):
    assert stored.table(model).schema.simpleString() == TABLES[model].schema.simpleString()


@pytest.mark.parametrize("model", ["dws_user_daily_derive", "dws_user_hourly", "ads_active_daily"])
def test_stored_rows_equal_the_query(spark, stored, model):
    expected = spark_queries()[model](spark, SF_DIR)
    assert rows_of(stored.table(model), *sorted(expected.columns)) == rows_of(expected, *sorted(expected.columns))


def test_partition_filter_reaches_the_scan(stored):
    from rolemart.sources.logs import in_window

    plan = in_window(stored.table("dws_user_daily"), DAYS)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part_date" in plan and "(part_date" in plan.split("PartitionFilters")[1]
    log = in_window(stored.log("base_log"), RunWindow("2024-01-05", "2024-01-06"))
    assert log.schema["part_date"].dataType.simpleString() == "string"
    assert "2024-01-05" in log._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]


def test_derive_in_two_runs_equals_one_run(spark, stored, tmp_path):
    from rolemart.plans import upstream

    daily = stored.table("dws_user_daily")
    first = upstream.user_daily_derive(daily.where("part_date < '2024-01-11'"))
    second = upstream.user_daily_derive(daily.where("part_date >= '2024-01-11'"), first)
    assert rows_of(first.unionByName(second)) == rows_of(upstream.user_daily_derive(daily))


def test_rerun_of_a_range_changes_nothing(stored):
    for model in ("dws_user_daily_derive", "ads_kpi_daily", "dws_item_snapshot"):
        before = rows_of(stored.table(model).withColumn("part_date", F.col("part_date")))
        window = RunWindow("2024-01-11", "2024-01-31") if model == "dws_user_daily_derive" else DAYS
        stored.refresh(model, window)
        assert rows_of(stored.table(model)) == before


def test_carried_history_meets_the_cumulative_check(spark, stored):
    wh = Warehouse(spark, os.path.dirname(stored._mart), GAME, carry_history=True)
    plain = rows_of(wh.table("ads_kpi_daily").where("newuser_ac is not null"))
    wh.refresh("ads_kpi_daily", RunWindow("2024-01-01", "2024-01-10"))
    wh.refresh("ads_kpi_daily", RunWindow("2024-01-11", "2024-01-31"))
    carried = wh.table("ads_kpi_daily").where("zone_id is not null and channel is not null and newuser_ac > 0")
    known = {r[:4]: r[-2] for r in plain if r[1] is not None and r[2] is not None}
    got = {tuple(r)[:4]: tuple(r)[-2] for r in carried.collect()}
    assert got and all(known.get(k) == v for k, v in got.items())
    stored.refresh("ads_kpi_daily", DAYS)


# Channel is NULL for some users, and the report counts neither those nor days a user is away.
EXPECTED_GAPS = {"14.1", "14.2", "14.3"}


@pytest.mark.parametrize("name", sorted(set(CHECKS) - EXPECTED_GAPS))
def test_checks_find_nothing(stored, name):
    report = run_check(stored, name, "2024-01-31 15:20:00")
    if "difference" in report.columns:
        report = report.where("coalesce(difference, 0) != 0")
    assert report.collect() == []


def test_checks_report_injected_faults(spark, stored):
    from rolemart.plans import checks

    daily, payments = stored.table("dws_user_daily"), stored.log("payment_log")
    broken = daily.withColumn("money", F.when(F.col("part_date") == "2024-01-30", F.col("money") + 5).otherwise(F.col("money")))
    users = daily.where("part_date = '2024-01-30'").count()
    assert checks.user_daily_money(payments, broken, "2024-01-31").first().difference == 5 * users
    assert checks.user_daily_unique(daily.unionByName(daily), "2024-01-31").count() == users
    info = stored.table("dws_user_info")
    assert checks.user_info_unique(info.unionByName(info)).count() == info.count()
    derive = stored.table("dws_user_daily_derive")
    wrong = derive.withColumn("money_ac", F.col("money_ac") + F.lit(1))
    assert checks.derive_running_total(daily, wrong, "2024-01-31").count() == derive.count()
    missing = stored.table("ads_kpi_hourly_hi").where("part_date != '2024-01-20'")
    got = rows_of(checks.hourly_report_users(daily, missing, "2024-01-31"), "part_date")
    assert got == [("2024-01-20",)]


def test_games_share_models_but_not_folders(spark, stored):
    other = Warehouse(spark, "/somewhere", Game("other"))
    assert other.path("ads_hero") == "/somewhere/other_w/ads_hero_df"
    assert other.table("ads_hero", may_be_absent=True).collect() == []


def test_refresh_without_its_upstream_deletes_nothing(spark, frame, tmp_path):
    wh = Warehouse(spark, str(tmp_path), Game("g"))
    stored = frame("part_date string, dau bigint", ("2024-01-01", 1), ("2024-01-02", 2))
    write_table(stored, TABLES["ads_active_daily"], wh.path("ads_active_daily"), RunWindow("2024-01-01", "2024-01-02"))
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        wh.refresh("ads_active_daily", RunWindow("2024-01-01", "2024-01-02"))
    assert wh.table("ads_active_daily").count() == 2


LATE_BASE = "role_id string, event_time timestamp_ntz, date date, part_date string, zone_id string, channel string, os string, level bigint, vip_level bigint, online_time bigint"
LATE_PAY = "role_id string, event_time timestamp_ntz, date date, part_date string, payment_itemid string, money decimal(32,4), money_rmb decimal(32,4), web_rmb decimal(32,4), exchange_rate decimal(12,6), level bigint"


@pytest.fixture
def late_wh(spark, frame, tmp_path):
    """Two users; u pays on 31 January, which arrives on 1 February, and v pays on time in both months."""

    def base(role, day, part):
        return (role, datetime.fromisoformat(f"{day} 10:00:00"), date.fromisoformat(day), part, "1", "c", "ios", 1, 0, 5)

    def pay(role, day, part, money):
        return (role, datetime.fromisoformat(f"{day} 11:00:00"), date.fromisoformat(day), part, "x", Decimal(money), Decimal(money), None, Decimal("1"), 1)

    wh = Warehouse(spark, str(tmp_path), Game("g"), late_days=True)
    raw = f"{tmp_path}/{wh.game.raw_schema}"
    seen = [("u", "2024-01-31", "2024-02-01"), ("v", "2024-01-31", "2024-01-31"), ("v", "2024-02-01", "2024-02-01")]
    paid = [("u", "2024-01-31", "2024-02-01", 50), ("v", "2024-01-31", "2024-01-31", 1), ("v", "2024-02-01", "2024-02-01", 2)]
    frame(LATE_BASE, *[base(*x) for x in seen]).write.partitionBy("part_date").parquet(f"{raw}/base_log")
    frame(LATE_PAY, *[pay(*x) for x in paid]).write.partitionBy("part_date").parquet(f"{raw}/payment_log")
    frame("role_id string").write.parquet(f"{raw}/test_accounts")
    for window in (RunWindow("2024-01-01", "2024-01-31"), RunWindow("2024-02-01", "2024-02-29")):
        for model in ("dws_user_daily", "dws_user_info", "dws_user_daily_derive", "ads_kpi_monthly", "ads_kpi_daily"):
            wh.refresh(model, window)
    return wh


def test_monthly_reports_hold_late_money_in_its_month(late_wh):
    report = late_wh.table("ads_kpi_monthly").where("money_rmb is not null")
    assert rows_of(report.selectExpr("cast(month as string) m", "cast(money_rmb as double) r", "active_users u")) == [("2024-01-01", 51.0, 2), ("2024-02-01", 2.0, 1)]


def test_daily_reports_hold_late_days_where_asked_for(late_wh):
    report = late_wh.table("ads_kpi_daily").where("money_rmb is not null")
    got = rows_of(report.selectExpr("cast(date as string) d", "part_date p", "cast(money_rmb as double) r"))
    assert got == [("2024-01-31", "2024-01-31", 51.0), ("2024-02-01", "2024-02-01", 2.0)]
    plain = Warehouse(late_wh.spark, os.path.dirname(late_wh._mart), Game("g"))
    plain.refresh("ads_kpi_daily", RunWindow("2024-02-01", "2024-02-29"))
    february = plain.table("ads_kpi_daily").where("money_rmb is not null and part_date >= '2024-02-01'")
    assert rows_of(february.selectExpr("cast(date as string) d", "cast(money_rmb as double) r")) == [("2024-02-01", 2.0)]


def _late_base(role, day, part):
    return (role, datetime.fromisoformat(f"{day} 10:00:00"), date.fromisoformat(day), part, "1", "c", "ios", 1, 0, 5)


def _late_pay(role, day, part, money):
    return (role, datetime.fromisoformat(f"{day} 11:00:00"), date.fromisoformat(day), part, "x", Decimal(money), Decimal(money), None, Decimal("1"), 1)


@pytest.fixture
def month_wh(spark, frame, tmp_path):
    """A warehouse over given (role, day, partition) activity and (role, day, partition, money) payments, not refreshed yet."""

    def build(seen, paid, name):
        wh = Warehouse(spark, str(tmp_path / name), Game("g"))
        raw = f"{tmp_path / name}/{wh.game.raw_schema}"
        frame(LATE_BASE, *[_late_base(*x) for x in seen]).write.partitionBy("part_date").parquet(f"{raw}/base_log")
        frame(LATE_PAY, *[_late_pay(*x) for x in paid]).write.partitionBy("part_date").parquet(f"{raw}/payment_log")
        frame("role_id string").write.parquet(f"{raw}/test_accounts")
        return wh

    return build


JAN, FEB = RunWindow("2024-01-01", "2024-01-31"), RunWindow("2024-02-01", "2024-02-29")
MONTHLY = ("cast(month as string) m", "new_users n", "active_users u", "cast(money_rmb as double) r", "new_users_ac na", "cast(moneyrmb_ac as double) ra")


def _run_months(wh, *windows):
    for window in windows:
        for model in ("dws_user_daily", "dws_user_info", "ads_kpi_monthly"):
            wh.refresh(model, window)
    return rows_of(wh.table("ads_kpi_monthly").where("active_users is not null").selectExpr(*MONTHLY))


def test_late_money_of_a_user_who_comes_back_stays_in_its_month(month_wh):
    """u pays 50 on 31 January, which arrives on 1 February, and is also seen that day."""
    seen = [("u", "2024-01-31", "2024-02-01"), ("u", "2024-02-01", "2024-02-01"), ("v", "2024-01-31", "2024-01-31"), ("v", "2024-02-01", "2024-02-01")]
    paid = [("u", "2024-01-31", "2024-02-01", 50), ("v", "2024-01-31", "2024-01-31", 1), ("v", "2024-02-01", "2024-02-01", 2)]
    wh = month_wh(seen, paid, "back")
    assert _run_months(wh, JAN, FEB) == [("2024-01-01", 2, 2, 51.0, 2, 51.0), ("2024-02-01", 0, 2, 2.0, 2, 53.0)]
    daily = wh.table("dws_user_daily")
    assert daily.groupBy("role_id", "part_date").count().where("count > 1").isEmpty()
    row = daily.where("role_id = 'u'").first()
    assert [(str(d["date"]), d["pay_count"], d["money"], d["online_time"]) for d in row["days"]] == [
        ("2024-01-31", 1, Decimal("50.0000"), 5), ("2024-02-01", 0, Decimal("0.0000"), 5)]
    assert str(wh.table("dws_user_info").where("role_id = 'u'").first()["install_date"]) == "2024-01-31"


@pytest.mark.parametrize("late", [True, False])
def test_running_totals_do_not_depend_on_the_order_of_runs(month_wh, late):
    seen = [("u", "2024-01-30", "2024-01-30"), ("v", "2024-02-03", "2024-02-03")] + [("w", "2024-01-31", "2024-02-02")] * late
    paid = [("u", "2024-01-30", "2024-01-30", 3), ("v", "2024-02-03", "2024-02-03", 4)] + [("w", "2024-01-31", "2024-02-02", 5)] * late
    both = RunWindow("2024-01-01", "2024-02-29")
    orders = {"one": (both,), "two": (JAN, FEB), "again": (JAN, FEB, FEB, JAN, FEB)}
    found = {name: _run_months(month_wh(seen, paid, name), *windows) for name, windows in orders.items()}
    assert found["one"] == found["two"] == found["again"]
    money = 8.0 if late else 3.0
    assert found["one"] == [("2024-01-01", 1 + late, 1 + late, money, 1 + late, money), ("2024-02-01", 1, 1, 4.0, 2 + late, money + 4)]


def test_a_wrong_clock_reaches_no_report_and_is_counted(month_wh):
    from rolemart.plans import upstream

    seen = [("u", "2024-02-01", "2024-02-01"), ("u", "1970-01-01", "2024-02-01"), ("u", "2024-03-01", "2024-02-01")]
    paid = [("u", "1970-01-01", "2024-02-01", 7), ("u", "2024-02-01", "2024-02-01", 2)]
    wh = month_wh(seen, paid, "clock")
    assert _run_months(wh, FEB) == [("2024-02-01", 1, 1, 2.0, 1, 2.0)]
    assert wh.written("ads_kpi_monthly", FEB) == FEB
    stray = upstream.stray_days(wh.table("dws_user_daily")).selectExpr("part_date", "cast(date as string)", "users", "pay_count", "cast(money_rmb as double)")
    assert rows_of(stray) == [("2024-02-01", "1970-01-01", 1, 1, 7.0), ("2024-02-01", "2024-03-01", 1, 0, 0.0)]
    assert wh.table("dws_user_daily").first()["money_rmb"] == 9  # the partition's own total still has all of it


def test_late_reports_read_a_bounded_range_of_partitions(month_wh):
    wh = month_wh([("u", "2024-01-30", "2024-01-30")], [("u", "2024-01-30", "2024-01-30", 3)], "bounded")
    wh.refresh("dws_user_daily", JAN)
    wh.refresh("dws_user_info", JAN)
    from rolemart.plans import kpi

    plan = kpi.monthly_metrics(wh.table("dws_user_daily"), wh.table("dws_user_info"), JAN)._jdf.queryExecution().executedPlan().toString()
    assert "2024-01-01" in plan.split("PartitionFilters: [")[1].split("]")[0] and "2024-04-02" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_one_row_per_user_and_partition_day(spark):
    t = Logs(spark, SF_DIR)
    from rolemart.plans import upstream

    daily = upstream.user_daily(t.base_log_late, t.payment_log_late, t.test_accounts)
    assert daily.groupBy("role_id", "part_date").count().where("count > 1").isEmpty()
    assert t.base_log_late.where("date < part_date").count() > 0
