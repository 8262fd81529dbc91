"""Models on hand-made rows: ties, late rows, missing users, NULL dimensions, gaps."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rolemart.config import Game, RunWindow
from rolemart.plans import distribution, holdings, kpi, ledger, snapshots, upstream
from tests.conftest import rows_of

D1, D2 = date(2024, 1, 1), date(2024, 1, 2)
BASE = "part_date string, date date, role_id string"
NOON = datetime(2024, 1, 1, 12)
GAME = Game("g")


def test_item_snapshot(frame):
    base = frame(BASE, ("2024-01-01", D1, "a"), ("2024-01-01", D1, "b"))
    log = frame(
        "part_date string, event_time timestamp_ntz, role_id string, event_name string, item_id string, item_add bigint, item_cost bigint, item_remain bigint",
        ("2024-01-01", NOON, "a", "AddItem", "i", 3, None, 10),
        ("2024-01-01", NOON, "a", "AddItem", "i", 4, None, 12),
        ("2024-01-01", NOON + timedelta(hours=1), "a", "CostItem", "i", 99, 2, None),
        ("2024-01-01", NOON, "a", "Other", "j", 5, 5, None),
        ("2024-01-01", NOON, "c", "AddItem", "i", 1, None, 1),
    )
    got = {r.role_id: r.item_detail and [tuple(x) for x in r.item_detail] for r in snapshots.item_snapshot(base, log).collect()}
    assert got == {"a": [("i", 7, 2, 12), ("j", None, None, None)], "b": None}


def test_summon_snapshot_bulk_draws_count_as_ten(frame):
    base = frame(BASE, ("2024-01-01", D1, "a"))
    log = frame(
        "part_date string, role_id string, recruitid int, count bigint, is_free int, currency_id int, currency_num bigint",
        ("2024-01-01", "a", 1, 10, 0, 2, 100), ("2024-01-01", "a", 1, 10, 0, 2, 100), ("2024-01-01", "a", 1, 3, 1, 2, None),
    )
    detail = snapshots.summon_snapshot(base, log).first().summon_detail
    assert [tuple(d) for d in detail] == [("1", "2", 200, 3, 20, 23, 20)]


def test_hero_snapshot_pairs_both_upgrades(frame):
    base = frame(BASE, ("2024-01-01", D1, "a"))
    stars = frame(
        "part_date string, date date, role_id string, hero int, fromrare int, costchip bigint",
        ("2024-01-01", D1, "a", 7, 103, 50), ("2024-01-01", D1, "a", 7, 104, 20), ("2024-01-01", D1, "a", 8, 12, 5),
    )
    levels = frame("part_date string, date date, role_id string, hero int, tolv bigint", ("2024-01-01", D1, "a", 7, 30), ("2024-01-01", D1, "a", 9, 3))
    detail = snapshots.hero_snapshot(base, stars, levels).first().hero_detail
    assert [tuple(d) for d in detail] == [("7", 30, 4, 50), ("8", None, None, 5), ("9", 3, None, None)]


def test_artifact_slots_and_zip_padding(frame):
    base = frame(BASE, ("2024-01-01", D1, "a"), ("2024-01-01", D1, "b"))
    log = frame(
        "part_date string, role_id string, artifact1_id bigint, artifact1_level bigint, artifact2_id bigint, artifact2_level bigint",
        ("2024-01-01", "a", 5, 1, 0, 9), ("2024-01-01", "a", 5, 3, 6, 2), ("2024-01-01", "a", 7, 1, None, 4), ("2024-01-01", "b", 0, 1, 0, 1),
    )
    snap = snapshots.artifact_snapshot(base, log)
    got = {r.role_id: (r.artifact1_detail, r.artifact2_detail) for r in snap.collect()}
    assert [tuple(d) for d in got["a"][0]] == [("5", 3), ("7", 1)] and [tuple(d) for d in got["a"][1]] == [("6", 2)]
    assert got["b"] == (None, None)
    best = rows_of(holdings.artifact_best(snap), "role_id", "artifact_id", "artifact_level")
    assert best == [("a", None, None), ("a", "5", 3), ("a", "6", 2), ("a", "7", 1)]


def _daily(frame, *rows):
    ddl = (
        "date date, part_date string, role_id string, level_max bigint, viplevel_max bigint, online_time bigint, pay_count bigint, "
        "money decimal(32,4), money_rmb decimal(32,4), web_rmb decimal(32,4)"
    )
    return frame(ddl, *[(d, d.isoformat(), u, lv, 1, 10, int(m > 0), Decimal(m), Decimal(m), Decimal(0)) for d, u, lv, m in rows])


def _info(frame, *rows):
    ddl = "role_id string, install_date date, firstpay_date date, zone_id string, channel string, os string, vip_level bigint, moneyrmb_ac decimal(32,4), is_test int"
    return frame(ddl, *rows)


def test_kpi_daily_grid_flags_and_history(frame):
    daily = _daily(frame, (D1, "a", 3, 5), (D2, "a", 4, 0), (D2, "b", 9, 2), (D2, "t", 9, 100), (D2, "lost", 1, 7), (D2, "b", 9, 0))
    info = _info(
        frame, ("a", D1, D1, "1", "c", "ios", 1, Decimal(5), None), ("b", D2, D2, "1", "c", "ios", 1, Decimal(2), None),
        ("t", D2, D2, "1", "c", "ios", 1, Decimal(100), 1),
    )
    derive = upstream.user_daily_derive(daily.dropDuplicates(["role_id", "part_date"]))
    window = RunWindow("2024-01-01", "2024-01-03")
    report = kpi.kpi_daily(daily, derive, info, window)
    cols = ("date", "zone_id", "new_users", "active_users", "pay_users", "install_pay", "newpay_users", "money_rmb", "newuser_ac")
    got = rows_of(report, *cols)
    day3 = date(2024, 1, 3)
    assert got == [
        (D1, None, None, None, None, None, None, None, None), (D1, "1", 1, 1, 1, 1, 1, Decimal("5.0000"), 1),
        (D2, None, None, None, None, None, None, None, None), (D2, "1", 1, 2, 1, 1, 1, Decimal("2.0000"), 2),
        (day3, None, None, None, None, None, None, None, None), (day3, "1", None, None, None, None, None, None, 2),
    ]
    history = frame("zone_id string, channel string, os string, newuser_ac bigint, part_date string", ("1", "c", "ios", 40, "2023-12-30"), ("1", "c", "ios", 41, "2023-12-31"), ("1", "c", "ios", 99, "2024-01-01"))
    carried = rows_of(kpi.kpi_daily(daily, derive, info, window, history), "date", "zone_id", "newuser_ac")
    assert [r for r in carried if r[1] == "1"] == [(D1, "1", 42), (D2, "1", 43), (day3, "1", 43)]


def test_kpi_intraday_previous_day_and_paid_sum(frame):
    hourly = frame(
        "date date, part_date string, hour timestamp_ntz, role_id string, money_rmb decimal(32,4)",
        (D1, "2024-01-01", NOON, "a", Decimal(5)), (D1, "2024-01-01", NOON + timedelta(hours=1), "a", Decimal(1)),
        (D2, "2024-01-02", NOON + timedelta(days=1), "a", Decimal(0)), (D2, "2024-01-02", NOON + timedelta(days=1), "b", Decimal(0)),
    )
    derive = frame("date date, role_id string, is_paid int", (D1, "a", 1), (D2, "a", 1), (D2, "b", 0))
    info = _info(frame, ("a", D1, D1, "1", "c", "ios", 1, Decimal(6), None), ("b", D2, None, "2", "c", "ios", 1, Decimal(0), None))
    report = kpi.kpi_daily_intraday(hourly, derive, info, RunWindow("2023-12-18", "2024-01-02"))
    cols = ("date", "zone_id", "active_users", "new_users", "retention1_newusers", "retention1_users", "paid_users", "firstdaypay_users", "money_rmb")
    assert rows_of(report, *cols) == [
        (D1, "1", 1, 1, None, 0, 1, 1, Decimal("6.0000")), (D1, "2", None, None, None, None, None, None, None),
        (D2, "1", 1, 0, 1, 1, 1, 0, Decimal("0.0000")), (D2, "2", 1, 1, None, 0, 0, 0, Decimal("0.0000")),
    ]


def test_kpi_monthly_grid_is_wider_than_the_combinations(frame):
    rows = [(date(2024, 1, 5), "a", 1, 3), (date(2024, 3, 5), "b", 1, 0)]
    info = _info(frame, ("a", date(2024, 1, 5), date(2024, 1, 5), "1", "c", "ios", 1, Decimal(3), None), ("b", date(2024, 3, 5), None, "2", "d", "ios", 1, Decimal(0), None))
    report = kpi.kpi_monthly(_daily(frame, *rows), info, RunWindow("2024-01-20", "2024-03-10"))
    assert report.count() == 2 * 2 * 2 * 1
    got = [r for r in rows_of(report, "month", "zone_id", "channel", "new_users", "new_users_ac", "moneyrmb_ac") if r[4] is not None]
    jan, mar = date(2024, 1, 1), date(2024, 3, 1)
    assert got == [(jan, "1", "c", 1, 1, Decimal("3.0000")), (mar, "1", "c", None, 1, Decimal("3.0000")), (mar, "2", "d", 1, 1, Decimal("0.0000"))]


def test_level_report_counts_lifetime_payers(frame):
    daily = _daily(frame, (D1, "a", 12, 5), (D1, "b", 12, 0), (D1, "z", 3, 0))
    info = _info(frame, ("a", D1, D1, "1", "c", "ios", 1, Decimal(5), None), ("b", D1, D1, "1", "c", "ios", 1, Decimal(8), None))
    got = rows_of(distribution.level_daily(daily, info, RunWindow("2024-01-01", "2024-01-01")), "zone_id", "level_max_daily", "level_hist", "users", "pay_users", "paid_users")
    assert got == [(None, 3, "[0,5)", 1, 0, 0), ("1", 12, "[10,15)", 2, 1, 2)]


def test_item_end_keeps_days_or_only_the_latest(frame):
    items = frame(
        BASE + ", item_detail array<struct<item_id:string,item_add:bigint,item_cost:bigint,item_end:bigint>>",
        ("2024-01-01", D1, "a", [("13005", 1, 1, 5), ("135", 1, 1, 1), ("99", 1, 1, 1), ("1300000", 1, 1, 2)]),
        ("2024-01-02", D1, "a", [("13005", 1, 1, 6)]), ("2024-01-02", D2, "a", [("13005", 1, 1, None)]), ("2024-01-03", D2, "a", None),
    )
    got = rows_of(holdings.item_end(items, GAME), "item_id", "item_end")
    assert got == [("1300000", 2), ("13005", None), ("13005", 6), ("13005", 6), ("135", 1)]
    latest = rows_of(holdings.item_end(items, GAME, latest_only=True), "item_id", "item_end")
    assert latest == [("1300000", 2), ("13005", None), ("135", 1)]


def test_core_snapshot_without_gains_has_an_empty_map(frame):
    log = frame(
        "part_date string, date date, event_time timestamp_ntz, role_id string, event_type string, reason string, free_num bigint, paid_num bigint, core_end bigint",
        ("2024-01-01", D1, NOON, "a", "cost", "1", 3, None, 7), ("2024-01-01", D1, NOON, "a", "cost", "638", 9, 9, 1),
        ("2024-01-01", D1, NOON, "a", "cost", None, 9, 9, 1), ("2024-01-01", D1, NOON, "b", "gain", "2", None, None, None),
    )
    core = upstream.core_snapshot(log, GAME)
    got = {r.role_id: (r.coregain_detail, r.corecost_detail, r.core_end) for r in core.collect()}
    assert got == {"a": ({}, {"1": 3}, 7), "b": ({"2": 0}, {}, None)}
    info = _info(frame, ("a", D1, None, "1", "c", "ios", 1, Decimal(0), None))
    report = distribution.core_daily(core, info, RunWindow("2024-01-01", "2024-01-01"))
    assert rows_of(report, "zone_id", "core_add", "core_cost", "core_end", "users", "users_add", "users_cost") == [
        (None, 0, 0, None, 1, 0, 0), ("1", 0, 3, 7, 1, 0, 1),
    ]


def test_user_daily_keeps_payments_without_activity(frame):
    base = frame(
        BASE + ", event_time timestamp_ntz, zone_id string, channel string, os string, level bigint, vip_level bigint, online_time bigint",
        ("2024-01-01", D1, "a", NOON, "1", "x", "ios", 3, 0, 5), ("2024-01-01", D1, "a", NOON + timedelta(hours=1), "2", None, "ios", 4, 1, 6),
    )
    pay = frame(
        BASE + ", event_time timestamp_ntz, payment_itemid string, level bigint, money decimal(32,4), money_rmb decimal(32,4), web_rmb decimal(32,4), exchange_rate decimal(12,6)",
        ("2024-01-01", D1, "a", NOON, "p2", 3, Decimal(5), Decimal(1), None, Decimal("0.2")),
        ("2024-01-01", D1, "a", NOON, "p1", 3, Decimal(5), Decimal(1), Decimal(1), Decimal("0.2")),
        ("2024-01-01", D1, "p", NOON, "p9", 1, Decimal(7), Decimal(2), None, Decimal("0.3")),
    )
    daily = upstream.user_daily(base, pay, frame("role_id string", ("p",)))
    got = rows_of(daily, "role_id", "zone_id", "channel", "level_max", "online_time", "pay_count", "money", "web_rmb", "is_test")
    assert got == [
        ("a", "2", None, 4, 11, 2, Decimal("10.0000"), Decimal("1.0000"), None),
        ("p", None, None, None, None, 1, Decimal("7.0000"), Decimal("0.0000"), 1),
    ]
    info = {r.role_id: (r.firstpay_goodid, r.firstpay_date, r.moneyrmb_ac, r.is_test) for r in upstream.user_info(daily).collect()}
    assert info == {"a": ("p1", D1, Decimal("2.0000"), None), "p": ("p9", D1, Decimal("2.0000"), 1)}


def test_retention_counts_pairs_of_active_days(frame):
    random.seed(5)
    days = [D1 + timedelta(days=i) for i in range(12)]
    active = {u: sorted(d for d in days if random.random() < 0.5) for u in "abcdefghij"}
    daily = frame("date date, part_date string, role_id string", *[(d, d.isoformat(), u) for u, ds in active.items() for d in ds])
    info = frame("role_id string, install_date date, is_test int", *[(u, ds[0] if ds else None, None) for u, ds in active.items()])
    want = defaultdict(int)
    for ds in active.values():
        for i, d in enumerate(ds):
            for later in ds[i:]:
                want[(d.isoformat(), (later - d).days)] += 1
    got = {(r.part_date, r.retention_day): r.dau for r in upstream.retention_daily(daily, info).collect()}
    assert got == dict(want)
    window = RunWindow("2024-01-03", "2024-01-05")
    part = {(r.part_date, r.retention_day): r.dau for r in upstream.retention_daily(daily, info, window).collect()}
    assert part == {k: n for k, n in want.items() if "2024-01-03" <= k[0] <= "2024-01-05"}


def _month(d):
    return d.replace(day=1)


def _months(first, last):
    while first <= last:
        yield first
        first = (first + timedelta(days=32)).replace(day=1)


def _ledger_by_hand(payments, tokens, as_of):
    """The ledger from its definition: every user carried through every month."""
    pay_day, tok_day, newest = defaultdict(lambda: [Decimal(0), None]), defaultdict(lambda: [None, None]), {}
    for u, d, money, n in payments:
        pay_day[u, d][0] += money
        if n is not None:
            pay_day[u, d][1] = (pay_day[u, d][1] or 0) + n
    for u, d, kind, n, end in tokens:
        i = 0 if kind == "gain" else 1
        tok_day[u, d][i] = (tok_day[u, d][i] or 0) + n
        if (u, d) not in newest or newest[u, d] is None or (end is not None and end < newest[u, d]):
            newest[u, d] = end
    flows, balance = defaultdict(lambda: [Decimal(0), None, None, None]), {}
    for (u, d), (money, n) in sorted(pay_day.items()):
        gain, cost = tok_day[u, d] if (u, d) in tok_day else (None, None)
        f = flows[u, _month(d)]
        f[0] += money
        for i, v in ((1, n), (2, gain), (3, cost)):
            if v is not None:
                f[i] = (f[i] or 0) + v
        balance[u, _month(d)] = newest.get((u, d))
    out = {}
    for u, first in {u: min(m for v, m in balance if v == u) for u, _ in balance}.items():
        held = None
        for m in _months(first, _month(as_of)):
            held = balance[u, m] if (u, m) in balance else held
            row = out.setdefault(m, dict(users=0, pay=0, tok=0, money=None, by_pay=None, get=None, cost=None, remain=None))
            row["users"] += 1
            if held is not None:
                row["remain"] = (row["remain"] or 0) + held
            if (u, m) in flows:
                money, n, gain, cost = flows[u, m]
                row["pay"] += money > 0
                row["tok"] += (gain or 0) > 0 or (cost or 0) > 0
                for k, v in (("money", money), ("by_pay", n), ("get", gain), ("cost", cost)):
                    if v is not None:
                        row[k] = (row[k] or 0) + v
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_ledger_equals_its_definition(frame, seed):
    random.seed(seed)
    as_of, start = date(2024, 12, 10), date(2024, 5, 1)
    span = (as_of - start).days
    users = [f"u{i}" for i in range(8)]
    pay, tok = [], []
    for _ in range(40):
        u, d = random.choice(users), start + timedelta(days=random.randrange(0, span, 9))
        item = random.choice(["gold_100001", "gold_100006", "pkg;25", "pkg", "other"])
        pay.append((u, d, item, "web" if item.startswith("pkg") else "app", Decimal(random.randrange(0, 5000))))
    for _ in range(120):
        u, d = random.choice(users), start + timedelta(days=random.randrange(0, span, 9))
        tok.append((u, d, random.choice(["gain", "cost"]), random.randrange(1, 50), random.choice([None, 3, 40, 500]), random.choice(["2", "2", "9"]), random.choice(["1", "638", None])))
    stamp = lambda d: datetime(d.year, d.month, d.day)
    payments = frame(
        BASE + ", event_time timestamp_ntz, payment_itemid string, pay_source string, money decimal(32,4)",
        *[(d.isoformat(), d, u, stamp(d), item, src, m) for u, d, item, src, m in pay],
    )
    log = frame(
        BASE + ", event_time timestamp_ntz, event_type string, item_num bigint, item_end bigint, item_id string, reason string",
        *[(d.isoformat(), d, u, stamp(d), k, n, e, i, r) for u, d, k, n, e, i, r in tok],
    )
    rates = frame("currency_time string, exchange_rate decimal(12,6)", *[(m.isoformat()[:7], Decimal("4.9")) for m in _months(start, as_of)])
    got = {r.cal_month: r for r in ledger.token_monthly(payments, log, rates, GAME, as_of.isoformat()).collect()}

    tokens_of = {**dict(GAME.token_packs), "pkg;25": 25, "pkg": None}
    sold = [(u, d, m * Decimal("0.049"), tokens_of[item]) for u, d, item, _s, m in pay if item != "other"]
    kept = [(u, d, k, n, e) for u, d, k, n, e, i, r in tok if i == "2" and r == "1"]
    want = _ledger_by_hand(sold, kept, as_of)
    assert sorted(got) == sorted(want)
    before = None
    for m in sorted(want):
        w, g = want[m], got[m]
        assert (g.users, g.pay_users, g.token_users) == (w["users"], w["pay"], w["tok"])
        assert (g.money_rmb, g.token_get_by_pay, g.token_get, g.token_cost, g.token_remain) == (w["money"], w["by_pay"], w["get"], w["cost"], w["remain"])
        last = want[before]["remain"] if before else None
        assert g.token_remain_lastmonth == last
        opening = 0 if before is None else last
        if w["get"] is None or w["money"] is None or opening is None or w["get"] + opening == 0:
            assert g.price is None
        else:
            assert abs(g.price - w["money"] / (w["get"] + opening)) <= Decimal("0.00005")
        before = m
