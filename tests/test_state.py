"""Merged state over days: runs in any order, reruns and lost runs give what one run over everything gives."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rolemart.config import Game, RunWindow
from rolemart.plans import actives, checks, holdings, ledger, upstream
from rolemart.plans.state import Checkpoints
from rolemart.plans.warehouse import Warehouse
from tests.conftest import rows_of
from tests.test_warehouse import LATE_BASE, LATE_PAY

ALL = RunWindow("2024-01-01", "2024-01-12")
EARLY, MIDDLE, LAST = RunWindow("2024-01-01", "2024-01-04"), RunWindow("2024-01-05", "2024-01-08"), RunWindow("2024-01-09", "2024-01-12")
MODELS = ("dws_user_daily", "dws_user_info", "dws_user_daily_derive")


def _events(seed):
    rng, seen, paid = random.Random(seed), [], []
    for n in range(12):
        day = date(2024, 1, 1) + timedelta(days=n)
        for user in range(9):
            part = day + timedelta(days=rng.random() < 0.2)
            if part > date(2024, 1, 12):
                continue
            if rng.random() < 0.5:
                seen.append((f"u{user}", datetime(2024, 1, 1 + n, rng.randrange(24)), day, part.isoformat(), str(rng.randrange(3)), "c", "ios", rng.randrange(9), 0, 5))
            if rng.random() < 0.3:
                money = Decimal(rng.randrange(1, 9))
                paid.append((f"u{user}", datetime(2024, 1, 1 + n, rng.randrange(24)), day, part.isoformat(), "x", money, money, None, Decimal("1"), 1))
    return seen, paid


def _raw(frame, wh, seen, paid):
    raw = wh.path("dws_user_daily").rsplit("/", 2)[0] + f"/{wh.game.raw_schema}"
    for name, ddl, rows in (("base_log", LATE_BASE, seen), ("payment_log", LATE_PAY, paid)):
        frame(ddl, *rows).write.mode("overwrite").partitionBy("part_date").parquet(f"{raw}/{name}")
    frame("role_id string").write.mode("overwrite").parquet(f"{raw}/test_accounts")


def _run(wh, *windows):
    for window in windows:
        for model in MODELS:
            wh.refresh(model, window)
    return {m: rows_of(wh.table(m).drop("days")) for m in MODELS}


def test_runs_in_any_order_equal_one_run(spark, frame, tmp_path):
    seen, paid = _events(1)
    found = []
    for n, windows in enumerate([(ALL,), (EARLY, MIDDLE, LAST), (EARLY, MIDDLE, LAST, MIDDLE, EARLY), (MIDDLE, LAST, EARLY)]):
        wh = Warehouse(spark, str(tmp_path / str(n)), Game("g"))
        _raw(frame, wh, seen, paid)
        found.append(_run(wh, *windows))
    assert found[0] == found[1] == found[2] == found[3] and len(found[0]["dws_user_info"]) == 9


def test_rerun_of_a_middle_range_with_other_rows_repairs_all_later_days(spark, frame, tmp_path):
    """Users of the range change, come and go; later days follow, and check 6.3 finds nothing."""
    (seen, paid), (other_seen, other_paid) = _events(2), _events(3)

    def mixed(old, new):
        inside = lambda r: MIDDLE.start_date <= r[3] <= MIDDLE.end_date
        return [r for r in old if not inside(r)] + [r for r in new if inside(r)]

    wh, fresh = Warehouse(spark, str(tmp_path / "rerun"), Game("g")), Warehouse(spark, str(tmp_path / "fresh"), Game("g"))
    _raw(frame, wh, seen, paid)
    before = _run(wh, EARLY, MIDDLE, LAST)
    for target in (wh, fresh):
        _raw(frame, target, mixed(seen, other_seen), mixed(paid, other_paid))
    again = _run(wh, MIDDLE)
    assert again == _run(fresh, ALL) and again["dws_user_daily_derive"] != before["dws_user_daily_derive"]
    assert checks.derive_running_total(wh.table("dws_user_daily"), wh.table("dws_user_daily_derive"), "2024-01-13").collect() == []


def test_a_run_reads_the_days_since_the_checkpoint_only(spark, frame, tmp_path):
    wh = Warehouse(spark, str(tmp_path), Game("g"))
    _raw(frame, wh, *_events(4))
    _run(wh, EARLY, MIDDLE)
    users = wh.state("dws_user_info")
    assert users.days() == [EARLY.end_date, MIDDLE.end_date]
    plan = users.before(wh.table("dws_user_daily"), LAST.start_date)._jdf.queryExecution().executedPlan().toString()
    assert f"(part_date" in plan and f"> {MIDDLE.end_date}" in plan and f"< {LAST.start_date}" in plan


def test_a_checkpoint_that_was_not_completed_counts_as_absent(spark, frame, tmp_path):
    rows = frame("role_id string, hero_id string, start_date date, part_date string", ("u", "1", date(2024, 1, 1), "2024-01-01"), ("u", "1", date(2023, 1, 1), "2024-01-02"))
    spec = holdings.Mergeable(("hero_id",), lambda r: r.groupBy("hero_id").agg(F.min("start_date").alias("start_date")), {"start_date": "min"})
    state = Checkpoints(spark, str(tmp_path / "s"), spec, kept=2)
    spec.partial(rows.limit(0)).write.parquet(f"{tmp_path}/s/as_of=2024-01-01")
    (tmp_path / "s/as_of=2024-01-01/_SUCCESS").unlink()
    assert state.days() == []
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        got = state.advance(rows, RunWindow(day, day)).collect()
        assert [(r["hero_id"], str(r["start_date"])) for r in got] == [("1", "2023-01-01")]
    assert state.days() == ["2024-01-02", "2024-01-03"]
    state.forget("2024-01-03")
    assert state.days() == ["2024-01-02"]
    state.forget("2024-01-01")
    assert state.days() == []


@pytest.mark.parametrize("spec, rows", [
    (holdings.HEROES, [("u", [("1", 3, 2, None)], "2024-01-01"), ("u", [("1", 1, 5, None), ("2", None, 1, 9)], "2024-01-02")]),
])
def test_best_states_merge_over_days(spark, frame, tmp_path, spec, rows):
    snapshots = frame("role_id string, hero_detail array<struct<hero_id:string,hero_level:bigint,hero_star:bigint,chip_cost:bigint>>, part_date string", *rows)
    state = Checkpoints(spark, str(tmp_path / "heroes"), spec)
    for day in ("2024-01-01", "2024-01-02"):
        got = state.advance(snapshots.where(F.col("part_date") <= day), RunWindow(day, day))
    assert rows_of(got) == rows_of(holdings.hero_best(snapshots))


def test_users_of_no_days(spark, frame):
    empty = frame("role_id string, date date, part_date string, login_ts timestamp_ntz, money_rmb decimal(32,4), pay_first struct<pay_ts:timestamp_ntz,good_id:string,level:bigint>, zone_id string, channel string, os string, viplevel_max bigint, is_test int")
    assert upstream.user_info(empty).collect() == []


# ---- retention on day bits


def _retention(wh, *windows):
    for window in windows:
        for model in ("dws_user_daily", "dws_user_info", "ads_retention_daily"):
            wh.refresh(model, window)
    return rows_of(wh.table("ads_retention_daily"))


def test_retention_of_several_runs_equals_one_run(spark, frame, tmp_path):
    seen, paid = _events(5)
    found = []
    for n, windows in enumerate([(ALL,), (EARLY, MIDDLE, LAST), (MIDDLE, LAST, EARLY), (EARLY, MIDDLE, LAST, MIDDLE)]):
        wh = Warehouse(spark, str(tmp_path / str(n)), Game("g"))
        _raw(frame, wh, seen, paid)
        found.append(_retention(wh, *windows))
    assert found[0] == found[1] == found[2] == found[3]
    whole = upstream.retention_daily(wh.table("dws_user_daily"), wh.table("dws_user_info"))
    assert found[0] == rows_of(whole.select(*wh.table("ads_retention_daily").columns))


def test_retention_follows_a_rerun_of_other_rows(spark, frame, tmp_path):
    """Users leave and enter days in the middle, and one day loses all its rows."""
    (seen, paid), (other, _) = _events(6), _events(7)
    inside = lambda r: MIDDLE.start_date <= r[3] <= MIDDLE.end_date
    changed = [r for r in seen if not inside(r)] + [r for r in other if inside(r) and r[3] != "2024-01-06"]
    left = [r for r in paid if not inside(r)]
    wh, fresh = Warehouse(spark, str(tmp_path / "rerun"), Game("g")), Warehouse(spark, str(tmp_path / "fresh"), Game("g"))
    _raw(frame, wh, seen, paid)
    before = _retention(wh, EARLY, MIDDLE, LAST)
    for target in (wh, fresh):
        _raw(frame, target, changed, left)
    again = _retention(wh, MIDDLE)
    assert again == _retention(fresh, ALL) and again != before and "2024-01-06" not in {r[2] for r in again}


def test_retention_over_groups_words_and_days_before_1970(frame):
    rng = random.Random(8)
    first = date(1969, 11, 20)
    active = {u: sorted({first + timedelta(days=rng.randrange(150)) for _ in range(40)}) for u in "abcde"}
    daily = frame("part_date string, role_id string", *[(d.isoformat(), u) for u, ds in active.items() for d in ds], (None, "a"), ("1970-01-01", None))
    info = frame("role_id string, is_test int", ("e", 1))
    want = {}
    for u, ds in active.items():
        for n, d in enumerate(ds):
            for later in ds[n:]:
                if u != "e":
                    want[d.isoformat(), (later - d).days] = want.get((d.isoformat(), (later - d).days), 0) + 1
    assert {(r.part_date, r.retention_day): r.dau for r in upstream.retention_daily(daily, info).collect()} == want
    window = RunWindow("1969-12-30", "1970-01-09")
    near = {k: n for k, n in want.items() if any(window.start_date <= d <= window.end_date for d in (k[0], (date.fromisoformat(k[0]) + timedelta(days=k[1])).isoformat()))}
    words = upstream.ACTIVE_DAYS.partial(daily)
    assert {(r.part_date, r.retention_day): r.dau for r in upstream.retention_of(words, info, window).collect()} == near


# ---- the ledger from closed months

LEDGER_LOG = "part_date string, date date, role_id string, event_time timestamp_ntz"
PAY = LEDGER_LOG + ", payment_itemid string, pay_source string, money decimal(32,4)"
TOKEN = LEDGER_LOG + ", event_type string, item_num bigint, item_end bigint, item_id string, reason string"
FROM, LAST_OF = date(2023, 1, 1), date(2023, 12, 31)


def _ledger_logs(frame, seed):
    """A year of events, most on time, some up to 60 days late, a few with a wrong clock."""
    rng, pay, tok = random.Random(seed), [], []
    for n in range(260):
        day = FROM + timedelta(days=rng.randrange(0, 365, 5))
        part = day + timedelta(days=rng.choice([0, 0, 0, 1, 3, 40, 60, 63, 200, -3]))
        if not FROM <= part <= LAST_OF:
            continue
        at, user = datetime(day.year, day.month, day.day, rng.randrange(24)), rng.choice(["a", "b", "c", "d", "e", None])
        if n % 3 == 0:
            item = rng.choice(["gold_100001", "gold_100006", "pkg;25", "other"])
            pay.append((part.isoformat(), day, user, at, item, "web" if item.startswith("pkg") else "app", Decimal(rng.randrange(5000))))
        tok.append((part.isoformat(), day, user, at, rng.choice(["gain", "cost"]), rng.randrange(1, 50), rng.choice([None, 3, 40, 500]), "2", rng.choice(["1", "1", "638"])))
    months = [f"2023-{n:02d}" for n in range(1, 13)]
    return frame(PAY, *pay), frame(TOKEN, *tok), frame("currency_time string, exchange_rate decimal(12,6)", *[(m, Decimal("4.9")) for m in months])


@pytest.mark.parametrize("seed", [1, 2])
def test_ledger_month_by_month_equals_one_run(spark, frame, tmp_path, seed):
    payments, tokens, rates = (df.cache() for df in _ledger_logs(frame, seed))
    game, state = Game("g", ledger_start="2023-01-20"), Checkpoints(spark, str(tmp_path / "ledger"), None)
    ends = ["2023-03-31", "2023-06-10", "2023-06-30", "2023-10-31", "2023-12-31"]
    first = "2023-01-01"
    for end in ends:
        got = ledger.token_monthly_continued(payments, tokens, rates, game, RunWindow(first, end), state)
        assert rows_of(got) == rows_of(ledger.token_monthly(payments, tokens, rates, game, end))
        first = (date.fromisoformat(end) + timedelta(days=1)).isoformat()
    assert state.days() == ends[-4:] and state.newest("2024-01-01", ledger.CLOSED)[1].where("role_id IS NULL").count() >= 8
    # a rerun falls back behind its range
    again = ledger.token_monthly_continued(payments, tokens, rates, game, RunWindow("2023-06-20", "2023-12-31"), state)
    assert rows_of(again) == rows_of(got) and state.days() == ["2023-06-10", "2023-12-31"]


def test_ledger_reads_the_partitions_since_the_first_open_month(spark, frame, tmp_path):
    payments, tokens, rates = _ledger_logs(frame, 3)
    for name, log in (("p", payments), ("t", tokens)):
        log.write.partitionBy("part_date").parquet(str(tmp_path / name))
    read = [spark.read.schema(ddl).parquet(str(tmp_path / n)) for n, ddl in (("p", PAY), ("t", TOKEN))]
    assert ledger.open_since("2023-11-30") == "2023-09-01"
    months = ledger.paying_months(*read, rates, Game("g", ledger_start="2023-01-01"), ledger.open_since("2023-11-30"), "2023-12-31")
    plan = months._jdf.queryExecution().executedPlan().toString()
    assert plan.count(">= 2023-09-01") >= 2 and "2023-01-01" not in plan


# ---- distinct users from bitmaps


def test_bitmap_counts_equal_distinct_counts(frame):
    rng = random.Random(9)
    rows = [(f"2024-{m:02d}-{d:02d}", f"u{rng.randrange(60)}") for m in (1, 2, 3) for d in range(1, 28, 2) for _ in range(rng.randrange(9))]
    daily = frame("part_date string, role_id string", *rows, *rows[:5], ("2024-01-02", None))
    bitmaps = actives.day_bitmaps(daily, actives.number_users(daily, parts=4))
    months = {}
    for day, user in rows:
        months.setdefault(date.fromisoformat(day).replace(day=1), set()).add(user)
    assert {r.month: r.active_users for r in actives.monthly_users(bitmaps).collect()} == {m: len(u) for m, u in months.items()}
    want = {}
    for end in {d for d, _ in rows}:
        span = {(date.fromisoformat(end) - timedelta(days=n)).isoformat() for n in range(7)}
        want[end] = len({u for d, u in rows if d in span})
    assert {r.part_date: r.active_users for r in actives.trailing_users(bitmaps, 7).collect()} == want


def test_numbers_stay_with_their_users_and_are_dense(frame):
    some = frame("role_id string", *[(f"u{n}",) for n in range(40)], ("u1",), (None,))
    more = frame("role_id string", *[(f"u{n}",) for n in range(30, 90)])
    first = actives.number_users(some, parts=3)
    both = actives.number_users(more, first, parts=3)
    old, new = ({r.role_id: (r.part, r.nth) for r in df.collect()} for df in (first, both))
    assert len(old) == 40 and len(new) == 90 == len(set(new.values())) and all(new[u] == n for u, n in old.items())
    for part in range(3):
        assert sorted(n for p, n in new.values() if p == part) == list(range(1, 1 + sum(p == part for p, _ in new.values())))


def test_a_user_without_number_fails_the_bitmaps(frame):
    daily = frame("part_date string, role_id string", ("2024-01-01", "a"), ("2024-01-01", "b"))
    numbers = actives.number_users(daily.where("role_id = 'a'"))
    with pytest.raises(Exception, match="no number for user b"):
        actives.day_bitmaps(daily, numbers).collect()


def test_buckets_beyond_the_first_bitmap(spark):
    daily = spark.range(70_000).selectExpr("concat('u', id) AS role_id", "CASE WHEN id % 2 = 0 THEN '2024-01-01' ELSE '2024-01-02' END AS part_date")
    bitmaps = actives.day_bitmaps(daily, actives.number_users(daily, parts=1))
    assert bitmaps.where("part_date = '2024-01-01'").count() == 3
    assert {r.part_date: r.active_users for r in actives.trailing_users(bitmaps, 2).collect()} == {"2024-01-01": 35_000, "2024-01-02": 70_000}


def test_stored_bitmaps_over_runs(spark, frame, tmp_path):
    seen, paid = _events(11)
    counts = []
    for n, windows in enumerate([(ALL,), (MIDDLE, LAST, EARLY, MIDDLE)]):
        wh = Warehouse(spark, str(tmp_path / str(n)), Game("g"))
        _raw(frame, wh, seen, paid)
        for window in windows:
            for model in ("dws_user_daily", "dws_user_number", "dws_active_bitmap"):
                wh.refresh(model, window)
        counts.append(rows_of(actives.trailing_users(wh.table("dws_active_bitmap"), 5)))
    assert counts[0] == counts[1] and len(counts[0]) == 12
