from __future__ import annotations

import random
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from rolemart.operators.compare import difference_by_key, difference_of_totals, duplicates
from rolemart.operators.details import (
    active_spine, attach_details, collect_details, explode_details, latest_non_null, newest_row_value,
)
from rolemart.operators.grids import axis_grid, fill_days, running_total
from rolemart.operators.lookups import join_lookup
from rolemart.operators.months import carry_forward, with_previous_month
from rolemart.operators.users import mark_test_users, user_metrics, with_user_attrs, without_test_accounts
from rolemart.session import settle
from tests.conftest import rows_of

T = datetime(2024, 1, 1, 12)


def test_latest_value_breaks_ties_and_skips_nulls(frame):
    later = T + timedelta(seconds=1)
    df = frame(
        "k int, t timestamp_ntz, v bigint",
        (1, T, 5), (1, T, 9), (1, later, None), (2, T, None), (3, later, 1), (3, T, 8),
    )
    assert rows_of(df.groupBy("k").agg(latest_non_null("v", "t", "v").alias("v"))) == [(1, 9), (2, None), (3, 1)]


def test_newest_row_prefers_small_value_then_null_last(frame):
    later = T + timedelta(seconds=1)
    df = frame("k int, t timestamp_ntz, v bigint", (1, T, 1), (1, later, 9), (1, later, 7), (1, later, None), (2, T, 4), (2, later, None))
    assert rows_of(df.groupBy("k").agg(newest_row_value("v", "t").alias("v"))) == [(1, 7), (2, None)]


def test_snapshot_keeps_users_without_details_and_late_days(frame):
    log = frame(
        "part_date string, date date, role_id string",
        ("2024-01-02", date(2024, 1, 2), "a"), ("2024-01-02", date(2024, 1, 1), "a"), ("2024-01-02", date(2024, 1, 2), "b"),
        ("2024-01-02", date(2024, 1, 2), "b"),
    )
    rows = frame("role_id string, part_date string, item string, n bigint", ("a", "2024-01-02", "y", 2), ("a", "2024-01-02", "x", None), ("z", "2024-01-02", "x", 1))
    snap = attach_details(active_spine(log), collect_details(rows, ["item", "n"], "d"))
    got = {(r.role_id, r.date): r.d and [tuple(x) for x in r.d] for r in snap.collect()}
    pair = [("x", None), ("y", 2)]
    assert got == {("a", date(2024, 1, 2)): pair, ("a", date(2024, 1, 1)): pair, ("b", date(2024, 1, 2)): None}
    assert explode_details(snap, "d", ["role_id"]).count() == 4


def test_test_users_dropped_unmatched_users_kept(frame):
    fact = frame("role_id string, n int", ("a", 1), ("b", 2), ("c", 3), (None, 4))
    info = frame("role_id string, zone_id string, is_test int", ("a", "1", None), ("b", "1", 1))
    assert rows_of(with_user_attrs(fact, info, ["zone_id"])) == [(None, 4, None), ("a", 1, "1"), ("c", 3, None)]


def test_marking_and_removing_listed_accounts(frame):
    fact = frame("role_id string", ("a",), ("b",), (None,))
    listed = frame("role_id string", ("b",), ("b",))
    assert rows_of(mark_test_users(fact, listed)) == [(None, None), ("a", None), ("b", 1)]
    assert rows_of(without_test_accounts(fact, listed)) == [(None,), ("a",)]


def test_user_metrics_equal_distinct_counts(frame):
    random.seed(3)
    data = [
        (random.choice(["x", "y", None]), random.choice([None, *"abcdefgh"]), random.choice([None, 0, 1, 5]))
        for _ in range(400)
    ]
    df = frame("dim string, role_id string, v bigint", *data)
    got = user_metrics(df, ["dim"], {"users": None, "some": F.col("v") > 0}, {"v": F.col("v"), "n": F.lit(1)})
    want = df.groupBy("dim").agg(
        F.countDistinct("role_id").alias("users"),
        F.countDistinct(F.when(F.col("v") > 0, F.col("role_id"))).alias("some"),
        F.sum("v").alias("v"), F.count(F.lit(1)).alias("n"),
    )
    assert rows_of(got, "dim", "users", "some", "v", "n") == rows_of(want, "dim", "users", "some", "v", "n")


def test_fill_days_equals_grid_join(spark, frame):
    random.seed(11)
    days = [date(2023, 12, 28) + timedelta(days=i) for i in range(14)]
    data = []
    for zone in ("a", "b", "c", None):
        for channel in ("p", None):
            data += [(d, zone, channel, random.randint(0, 9)) for d in days if random.random() < 0.4]
    data += [(date(2024, 1, 3), "a", "p", 77), (date(2024, 1, 3), "a", "p", 78)]  # two partition days of one event day
    data = list(dict.fromkeys(data))
    df = frame("date date, zone string, channel string, v int", *data)
    got = fill_days(df, ["zone", "channel"], ["v"], "2024-01-01", "2024-01-07")
    combos = {(z, c) for _, z, c, _ in data}
    want = []
    for i in range(7):
        day = date(2024, 1, 1) + timedelta(days=i)
        for z, c in combos:
            hits = [v for d, zz, cc, v in data if d == day and (zz, cc) == (z, c) and z is not None and c is not None]
            want += [(day, z, c, v) for v in hits or [None]]
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    assert rows_of(got, "date", "zone", "channel", "v") == sorted(want, key=key)


def test_axis_grid_keeps_null_members(frame):
    df = settle(frame("m int, z string, c string", (1, "a", None), (2, "b", "p")))
    grid = axis_grid(df.select("z").distinct(), df, ["m", "c"])
    assert grid.count() == 8
    assert {(r.z, r.m, r.c) for r in grid.collect()} == {(z, m, c) for z in "ab" for m in (1, 2) for c in (None, "p")}


def test_running_total_passes_over_nulls(frame):
    df = frame("z string, d int, v int", ("a", 1, None), ("a", 2, 3), ("a", 3, None), ("a", 4, 4), (None, 1, None))
    got = rows_of(df.select("z", "d", running_total("v", ["z"], "d").alias("s")))
    assert got == [(None, 1, None), ("a", 1, None), ("a", 2, 3), ("a", 3, 3), ("a", 4, 7)]


def test_carry_forward_fills_gaps_with_last_row(frame):
    m = lambda i: date(2024, i, 1)
    df = frame("role_id string, month date, v int", ("a", m(1), 5), ("a", m(3), None), ("b", m(4), 1))
    got = rows_of(carry_forward(df, F.lit("2024-05-01").cast("date")), "role_id", "cal_month", "v")
    assert got == [("a", m(1), 5), ("a", m(2), 5), ("a", m(3), None), ("a", m(4), None), ("a", m(5), None), ("b", m(4), 1), ("b", m(5), 1)]


def test_previous_month_null_neighbour_stays_null(frame):
    df = frame("m date, v bigint", (date(2024, 1, 1), None), (date(2024, 2, 1), 4), (date(2024, 3, 1), 6))
    got = rows_of(with_previous_month(df, "m", "v", "before"), "m", "v", "before", "has_previous")
    assert got == [(date(2024, 1, 1), None, None, False), (date(2024, 2, 1), 4, None, True), (date(2024, 3, 1), 6, 4, True)]


def test_lookup_beyond_the_bound_is_not_broadcast(spark, frame):
    log, lookup = frame("k int, v int", (1, 10), (2, 20), (3, 30)), frame("k int, w int", (1, 7), (2, 8))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small, large = join_lookup(log, lookup, ["k"], max_rows=2), join_lookup(log, lookup, ["k"], max_rows=1)
        assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in large._jdf.queryExecution().executedPlan().toString()
        assert rows_of(small) == rows_of(large) == [(1, 10, 7), (2, 20, 8), (3, 30, None)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_comparisons(frame):
    left, right = frame("k int, value int", (1, 5), (2, None), (3, 4)), frame("k int, value int", (1, 5), (3, 9), (4, 1))
    assert rows_of(difference_by_key(left, right, ["k"], "value")) == [(1, 5, 5, 0), (2, None, None, 0), (3, 4, 9, 5)]
    assert rows_of(difference_by_key(left, right, ["k"], "value", signed=True, only_mismatch=True)) == [(3, 4, 9, -5)]
    assert rows_of(difference_by_key(left, right, ["k"], "value", how="full", only_mismatch=True)) == [(3, 4, 9, 5), (4, None, 1, 1)]
    assert rows_of(difference_by_key(left, right, ["k"], "value", missing_is_zero=False)) == [(1, 5, 5, 0), (2, None, None, None), (3, 4, 9, 5)]
    totals = difference_of_totals(left.agg(F.sum("value").alias("value")), right.agg(F.sum("value").alias("value")), "value")
    assert rows_of(totals) == [(9, 15, 6)]
    assert rows_of(duplicates(frame("k int", (1,), (1,), (2,)), ["k"])) == [(1, 2)]
