from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rolemart.config import RunWindow
from rolemart.functions import dates, money, nested, text
from tests.conftest import rows_of


def test_part_of_missing_is_null(frame):
    df = frame("s string", ("pkg;12",), ("pkg",), ("a;;b",), (None,))
    got = {r.s: r.p for r in df.select("s", text.part_of(F.col("s"), ";", 2).alias("p")).collect()}
    assert got == {"pkg;12": "12", "pkg": None, "a;;b": "", None: None}


def test_digit_at(frame):
    df = frame("c int", (105,), (17,), (None,))
    got = {r.c: r.d for r in df.select("c", text.digit_at(F.col("c"), 3).alias("d")).collect()}
    assert got == {105: 5, 17: None, None: None}


def test_bucket_truncates_whole_numbers(frame):
    df = frame("lv bigint", (0,), (4,), (5,), (7,), (None,))
    floor = text.bucket_floor(F.col("lv"), 5)
    got = {r.lv: (r.f, r.l) for r in df.select("lv", floor.alias("f"), text.bucket_label(floor, 5).alias("l")).collect()}
    assert got == {0: (0, "[0,5)"), 4: (0, "[0,5)"), 5: (5, "[5,10)"), 7: (5, "[5,10)"), None: (None, None)}


def test_day_and_month_differences(frame):
    df = frame("a date, b date", (date(2024, 1, 31), date(2024, 3, 1)), (date(2024, 3, 1), date(2023, 12, 31)))
    got = rows_of(df.select(dates.days_between(F.col("a"), F.col("b")), dates.months_between(F.col("a"), F.col("b"))))
    assert sorted(got) == [(-61, -3), (30, 2)]


def test_hour_ignores_session_zone(spark, frame):
    df = frame("t timestamp_ntz", (datetime(2024, 3, 10, 2, 30, 5),))
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # 02:30 does not exist there that day
    try:
        row = df.select(dates.hour_of(F.col("t")), dates.day_text(F.col("t")), dates.month_text(F.col("t"))).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert tuple(row) == (datetime(2024, 3, 10, 2), "2024-03-10", "2024-03")


def test_reversed_ranges_are_empty(frame):
    df = frame("a date, b date", (date(2024, 2, 1), date(2024, 1, 1)))
    row = df.select(dates.days_from_to(F.col("a"), F.col("b")), dates.months_from_to(F.col("a"), F.col("b"))).first()
    assert tuple(row) == ([], [])


def test_currency_conversion_rounds_once(frame):
    df = frame("m decimal(32,4), r decimal(12,6)", (Decimal("100.0001"), Decimal("4.905000")), (None, Decimal("1")))
    got = [r[0] for r in df.select(money.minor_to_home(F.col("m"), F.col("r"))).collect()]
    assert got == [Decimal("4.9050"), None]


def test_unit_price_of_zero_units_is_null(frame):
    df = frame("m decimal(32,4), u bigint", (Decimal("10.0000"), 0), (Decimal("10.0000"), 3))
    assert [r[0] for r in df.select(money.unit_price(F.col("m"), F.col("u"))).collect()] == [None, Decimal("3.3333")]


def test_rounded_long_rounds(frame):
    df = frame("m decimal(32,4)", (Decimal("2.5000"),), (Decimal("2.4999"),), (Decimal("-2.5000"),))
    assert [r[0] for r in df.select(money.rounded_long(F.col("m"))).collect()] == [3, 2, -3]


def test_map_total(frame):
    df = frame("j string", ('{"a":1,"b":2}',), ("{}",), (None,), ('{"a":null}',))
    got = [r[0] for r in df.select(nested.map_total(nested.amounts_from_json(F.col("j")))).collect()]
    assert got == [3, 0, None, None]


def test_json_round_trip_keeps_null_members(frame):
    df = frame("id string, n bigint", ("x", None))
    ddl = "id string, n bigint"
    written = df.select(F.array(nested.json_text(F.struct("id", "n"))).alias("d"))
    assert written.first()[0] == ['{"id":"x","n":null}']
    assert written.select(nested.json_rows(F.col("d"), ddl).alias("d")).first()[0][0].asDict() == {"id": "x", "n": None}


def test_zipped_pads_short_and_missing_arrays(frame):
    df = frame("k int, a array<int>, b array<int>", (1, [1, 2], [9]), (2, None, [7]), (3, None, None), (4, [], [5]))
    got = rows_of(df.select("k", F.inline(nested.zipped(F.col("a"), F.col("b")))))
    assert got == [(1, 1, 9), (1, 2, None), (2, None, 7), (4, None, 5)]


def test_windows():
    window = RunWindow("2024-02-10", "2024-03-05")
    assert window.whole_months() == RunWindow("2024-02-01", "2024-03-31")
    assert RunWindow.trailing("2024-01-30", 15) == RunWindow("2024-01-15", "2024-01-30")
    with pytest.raises(ValueError):
        RunWindow("2024-02-10", "2024-02-09")
