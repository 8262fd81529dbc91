"""Raw logs of any shape: casts, missing columns, other names, clashing types on disk, rows set apart."""

from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from harness.logs import Logs
from rolemart.config import Game, RunWindow
from rolemart.plans.warehouse import Warehouse
from rolemart.sources.raw import RAW_LOGS, RawLog, accepted, read_shapes, set_apart
from tests.conftest import rows_of

SF_DIR = "/root/testdata/sf0.001"
DAYS = RunWindow("2024-01-01", "2024-01-06")
LOG = RawLog(
    "small", "part_date string, role_id string, event_time timestamp_ntz, date date, level bigint, money decimal(32,4), guild string",
    {"guild": ("alliance", "clan")},
)


def test_values_are_read_as_declared(frame):
    raw = frame(
        "part_date string, role_id double, event_time string, level double, money string, clan string, alliance string, more int",
        ("2024-01-02", 12345678901.0, "2024-01-01 10:00:00", 2.5, " 1.23456 ", "c", None, 1),
        ("2024-01-02", 7.0, " 2024-01-02T23:59:59 ", None, "", "c", "a", None),
    )
    got = rows_of(accepted(raw, LOG).selectExpr("role_id", "cast(event_time as string)", "cast(date as string)", "level", "cast(money as string)", "guild"))
    assert got == [
        ("12345678901", "2024-01-01 10:00:00", "2024-01-01", 3, "1.2346", "c"), ("7", "2024-01-02 23:59:59", "2024-01-02", None, None, "a"),
    ]
    assert accepted(raw, LOG).schema == LOG.schema


def test_rows_that_do_not_parse_are_set_apart_with_all_faults(frame):
    raw = frame(
        "part_date string, role_id double, event_time string, level string, money double",
        ("2024-01-01", 1.0, "2024-01-01 10:00:00", "3", 1.0),
        ("2024-01-01", 1.5, "soon", "12.7", float("nan")),
        ("2024-01-01", 2.0**60, "2024-01-01 10:00:00", "3", 1.0),
        (None, None, " ", "3", None),
        (None, None, " ", "3", None),
    )
    assert accepted(raw, LOG).count() == 1
    got = rows_of(set_apart(raw, LOG), "log", "part_date", "faults")
    bad_role = "role_id is not string"
    assert got == [
        ("small", None, ["no part_date", "no role_id", "no event_time"]), ("small", None, ["no part_date", "no role_id", "no event_time"]),
        ("small", "2024-01-01", [bad_role, "event_time is not timestamp_ntz", "level is not bigint", "money is not decimal(32,4)"]),
        ("small", "2024-01-01", [bad_role]),
    ]
    records = [json.loads(r.record) for r in set_apart(raw, LOG).collect()]
    assert {"part_date": "2024-01-01", "role_id": 1.5, "event_time": "soon", "level": "12.7", "money": "NaN"} in records


def test_nested_and_boolean_columns_under_declared_names(frame):
    raw = frame(
        "part_date date, role_id string, event_time timestamp, level boolean, money array<int>",
        (date(2024, 1, 1), "a", datetime(2024, 1, 1, 5), True, None), (date(2024, 1, 1), " ", datetime(2024, 1, 1, 5), None, [1]),
    )
    assert rows_of(accepted(raw, LOG), "part_date", "role_id", "level") == [("2024-01-01", "a", 1)]
    assert rows_of(set_apart(raw, LOG), "faults") == [(["no role_id", "money is not decimal(32,4)"],)]


def test_empty_logs_and_clashing_names(frame):
    raw = frame("part_date string, role_id string, event_time timestamp_ntz, read int, record string, faults string, `a.b` int")
    assert accepted(raw, LOG).collect() == [] and set_apart(raw, LOG).collect() == []
    raw = frame(
        "part_date string, role_id string, event_time timestamp_ntz, read int, record string, faults string, `a.b` int",
        ("2024-01-01", None, None, 1, "r", "f", 2),
    )
    assert json.loads(set_apart(raw, LOG).first().record) == {"part_date": "2024-01-01", "read": 1, "record": "r", "faults": "f", "a.b": 2}


@pytest.fixture(scope="module")
def shaped(spark, tmp_path_factory):
    """A warehouse whose logs have one shape on odd days and another on even days, in the same folder; accounts in a CSV."""
    root, t = str(tmp_path_factory.mktemp("raw")), Logs(spark, SF_DIR)
    wh = Warehouse(spark, root, Game("g"))
    for name in ("base_log", "payment_log", "item_log"):
        for shape in t.raw(name):
            days = shape.where(F.col("part_date").between(DAYS.start_date, DAYS.end_date))
            days.coalesce(1).write.mode("append").partitionBy("part_date").parquet(f"{root}/g_r/{name}")
    with open(f"{root}/g_r/test_accounts.csv", "w", encoding="utf-8-sig") as out:
        out.write("role_id\n" + "".join(f"{r.role_id}\n" for r in t.test_accounts.collect()))
    return wh, t


def test_types_that_clash_on_disk_are_read_apart(spark, shaped):
    wh, t = shaped
    assert len(read_shapes(spark, f"{wh._raw}/base_log", DAYS)) == 2
    assert len(read_shapes(spark, f"{wh._raw}/base_log")) == 2
    assert read_shapes(spark, f"{wh._raw}/base_log", RunWindow("2025-01-01", "2025-01-31")) == []
    columns = ["role_id", "event_time", "date", "part_date", "level", "online_time"]
    sound = t.base_log.where(f"part_date <= '{DAYS.end_date}'").where(
        "cast(role_id as int) % 29 not in (7, 11) and not (cast(role_id as int) % 29 = 13 and cast(substr(part_date, 9, 2) as int) % 2 = 1)"
    )
    assert rows_of(wh.log("base_log", DAYS), *columns) == rows_of(sound, *columns)
    assert wh.log("base_log").schema == RAW_LOGS["base_log"].schema


def test_two_shapes_within_one_day(spark, frame, tmp_path):
    path = str(tmp_path / "log")
    frame("role_id string, level string", ("a", "1")).write.mode("append").parquet(f"{path}/part_date=2024-01-01")
    frame("role_id string, level bigint", ("b", 2)).write.mode("append").parquet(f"{path}/part_date=2024-01-01")
    frame("role_id string", ("c",)).write.mode("append").parquet(f"{path}/part_date=__HIVE_DEFAULT_PARTITION__")
    log = RawLog("x", "part_date string, role_id string, level bigint", required=("part_date",))
    shapes = read_shapes(spark, path)
    rows = [r for s in shapes for r in rows_of(accepted(s, log))]
    assert sorted(rows) == [("2024-01-01", "a", 1), ("2024-01-01", "b", 2)]
    assert [r.faults for s in shapes for r in set_apart(s, log).collect()] == [["no part_date"]]


def test_models_run_on_raw_shapes(shaped):
    wh, t = shaped
    from rolemart.plans import upstream

    wh.refresh("dws_user_daily", DAYS)
    wh.refresh("dws_item_snapshot", DAYS)
    expected = upstream.user_daily(wh.log("base_log", DAYS), wh.log("payment_log", DAYS), t.test_accounts)
    keys = ("role_id", "part_date", "pay_count", "money", "is_test")
    assert rows_of(wh.table("dws_user_daily"), *keys) == rows_of(expected, *keys)
    assert wh.table("dws_user_daily").where("is_test = 1").count() == expected.where("is_test = 1").count()
    assert not wh.table("dws_item_snapshot").isEmpty()


def test_quarantine_is_counted_and_rerun(spark, shaped):
    wh, t = shaped
    first = rows_of(wh.set_apart("base_log", DAYS))
    assert {f for _, _, f, _ in first} <= {"no role_id", "no event_time", "event_time is not timestamp_ntz", "level is not bigint"}
    assert rows_of(wh.set_apart("base_log", DAYS)) == first
    lost = t.base_log.where(f"part_date <= '{DAYS.end_date}'").count() - wh.log("base_log", DAYS).count()
    assert sum(n for *_, n in first) == lost > 0


def test_a_column_of_its_declared_type_is_read_only_where_it_is_used(spark, shaped, tmp_path, frame):
    path = str(tmp_path / "log")
    frame(LOG.ddl, ("2024-01-01", "a", datetime(2024, 1, 1), date(2024, 1, 1), 1, None, "g")).write.partitionBy("part_date").parquet(path)
    (shape,) = read_shapes(spark, path, RunWindow("2024-01-01", "2024-01-02"))
    plan = accepted(shape, LOG).where("part_date >= '2024-01-01'").select("level")._jdf.queryExecution().executedPlan().toString()
    scan = plan.split("ReadSchema: ")[1]
    assert "level" in scan and "money" not in scan and "guild" not in scan
    assert "2024-01-01" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_an_absent_log_is_an_error(spark, tmp_path):
    for window in (None, DAYS):
        with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
            Warehouse(spark, str(tmp_path), Game("none")).log("base_log", window)
