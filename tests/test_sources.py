"""Lookups, scans and idempotent writes."""

from __future__ import annotations

import os
from datetime import date

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from rolemart.config import Game, RunWindow
from rolemart.session import new_scratch, shared_dir
from rolemart.sources import logs, lookups, sinks
from rolemart.sources.sinks import full_refresh, overwrite_range, read_table
from rolemart.sources.tables import TABLES, Table, conform
from tests.conftest import rows_of

DAU = TABLES["ads_active_daily"]


def test_rerun_with_fewer_days_removes_the_missing_ones(frame, tmp_path):
    path, ddl = str(tmp_path / "t"), "part_date string, dau bigint"
    first = frame(ddl, *[(f"2024-01-0{d}", d) for d in range(1, 8)])
    overwrite_range(first, DAU, path, RunWindow("2024-01-01", "2024-01-07"))
    rerun = frame(ddl, ("2024-01-03", 30), ("2024-01-05", 50))
    overwrite_range(rerun, DAU, path, RunWindow("2024-01-03", "2024-01-06"))
    kept = [(1, "2024-01-01"), (2, "2024-01-02"), (30, "2024-01-03"), (50, "2024-01-05"), (7, "2024-01-07")]
    assert sorted(rows_of(read_table(first.sparkSession, DAU, path), "dau", "part_date"), key=lambda r: r[1]) == kept
    overwrite_range(rerun.where("false"), DAU, path, RunWindow("2024-01-05", "2024-01-31"))
    assert sorted(r[1] for r in rows_of(read_table(first.sparkSession, DAU, path), "dau", "part_date")) == ["2024-01-01", "2024-01-02", "2024-01-03"]


def test_same_rerun_is_idempotent(frame, tmp_path):
    path = str(tmp_path / "t")
    rows = frame("part_date string, dau bigint", ("2024-01-01", 1), ("2024-01-02", 2))
    for _ in range(2):
        overwrite_range(rows, DAU, path, RunWindow("2024-01-01", "2024-01-31"))
    assert rows_of(read_table(rows.sparkSession, DAU, path), "dau", "part_date") == [(1, "2024-01-01"), (2, "2024-01-02")]


def test_full_refresh_keeps_old_rows_when_the_job_fails(frame, spark, tmp_path):
    table, path = Table("t", "df", "k bigint, v bigint"), str(tmp_path / "t")
    full_refresh(frame("v bigint, k bigint", (1, 2)), table, path)
    failing = spark.range(3).select(F.col("id").alias("k"), F.expr("cast(raise_error('stop') as bigint)").alias("v"))
    with pytest.raises(Exception, match="stop"):
        full_refresh(failing, table, path)
    assert rows_of(read_table(spark, table, path)) == [(2, 1)]
    full_refresh(frame("v bigint, k bigint", (5, 6)), table, path)
    assert rows_of(read_table(spark, table, path)) == [(6, 5)]


def test_null_entity_partition_round_trip(frame, tmp_path):
    table, path = TABLES["ads_artifact"], str(tmp_path / "t")
    rows = frame("artifact_id string, role_id string, artifact_level bigint", ("5", "a", 1), (None, "b", None))
    full_refresh(rows, table, path)
    assert rows_of(read_table(rows.sparkSession, table, path), "role_id", "artifact_level", "artifact_id") == [("a", 1, "5"), ("b", None, None)]


def test_conform_orders_and_casts_by_name(frame):
    table = Table("t", "df", "money decimal(36,2), d date, part_date string", "part_date")
    got = conform(frame("part_date string, d string, money double", ("2024-01-01", "2024-01-01", 1.005)), table)
    assert got.columns == ["money", "d", "part_date"] and got.first().d == date(2024, 1, 1)


def test_absent_table_is_an_error_unless_a_first_run_may_find_none(spark):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_table(spark, DAU, "/nowhere/at/all").collect()
    assert read_table(spark, DAU, "/nowhere/at/all", may_be_absent=True).collect() == []


@pytest.mark.parametrize("stray", ["2024-01-09", "2023-12-31", None])
def test_rows_outside_the_window_fail_the_write_and_replace_nothing(frame, tmp_path, stray):
    path, ddl = str(tmp_path / "t"), "part_date string, dau bigint"
    stored = frame(ddl, ("2024-01-01", 1), ("2024-01-09", 9))
    overwrite_range(stored, DAU, path, RunWindow("2024-01-01", "2024-01-09"))
    with pytest.raises(Exception, match="is outside 2024-01-01 to 2024-01-02"):
        overwrite_range(frame(ddl, ("2024-01-01", 5), (stray, 6)), DAU, path, RunWindow("2024-01-01", "2024-01-02"))
    assert rows_of(read_table(stored.sparkSession, DAU, path), "dau") == [(1,), (9,)]


def test_a_write_lists_only_the_days_of_its_window(frame, tmp_path, monkeypatch):
    path, ddl = str(tmp_path / "t"), "part_date string, dau bigint"
    days = [f"2024-{m:02d}-{d:02d}" for m in range(1, 7) for d in range(1, 29)]
    overwrite_range(frame(ddl, *[(d, 1) for d in days]), DAU, path, RunWindow("2024-01-01", "2024-06-30"))
    listed, plain = [], sinks._list_files
    monkeypatch.setattr(sinks, "_list_files", lambda spark, folder: listed.append(folder) or plain(spark, folder))
    overwrite_range(frame(ddl, ("2024-03-02", 2)), DAU, path, RunWindow("2024-03-01", "2024-03-03"))
    assert {f.rsplit("=", 1)[1] for f in listed} == {"2024-03-01", "2024-03-02", "2024-03-03"}
    kept = rows_of(read_table(frame(ddl).sparkSession, DAU, path), "part_date", "dau")
    assert len(kept) == len(days) - 2 and ("2024-03-02", 2) in kept


@pytest.mark.parametrize("refused", [1, 2])
def test_full_refresh_with_a_refused_rename_keeps_the_old_rows(frame, spark, tmp_path, monkeypatch, refused):
    table, path = Table("t", "df", "k bigint, v bigint"), str(tmp_path / "t")
    full_refresh(frame("v bigint, k bigint", (1, 2)), table, path)
    calls, plain = [], sinks._rename

    def rename(fs, source, target):
        calls.append(source)
        return False if len(calls) == refused else plain(fs, source, target)

    monkeypatch.setattr(sinks, "_rename", rename)
    with pytest.raises(OSError, match="old rows"):
        full_refresh(frame("v bigint, k bigint", (5, 6)), table, path)
    assert rows_of(read_table(spark, table, path)) == [(2, 1)]
    assert os.listdir(tmp_path) == ["t"]


def test_full_refresh_names_the_place_of_the_old_rows_if_they_cannot_go_back(frame, spark, tmp_path, monkeypatch):
    table, path = Table("t", "df", "k bigint, v bigint"), str(tmp_path / "t")
    full_refresh(frame("v bigint, k bigint", (1, 2)), table, path)
    calls, plain = [], sinks._rename
    monkeypatch.setattr(sinks, "_rename", lambda fs, a, b: calls.append(a) or (len(calls) == 1 and plain(fs, a, b)))
    with pytest.raises(OSError, match="outgoing") as failure:
        full_refresh(frame("v bigint, k bigint", (5, 6)), table, path)
    assert rows_of(read_table(spark, table, str(failure.value).rsplit(" ", 1)[1])) == [(2, 1)]


def test_table_names_carry_the_refresh_rhythm():
    names = {m: t.name for m, t in TABLES.items()}
    assert names["dws_item_snapshot"] == "dws_item_snapshot_di" and names["ads_kpi_daily_hf"] == "ads_kpi_daily_hf"
    assert names["dws_token_monthly"] == "dws_token_monthly_mf" and names["ads_kpi_monthly"] == "ads_kpi_monthly_mi"
    assert len(set(names.values())) == len(names)


def test_dimension_csv(spark, tmp_path):
    skills = tmp_path / "skills.csv"
    skills.write_text('﻿skill_id,skill_type,skill_name\n1,a,"say ""hi"", twice"\n2,,plain\n', encoding="utf-8")
    got = rows_of(lookups.read_dimension(spark, str(skills), "battle_skill"))
    assert got == [("1", "a", 'say "hi", twice'), ("2", None, "plain")]
    swapped = tmp_path / "summon.csv"
    swapped.write_text("﻿summon_id,summon_type,summon_cn\n7,big,seven\n", encoding="utf-8")
    assert rows_of(lookups.read_dimension(spark, str(swapped), "summon")) == [("7", "seven", "big")]
    partial = tmp_path / "pay.csv"
    partial.write_text("﻿payment_itemid,payment_name,payment_cate,payment_act\nx,n,c,a\n", encoding="utf-8")
    row = lookups.read_dimension(spark, str(partial), "payment_item").first()
    assert (row.payment_act, row.limit_num, row.money) == ("a", None, None)
    ids = tmp_path / "roles.csv"
    ids.write_text("﻿role_id\n90071992547409931\n", encoding="utf-8")
    assert lookups.read_dimension(spark, str(ids), "test_accounts").first().role_id == "90071992547409931"


def test_calendar_days_without_leading_zeros(frame):
    days = frame("start_date string", ("2023-11-6",), ("2024-1-12",)).select(lookups.calendar_day(F.col("start_date")))
    assert [r[0] for r in days.collect()] == [date(2023, 11, 6), date(2024, 1, 12)]


def test_rates_and_prices(spark, frame):
    rates = frame("currency string, currency_time string, rate double", ("JPY", "2024-01", 4.9), ("USD", "2024-01", 7.1))
    assert rows_of(lookups.currency_rates(rates, "JPY")) == [("2024-01", 4.9)]
    game = Game("g")
    listed = dict(rows_of(lookups.token_price_list(spark, game)))
    assert listed == dict(game.token_packs)
    ids = frame("payment_itemid string", ("gold_100003",), ("other",), (None,))
    got = {r[0]: r[1] for r in ids.select("payment_itemid", lookups.token_price(F.col("payment_itemid"), game)).collect()}
    assert got == {"gold_100003": 120, "other": None, None: None}


def test_scans_prune_partitions(spark, frame, tmp_path):
    path = str(tmp_path / "log")
    frame("part_date string, v int", *[(f"2024-01-{d:02d}", d) for d in range(1, 31)]).write.partitionBy("part_date").parquet(path)
    log = logs.read_log(spark, path, "v int, part_date string")
    recent = logs.trailing(log, "2024-01-30", 15)
    assert recent.count() == 16 and log.schema["part_date"].dataType.simpleString() == "string"
    assert logs.since(log, "2024-01-20", "2024-01-25").count() == 6 and logs.before(log, "2024-01-03").count() == 2
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "(part_date#" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_scratch_lies_in_the_shared_folder(spark):
    assert new_scratch(spark, "x").startswith(shared_dir(spark))
