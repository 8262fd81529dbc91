"""Shapes the physical plans must keep. That none joins all pairs or runs Python is part of ``verify.compare``."""

from __future__ import annotations

import re

import pytest

from harness.registry import spark_queries

SF_DIR = "/root/testdata/sf0.001"


def plan_of(spark, name: str) -> str:
    return spark_queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["agg_count_distinct_if", "ads_kpi_daily", "ads_level_daily", "ads_core_daily"])
def test_distinct_counts_do_not_copy_rows(spark, name):
    assert "Expand" not in plan_of(spark, name)


@pytest.mark.parametrize("name", ["dws_token_monthly", "win_lag", "win_lag_default", "ads_kpi_daily", "dws_user_daily_derive"])
def test_windows_do_not_gather_everything_in_one_task(spark, name):
    lines = plan_of(spark, name).splitlines()
    for at, line in enumerate(lines):
        if re.search(r"[+:-] (\*\(\d+\) )?Window", line):
            below = next(x for x in lines[at + 1 :] if "Exchange" in x or "Scan" in x)
            assert "SinglePartition" not in below


def test_item_snapshot_reads_its_log_once_and_needs_no_window(spark):
    plan = plan_of(spark, "dws_item_snapshot")
    assert plan.count("FileScan parquet") == 2 and "Window" not in plan


def test_grid_of_the_daily_kpi_is_not_a_join(spark):
    """The report itself is joined to nothing: metrics are computed once and stretched over the days."""
    plan = plan_of(spark, "ads_kpi_daily")
    head = plan[: plan.index("Join")]
    assert head.count("Window") >= 2 and "Generate explode" in head


def test_scans_read_only_needed_columns(spark):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan_of(spark, "dws_token_monthly"))
    lines = [s for s in schemas if "l_partkey" in s]
    assert lines and all("l_extendedprice" not in s and "l_shipdate" not in s for s in lines)


def test_purchase_filter_reaches_the_scan(spark):
    assert "EqualTo(event_type,purchase)" in plan_of(spark, "agg_sum")
