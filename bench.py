"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from harness.registry import spark_queries  # noqa: E402

HEADLINE = (
    "dws_user_daily", "dws_user_info", "dws_item_snapshot", "dws_hero_snapshot", "dws_artifact_snapshot",
    "dws_token_monthly", "ads_kpi_daily", "ads_kpi_daily_hf", "ads_kpi_monthly", "ads_level_daily", "ads_core_daily",
    "ads_item_daily", "ads_item_end", "ads_summon_daily", "ads_artifact", "ads_hero_upgrade", "ads_retention_daily",
    "ads_kpi_hourly_hi", "chk_6_3", "win_row_number_locf",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.requireAllClusterKeysForCoPartition", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = spark_queries()
    names = [n for n in sys.argv[1:] if n in registered] or HEADLINE
    registered["agg_global"](spark, sf_dir).collect()  # start the executors and read the footers once
    seconds = {}
    for name in names:
        began = time.perf_counter()
        registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    total = round(sum(seconds.values()), 3)
    scale = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))


if __name__ == "__main__":
    main()
