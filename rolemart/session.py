"""Session settings the models are written for, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # call-site capture on every column costs a round trip to the JVM
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Large jobs start wide; AQE merges what turns out small.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4000",
    # user-level joins may reuse a role_id partitioning for (role_id, part_date) keys
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def build_session(app_name: str = "rolemart", **overrides: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**RECOMMENDED, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session may go without: driver and executors are then one process, and a
    temporary folder serves both.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="rolemart-"))
    return context.getCheckpointDir()


def new_scratch(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Compute a report-sized aggregate once, on shared storage, before it is read several times.

    Without this a dense grid would recompute its metrics from the logs for every axis.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
