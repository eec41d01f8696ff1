"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "demandflow", **conf: str) -> SparkSession:
    """Session with the settings the plans expect; leave ``master`` out under spark-submit.

    Shuffle partitions are not fixed here: on a cluster start high and let AQE coalesce.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Dates and timestamps are compared in UTC everywhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def use_small_splits(spark: SparkSession) -> SparkSession:
    """Tasks read some million rows of narrow columns, so that what they sort fits their share of memory
    however large the table is."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", SESSION_DEFAULTS["spark.sql.files.maxPartitionBytes"])
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster that would be a
    different folder on each machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="demandflow-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def run_folder(spark: SparkSession, label: str) -> str:
    """Fresh folder below the shared one, so runs never see each other's files."""
    return f"{shared_folder(spark)}/demandflow/{label}-{uuid.uuid4().hex}"
