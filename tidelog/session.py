"""Session defaults for tests and the bench, and the shared folder for tables that cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


def build_session(cpus: int | str = 8, name: str = "tidelog", shuffle_partitions: int = 8) -> SparkSession:
    """A local session. On a cluster the caller's own session is used as it is."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TIDELOG_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@cache
def _local_folder() -> tempfile.TemporaryDirectory:
    """For local sessions without a checkpoint folder; it goes when the process ends."""
    return tempfile.TemporaryDirectory(prefix="tidelog-", dir="/tmp", ignore_cleanup_errors=True)


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder name under the session's checkpoint folder, readable by every executor.

    Only a local session without that setting gets a temporary folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = _local_folder().name
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/tidelog-{uuid.uuid4().hex}"
