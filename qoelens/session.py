"""Session defaults and the shared folder that survives executor loss."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

#: Settings every job relies on. Cluster-sized values (shuffle partitions,
#: executor memory) belong to spark-submit, not here.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Call-site capture costs more than a millisecond per column operation.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own; on a
    cluster the missing setting is an error, because a machine-local folder
    would be lost with its executor.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        folder = os.path.join(tempfile.gettempdir(), f"qoelens-{context.applicationId}")
    return folder.rstrip("/")


def run_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh sub-folder of the shared folder, one per run."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex[:12]}"


def drop_finished(spark: SparkSession) -> None:
    """Have Spark drop the shuffle files of finished steps now: it does once the driver
    has collected what refers to them, and a driver with little to do collects late."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
