"""Written intermediate tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.skew import materialise
from ..session import drop_finished  # noqa: F401

#: Shuffle partitions that share a file of a compact table.
PER_FILE = 8


#: Rows and bytes of text that travel to Python at once.
BATCH_ROWS, BATCH_BYTES = 2000, 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches end after a few MB, so that a task's memory does not
    depend on how long the texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def compact(df: DataFrame, purpose: str) -> DataFrame:
    """``materialise`` for a table much smaller than what it is made from: a
    file for every few shuffle partitions, which one task goes through in turn."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialise(df.coalesce(max(1, partitions // PER_FILE)), purpose)
