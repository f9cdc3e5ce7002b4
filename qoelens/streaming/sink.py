"""Writing a stream so that a replayed batch changes nothing."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir
from ..sources.tables import partitions


def drain(
    stream: DataFrame, name: str, handle: Callable[[DataFrame, int], None], mode: str = "update"
) -> None:
    """Process everything available now, batch by batch, and stop.

    Progress is kept in the shared folder under ``name``; running again goes
    on where the last run ended.
    """
    spark = stream.sparkSession
    running = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", f"{shared_dir(spark)}/progress/{name}")
        .trigger(availableNow=True)
        .foreachBatch(handle)
        .start()
    )
    running.awaitTermination()


def batch_writer(path: str) -> Callable[[DataFrame, int], None]:
    """Each batch replaces its own ``batch=N`` folder."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number:08d}")

    return write


def batches(spark: SparkSession, path: str) -> list[str]:
    return [b for (b,) in partitions(spark, path, "batch")]


def latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Newest version of every key an update-mode stream has written."""
    df = spark.read.parquet(path)
    values = [c for c in df.columns if c not in keys and c != "batch"]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("_v")).select(*keys, "_v.*")


def last_batch(spark: SparkSession, path: str) -> DataFrame:
    """Result of the newest batch of a complete-mode stream."""
    return spark.read.parquet(f"{path}/batch={batches(spark, path)[-1]}")
