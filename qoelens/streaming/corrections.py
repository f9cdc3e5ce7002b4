"""Repair of windows that rows reached too late.

A watermark drops what comes too late, and never says so. Beside the windowed
stream a second one stores every row and keeps a correction log: rows older than
the watermark of the batches before name the windows they belong to. A batch
job scores exactly those windows again, from the stored rows, and publishes them
as a new version. Readers merge on read: the newest version of a window, or else
what the stream wrote. Every folder is named by the batch it stands for, so
replaying a batch or a repair changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import path_exists
from .sink import batches


class CorrectionLog:
    """``foreachBatch`` handler that keeps ``rows``, ``touched`` and ``clock`` under ``path``.

    ``late_by`` must be the watermark's delay. ``windows`` turns rows into the
    windows they belong to: the key columns of the result, ``keys``. Rows that
    are late but in a window the stream still holds are logged too; scoring
    such a window again gives the same.
    """

    def __init__(
        self, path: str, time: str, late_by: timedelta, keys: Sequence[str], windows: Callable[[DataFrame], DataFrame],
        score: Callable[[DataFrame], DataFrame],
    ) -> None:
        self.path, self.time, self.late_by, self.keys = path, time, late_by, list(keys)
        self.windows, self.score = windows, score

    def _clock(self, spark: SparkSession, number: int):
        """Newest event time of the batches before ``number``."""
        earlier = [b for b in batches(spark, f"{self.path}/clock") if int(b) < number]
        return spark.read.parquet(f"{self.path}/clock/batch={earlier[-1]}").first()["newest"] if earlier else None

    def __call__(self, batch: DataFrame, number: int) -> None:
        spark, folder = batch.sparkSession, f"batch={number:08d}"
        clock = self._clock(spark, number)
        stored = batch.withColumn("day", F.to_date(self.time))
        stored.write.mode("overwrite").partitionBy("day").parquet(f"{self.path}/rows/{folder}")
        # From here on the stored rows are read, not the batch once more.
        stored = spark.read.schema(stored.schema).parquet(f"{self.path}/rows/{folder}")
        late = stored.where(F.lit(False) if clock is None else F.col(self.time) < F.lit(clock - self.late_by))
        touched = self.windows(late).select(*self.keys, "day").distinct()
        touched.write.mode("overwrite").parquet(f"{self.path}/touched/{folder}")
        newest = stored.agg(F.greatest(F.max(self.time), F.lit(clock).cast("timestamp")).alias("newest"))
        newest.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/clock/{folder}")

    def repair(self, spark: SparkSession) -> int:
        """Score the windows again that batches since the last repair have touched; returns how many.

        A window may reach over midnight, so the days beside a touched one are read too.
        """
        done = batches(spark, f"{self.path}/fixed")
        logged = [b for b in batches(spark, f"{self.path}/touched") if not done or int(b) > int(done[-1])]
        if not logged:
            return 0
        touched = spark.read.parquet(*(f"{self.path}/touched/batch={b}" for b in logged))
        days = sorted({r["day"] + timedelta(days=d) for r in touched.select("day").distinct().collect() for d in (-1, 0, 1)})
        windows = touched.select(*self.keys).distinct()
        target = f"{self.path}/fixed/batch={logged[-1]}"
        # One folder per batch and day: only the touched days are opened.
        rows = spark.read.option("basePath", f"{self.path}/rows").parquet(f"{self.path}/rows").where(F.col("day").isin(days))
        same = [F.col(k).eqNullSafe(F.col(f"_t_{k}")) for k in self.keys]
        again = self.score(rows.drop("batch")).join(windows.withColumnsRenamed({k: f"_t_{k}" for k in self.keys}), same, "left_semi")
        again.write.mode("overwrite").parquet(target)
        return spark.read.parquet(target).count()

    def merged(self, written: DataFrame) -> DataFrame:
        """The stream's ``written`` windows with the repaired ones in their place."""
        spark = written.sparkSession
        if not path_exists(spark, f"{self.path}/fixed"):
            return written
        values = [c for c in written.columns if c not in self.keys]
        fixed = spark.read.option("basePath", f"{self.path}/fixed").parquet(f"{self.path}/fixed").withColumn("version", F.col("batch").cast("bigint"))
        both = fixed.select(*written.columns, "version").unionByName(written.withColumn("version", F.lit(-1).cast("bigint")))
        newest = both.groupBy(*self.keys).agg(F.max_by(F.struct(*values), "version").alias("_v"))
        return newest.select(*self.keys, "_v.*").select(*written.columns)
