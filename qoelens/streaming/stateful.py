"""Neighbouring-row counts across micro-batches.

``lag`` does not exist on streams, and keyed state would send a hot series to
one task in every batch. Instead each batch runs the range-partitioned batch
operator, and a small table carries the last row of every series to the next.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import Step, count_steps, last_rows
from ..operators.skew import join_back
from .sink import batches


class StepCounter:
    """``foreachBatch`` handler writing ``counts`` and ``last`` under ``path``.

    Batch N only reads what batch N-1 left and replaces its own folders, so a
    replay gives the same result. Rows older than their series' last row come
    too late to be placed; they go to ``late`` for the back-fill.
    """

    def __init__(
        self, path: str, keys: Sequence[str], order: Sequence[str], value: str, step: Step,
        groups: Sequence[str] = (), out: str = "steps",
    ) -> None:
        self.path, self.keys, self.order, self.value = path, list(keys), list(order), value
        self.step, self.groups, self.out = step, list(groups), out

    def __call__(self, batch: DataFrame, number: int) -> None:
        rows = batch.select(*dict.fromkeys([*self.keys, *self.groups, *self.order, self.value]))
        # The batch is read for its hot series, for late rows, for counts and for last rows.
        whole = rows = rows.where(F.col(self.value).isNotNull()).persist()
        carry = self._carried(batch, number)
        folder = f"batch={number:08d}"
        if carry is not None:
            seen = carry.select(*self.keys, F.struct(*self.order).alias("_seen"))
            placed = join_back(rows, seen, self.keys, how="left")
            is_late = F.coalesce(F.struct(*self.order) < F.col("_seen"), F.lit(False))
            placed.where(is_late).drop("_seen").write.mode("overwrite").parquet(f"{self.path}/late/{folder}")
            rows = placed.where(~is_late).drop("_seen")
        counts = count_steps(rows, self.keys, self.order, self.value, self.step, self.groups, self.out, carry)
        counts.write.mode("overwrite").parquet(f"{self.path}/counts/{folder}")
        known = rows.select(*self.keys, *self.order, self.value)
        if carry is not None:
            known = known.unionByName(carry)
        last_rows(known, self.keys, self.order, self.value).write.mode("overwrite").parquet(f"{self.path}/last/{folder}")
        whole.unpersist()

    def _carried(self, batch: DataFrame, number: int) -> DataFrame | None:
        spark = batch.sparkSession
        before = [b for b in batches(spark, f"{self.path}/last") if int(b) < number]
        return spark.read.parquet(f"{self.path}/last/batch={before[-1]}") if before else None

    def totals(self, spark) -> DataFrame:
        """Counts over all batches so far."""
        stored = spark.read.parquet(f"{self.path}/counts")
        return stored.groupBy(*self.keys, *self.groups).agg(F.sum(self.out).alias(self.out))
