"""Time covered by overlapping intervals, per key, however many a key has.

Rows are range partitioned on (keys, start), so one key may span many tasks. Each
task merges its sorted stretch into islands and writes them. What an earlier task
already covers of a key is the furthest end of its stretches: one row per key
and task, of which only those of keys that go on into a later task matter.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .skew import materialise


def _islands(keys: list[str], start: str, end: str):
    """Sorted intervals -> disjoint islands; the last one of a batch is held back, as the next may go on with it."""

    def merge(batch: pd.DataFrame) -> pd.DataFrame:
        new_key = np.zeros(len(batch), dtype=bool)
        new_key[0] = True
        for c in keys:
            v = batch[c]
            new_key |= ((v != v.shift()) & ~(v.isna() & v.shift().isna())).to_numpy(dtype=bool)
        run = np.cumsum(new_key)
        reached = batch[end].groupby(run).cummax()
        opens = new_key | (batch[start] > reached.shift()).to_numpy(dtype=bool)
        first = np.flatnonzero(opens)
        out = batch.iloc[first].reset_index(drop=True)
        out[end] = np.maximum.reduceat(batch[end].to_numpy(), first)
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, held = TaskContext.get().partitionId(), None
        for batch in batches:
            if batch.empty:
                continue
            out = merge(batch if held is None else pd.concat([held, batch], ignore_index=True))
            held = out.iloc[[-1]]
            if len(out) > 1:
                yield out.iloc[:-1].assign(_part=part)
        if held is not None:
            yield held.assign(_part=part)

    return run


def covered(rows: DataFrame, keys: Sequence[str], start: str, end: str, out: str = "covered") -> DataFrame:
    """(keys, out): length of the union of the intervals [start, end) per key, whole numbers.

    Empty intervals and those with a NULL end add nothing; a key with no others is absent. NULL is a key like any other.
    """
    keys = list(keys)
    real = rows.select(*keys, F.col(start).alias("_lo"), F.col(end).alias("_hi")).where("_hi > _lo").distinct()
    start, end = "_lo", "_hi"
    ranged = real.repartitionByRange(*keys, start, end).sortWithinPartitions(*keys, start, end)
    schema = T.StructType([*ranged.schema.fields, T.StructField("_part", T.IntegerType())])
    islands = materialise(ranged.mapInPandas(_islands(keys, start, end), schema), "islands")
    reach = islands.groupBy(*keys, "_part").agg(F.max(end).alias("_reach"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # A part has at most one key that an earlier part has begun.
    carried = reach.select(*(F.col(k).alias(f"_k_{k}") for k in keys), F.col("_part").alias("_p"), F.max("_reach").over(earlier).alias("_from"))
    carried = F.broadcast(carried.where("_from is not null"))
    same = F.col("_part") == F.col("_p")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    begin = F.greatest(F.col(start), F.coalesce("_from", F.col(start)))
    pieces = islands.join(carried, same, "left").select(*keys, F.greatest(F.col(end) - begin, F.lit(0)).alias("_piece"))
    return pieces.groupBy(*keys).agg(F.sum("_piece").alias(out))
