"""Exact percentiles from value counts.

Rows are first counted per (keys, value): a plain hash aggregate that combines
on the map side and spreads even a hot key over its values. What is left of a
key is at most one row per distinct value (a signal has about a hundred), and
only that is ordered.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def value_counts(rows: DataFrame, keys: Sequence[str], value: str, **extra: Column) -> DataFrame:
    """``n`` rows per (keys, value), plus any further sums or counts."""
    return rows.groupBy(*keys, value).agg(
        F.count(F.lit(1)).alias("n"), *(c.alias(name) for name, c in extra.items())
    )


def percentiles_of_counts(
    counts: DataFrame, keys: Sequence[str], value: str, points: Mapping[str, float], n: str = "n",
    sums: Sequence[str] = (),
) -> DataFrame:
    """Per key: for each name the smallest value that at least that share of the
    non-null rows does not exceed, the largest value ``top`` and the rows ``n``.

    ``counts`` may hold a (keys, value) pair more than once. Further count
    columns named in ``sums`` are added up along the way.
    """
    series = Window.partitionBy(*keys)
    upto = series.orderBy(value).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.where(F.col(value).isNotNull()).select(
        *keys, value, *sums, F.col(n).alias("_n"), F.sum(n).over(upto).alias("_upto"), F.sum(n).over(series).alias("_all")
    )
    return ranked.groupBy(*keys).agg(
        *(
            F.min(F.when(F.col("_upto") >= F.ceil(F.col("_all") * F.lit(float(p))), F.col(value))).alias(name)
            for name, p in points.items()
        ),
        F.max(value).alias("top"),
        F.sum("_n").alias("n"),
        *(F.sum(c).alias(c) for c in sums),
    )
