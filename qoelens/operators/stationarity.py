"""Stations that do not move: a narrow upper half of the day's signal levels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.percentiles import percentiles
from .histogram import percentiles_of_counts, value_counts
from .skew import join_back

# Points of the signal distribution and the outlier rule
# bound = min(p10 - 2 * (p90 - p10), p3).
POINTS = {"p3": 0.03, "p10": 0.10, "p50": 0.50, "p90": 0.90}
STATIONARY_SPREAD = 5


def signal_bounds(
    rows: DataFrame, keys: Sequence[str], signal: str, method: str = "exact", counted: str | None = None
) -> DataFrame:
    """Per key: percentiles, lower outlier bound, largest value and row count.

    ``exact`` is for whole-number signals; ``sketch`` for continuous ones, whose
    distinct values nothing bounds. Rows that are counts already name the column
    ``counted`` that has them; that goes with ``exact``.
    """
    if counted and method != "exact":
        raise ValueError(f"counted rows have exact percentiles, not {method}")
    heard = rows.where(F.col(signal).isNotNull())
    if method == "exact":
        counts = heard.groupBy(*keys, signal).agg(F.sum(counted).alias("n")) if counted else value_counts(heard, keys, signal)
        levels = percentiles_of_counts(counts, keys, signal, POINTS)
    else:
        sketch = heard.groupBy(*keys).agg(
            percentiles(f"`{signal}`", list(POINTS.values()), method).alias("_p"),
            F.max(signal).alias("top"),
            F.count(F.lit(1)).alias("n"),
        )
        levels = sketch.withColumns({name: F.get("_p", F.lit(i)) for i, name in enumerate(POINTS)}).drop("_p")
    return with_bound(levels)


def with_bound(levels: DataFrame) -> DataFrame:
    """The outlier rule on a table of percentiles."""
    return levels.withColumn("bound", F.expr("double(least(p10 - 2 * (p90 - p10), p3))"))


def drop_low_outliers(rows: DataFrame, keys: Sequence[str], signal: str, method: str = "exact") -> DataFrame:
    """Rows whose signal lies strictly above their key's outlier bound."""
    bounds = signal_bounds(rows, keys, signal, method).select(*keys, "bound", "p50", "p90")
    heard = rows.where(F.col(signal).isNotNull())
    return join_back(heard, bounds, keys).where(F.col(signal) > F.col("bound"))


def stationarity(
    rows: DataFrame, keys: Sequence[str], signal: str, spread: float = STATIONARY_SPREAD,
    keep_constant: bool = False, method: str = "exact", counted: str | None = None,
) -> DataFrame:
    """Per key ``stationarity`` "1" or "0", plus the key's row count ``n``.

    A key appears when at least one record survives the outlier rule, that is
    when its largest value lies above the bound: no second look at the rows.
    A constant signal never does; ``keep_constant`` keeps it as stationary.
    """
    bounds = signal_bounds(rows, keys, signal, method, counted)
    return judge(bounds, spread, keep_constant).select(*keys, "stationarity", "n")


def judge(bounds: DataFrame, spread: float = STATIONARY_SPREAD, keep_constant: bool = False) -> DataFrame:
    """Keys with a surviving record, flagged."""
    survives = "top > bound" + (" OR top = p3" if keep_constant else "")
    return bounds.where(survives).withColumn("stationarity", F.expr(f"if(p90 - p50 <= {spread}, '1', '0')"))


def mobility(rows: DataFrame, keys: Sequence[str], signal: str, **kw) -> DataFrame:
    """Stationarity as the label the hourly jobs carry along."""
    status = F.when(F.col("stationarity") == "1", "Stationary").otherwise("Non-stationary")
    return stationarity(rows, keys, signal, **kw).select(*keys, status.alias("mobility_status"), "n")
