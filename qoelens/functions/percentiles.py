"""Percentiles that combine on the map side and never gather a group's rows.

``exact`` keeps value -> count, so a group's buffer is bounded by the number of
*distinct* values; signal levels and whole-number rates have at most a few
thousand. ``sketch`` is for measures without such a bound.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def percentiles(value: str, points: Sequence[float], method: str = "exact") -> Column:
    """Array of data elements of the SQL expression ``value`` at ``points``."""
    wanted = ", ".join(f"{p}D" for p in points)
    if method == "exact":
        return F.expr(f"percentile_disc(array({wanted})) WITHIN GROUP (ORDER BY {value})")
    if method == "sketch":
        return F.expr(f"percentile_approx({value}, array({wanted}), 10000)")
    raise ValueError(f"unknown percentile method: {method}")


def band_value(value: str, band: str) -> str:
    """SQL text: ``value`` on records of one band, NULL elsewhere."""
    prefix = "2.4G" if band == "2_4G" else band
    return f"CASE WHEN startswith(band, '{prefix}') THEN {value} END"
