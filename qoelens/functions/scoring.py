"""Column expressions shared by the scorers. Inputs are column names."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .profiles import LABELS, label_score_sql, score_label_sql


def half_up(value: Column, digits: int) -> Column:
    """Round half up on the decimal reading, free of summation-order noise."""
    return F.round(F.round(value, digits + 7), digits)


def weighted_mean(weights: Mapping[str, float]) -> Column:
    """Mean over the non-null columns, the weights renormalised; NULL if none."""
    total = " + ".join(f"coalesce({c} * {float(w)}D, 0D)" for c, w in weights.items())
    weight = " + ".join(f"if({c} IS NULL, 0D, {float(w)}D)" for c, w in weights.items())
    return F.expr(f"try_divide({total}, {weight})")


def mean_of_available(columns: Iterable[str]) -> Column:
    columns = list(columns)
    total = " + ".join(f"coalesce(double({c}), 0D)" for c in columns)
    present = " + ".join(f"int({c} IS NOT NULL)" for c in columns)
    return F.expr(f"try_divide({total}, {present})")


def worst_label(*labels: str) -> Column:
    """Worst of several labels; NULLs do not count, all NULL gives NULL."""
    worst = ", ".join(label_score_sql(c) for c in labels)
    return F.expr(score_label_sql(f"least({worst})"))


def least_available(columns: Iterable[str]) -> Column:
    """Smallest non-null value (Spark's ``least`` skips NULLs)."""
    columns = list(columns)
    return F.col(columns[0]) if len(columns) == 1 else F.least(*columns)


def vote(counts: Mapping[str, Iterable[str]], minimum: int) -> Column:
    """First label, worst first, that some band saw ``minimum`` times."""
    branches = " ".join(f"WHEN greatest({', '.join(counts[label])}) >= {minimum} THEN '{label}'" for label in LABELS)
    return F.expr(f"CASE {branches} ELSE 'No Data' END")


def log_volume(sent: str, received: str) -> Column:
    return F.expr(f"CASE WHEN {sent} + {received} > 0 THEN ln({sent} + {received}) END")


def text_or_na(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("N/A"))
