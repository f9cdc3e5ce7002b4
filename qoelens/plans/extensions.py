"""Refinements the requirements describe in words: segments, novelty, rolling
and trimmed statistics, rates, alerts, validation."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations, combinations_with_replacement

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.percentiles import percentiles
from ..functions.profiles import IP_CHANGES, IP_CHANGES_WITH_REBOOT, bucketize
from ..operators.histogram import percentiles_of_counts, value_counts
from ..operators.intervals import covered
from ..operators.ranking import top_rows
from ..operators.shape import merge_features

#: Seconds after a report for which it vouches that the router is up.
REPORT_HOLDS = 6 * 3600


def daily_values(rows: DataFrame, keys: Sequence[str], time: Column, value: Column) -> DataFrame:
    """One value per key and day; what the trailing windows below run on, so a
    window never holds more than one row per day."""
    day = F.datediff(time, F.lit("1970-01-01").cast("date"))
    return rows.groupBy(*keys, day.alias("day_no")).agg(value.alias("value"))


def segment_thresholds(rows: DataFrame, segment: str, metric: str, point: float = 0.1) -> DataFrame:
    """Rows per segment below the segment's own limit and below the global one.

    Works on value counts: the rows are read once and only counts are joined.
    """
    counts = value_counts(rows.where(F.col(metric).isNotNull()), [segment], metric)
    own = percentiles_of_counts(counts, [segment], metric, {"segment_limit": point}).drop("top", "n")
    everyone = rows.agg(F.get(percentiles(metric, [point]), F.lit(0))).scalar()
    judged = counts.join(F.broadcast(own), segment).withColumn("global_limit", everyone)

    def below(limit: str) -> Column:
        return F.sum(F.when(F.col(metric) < F.col(limit), F.col("n")).otherwise(0))

    return judged.groupBy(segment).agg(
        F.sum("n").alias("records"), F.max("segment_limit").alias("segment_limit"), F.max("global_limit").alias("global_limit"),
        below("segment_limit").alias("below_segment"), below("global_limit").alias("below_global"),
    )


def novelty(daily: DataFrame, keys: Sequence[str], days: int = 7, deviations: float = 2.0) -> DataFrame:
    """Each day against the key's own trailing baseline; a day without two
    earlier days in the baseline is never novel."""
    past = Window.partitionBy(*keys).orderBy("day_no").rangeBetween(-days, -1)
    out = daily.withColumn("baseline", F.avg("value").over(past)).withColumn("spread", F.stddev_samp("value").over(past))
    unusual = F.abs(F.col("value") - F.col("baseline")) > F.col("spread") * deviations
    return out.withColumn("novel", F.coalesce(unusual, F.lit(False)))


def rolling_median(daily: DataFrame, keys: Sequence[str], days: int = 7) -> DataFrame:
    """Median of the last ``days`` calendar days, the day itself included."""
    week = Window.partitionBy(*keys).orderBy("day_no").rangeBetween(1 - days, 0)
    return daily.withColumn("rolling_median", F.percentile("value", F.lit(0.5)).over(week))


def trimmed_mean(rows: DataFrame, keys: Sequence[str], value: str, low: float = 0.1, high: float = 0.9) -> DataFrame:
    """Mean of the values between two percentiles of the key, from value counts."""
    counts = value_counts(rows.where(F.col(value).isNotNull()), keys, value)
    limits = percentiles_of_counts(counts, keys, value, {"_low": low, "_high": high}).drop("top", "n")
    kept = counts.join(limits, list(keys)).where(F.col(value).between(F.col("_low"), F.col("_high")))
    return kept.groupBy(*keys).agg(
        F.try_divide(F.sum(F.col(value) * F.col("n")), F.sum("n")).alias("trimmed_mean"), F.sum("n").alias("kept")
    )


def rate_per_active_day(
    daily: DataFrame, reports: DataFrame, keys: Sequence[str], counter: str, day: str = "day"
) -> DataFrame:
    """Events per day on which the key reported anything at all; ``reports`` has
    every report's keys and day, ``daily`` only days with events."""
    active = reports.select(*keys, day).distinct().groupBy(*keys).agg(F.count(day).alias("active_days"))
    events = daily.groupBy(*keys).agg(F.sum(F.coalesce(counter, F.lit(0))).alias("events"))
    joined = active.join(events, list(keys), "left").withColumn("events", F.coalesce("events", F.lit(0)))
    return joined.withColumn("rate", F.try_divide("events", "active_days"))


def rates_per_uptime(
    reports: DataFrame, reboots: DataFrame, changes: DataFrame, key: str = "sn", time: str = "ts", holds: int = REPORT_HOLDS
) -> DataFrame:
    """Per home: seconds it was up, reboots, reboots per day of uptime, address changes and those per active day.

    Every report (key, day, time in milliseconds) vouches for ``holds`` seconds
    after its own; overlapping stretches count once. ``reboots`` and ``changes`` have a row per
    key and day with ``num_total_reboots`` and ``no_ip_changes``.
    """
    spans = reports.select(key, F.floor(F.col(time) / 1000).alias("_from")).withColumn("_until", F.col("_from") + holds)
    up = covered(spans, [key], "_from", "_until", "uptime_seconds")
    active = reports.select(key, "day").distinct().groupBy(key).agg(F.count("day").alias("active_days"))
    totals = [
        df.groupBy(key).agg(F.sum(F.coalesce(c, F.lit(0))).alias(out))
        for df, c, out in ((reboots, "num_total_reboots", "reboots"), (changes, "no_ip_changes", "ip_changes"))
    ]
    joined = merge_features([up, active, *totals], key).where("uptime_seconds is not null")
    joined = joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("reboots", "ip_changes")})
    return joined.select(
        key, "uptime_seconds", "reboots", F.try_divide(F.col("reboots") * 86_400.0, F.col("uptime_seconds")).alias("reboots_per_day_up"), "ip_changes", "active_days",
        F.try_divide("ip_changes", "active_days").alias("ip_changes_per_active_day"),
    )


def cumulative_alerts(daily: DataFrame, keys: Sequence[str], counter: str, limit: int, day: str = "day") -> DataFrame:
    """First day a key's running total passes ``limit``."""
    running = Window.partitionBy(*keys).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    total = daily.withColumn("_total", F.sum(F.coalesce(counter, F.lit(0))).over(running))
    return total.where(F.col("_total") > limit).groupBy(*keys).agg(F.min(day).alias("alert_day"))


def segment_alerts(rows: DataFrame, segment: Sequence[str], flag: Column, share: float) -> DataFrame:
    """Segments in which the flagged share passes ``share``."""
    grouped = rows.groupBy(*segment).agg(F.count(F.lit(1)).alias("members"), F.count_if(flag).alias("flagged"))
    out = grouped.withColumn("share", F.try_divide("flagged", "members"))
    return out.where(F.col("share") > share)


def precision_of_worst(scores: DataFrame, confirmed: DataFrame, per: Sequence[str], key: str, k: int = 20) -> DataFrame:
    """Share of each day's k worst keys that were confirmed as real cases."""
    worst = top_rows(scores, list(per), [F.col("score"), F.col(key)], k)
    known = confirmed.select(key).distinct().withColumn("_hit", F.lit(1))
    return worst.join(known, key, "left").groupBy(*per).agg(
        F.count(F.lit(1)).alias("listed"), F.count("_hit").alias("confirmed"),
        F.avg(F.coalesce("_hit", F.lit(0)).cast("double")).alias("precision"),
    )


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All pairwise correlations as rows, from one aggregation."""
    pairs = list(combinations_with_replacement(columns, 2))
    wide = df.agg(*(F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs))
    long = F.explode(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{a}|{b}`").alias("corr")) for a, b in pairs)))
    return wide.select(long.alias("p")).select("p.*")


def explained_variance(df: DataFrame, columns: Sequence[str], k: int) -> DataFrame:
    """Share of variance per principal component of the standardised columns.

    One aggregation gives the covariances and from them the correlation matrix, as large
    as the list of columns; its eigenvalues are the variances. Rows with a NULL are left out, a
    constant column adds nothing, and without two rows there are no components.
    """
    n = len(columns)
    pairs = list(combinations(range(n), 2))
    found = df.dropna(subset=list(columns)).agg(
        *(F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(columns)),
        *(F.covar_samp(columns[i], columns[j]).alias(f"c{i}_{j}") for i, j in pairs),
    ).first()
    varies = np.array([bool(found[f"s{i}"]) for i in range(n)], dtype=float)
    matrix = np.diag(varies)
    for i, j in pairs:
        if varies[i] and varies[j]:
            matrix[i, j] = matrix[j, i] = found[f"c{i}_{j}"] / (found[f"s{i}"] * found[f"s{j}"])
    largest = np.linalg.eigvalsh(matrix)[::-1][: k if varies.any() else 0]
    rows = [(i + 1, float(v / varies.sum())) for i, v in enumerate(largest)]
    return df.sparkSession.createDataFrame(rows, "component int, share double")


def reboot_aware_ip(ip_totals: DataFrame, reboots: DataFrame) -> DataFrame:
    """IP-change label with the wider limits where the home also rebooted."""
    joined = ip_totals.join(reboots.select("sn", "total_reboots_count"), "sn", "left")
    rebooted = F.coalesce(F.col("total_reboots_count"), F.lit(0)) > 0
    label = F.when(rebooted, bucketize("no_ip_changes", IP_CHANGES_WITH_REBOOT)).otherwise(
        bucketize("no_ip_changes", IP_CHANGES)
    )
    return joined.select("sn", "no_ip_changes", rebooted.alias("rebooted"), label.alias("ip_change_category"))


def code_share(rows: DataFrame, code: Column) -> DataFrame:
    """Frequency of each code and its share of all coded rows."""
    counted = rows.where(code.isNotNull()).groupBy(code.alias("code")).agg(F.count(F.lit(1)).alias("n"))
    everyone = rows.where(code.isNotNull()).agg(F.count(F.lit(1))).scalar()
    return counted.withColumn("share", F.try_divide(F.col("n"), everyone))


def ingest_profile(rows: DataFrame, time: Column, unit: str = "minute") -> DataFrame:
    """Records per minute (or another unit)."""
    return rows.groupBy(F.date_trunc(unit, time).alias("slot")).agg(F.count(F.lit(1)).alias("records"))
