"""Lookups, metric cards and small tables read by people."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import text_or_na

# The columns a metric card shows, in order.
CARD_COLUMNS = (
    "sn", "model_name", "firmware", "day", "wifi_score", "reliabilityScore", "speedScore", "coverageScore",
    "numerical_reliabilityScore", "numerical_speedScore", "numerical_coverageScore", "rssi_numeric", "RSSI_category",
    "phyrate_numeric", "phyrate_category", "no_poor_airtime", "Airtime_Utilization_Category", "no_sudden_drop",
    "sudden_drop_category", "ip_change_category", "band_success_count", "steer_start_count",
    "steer_start_perHome_count", "total_reboots_count", "reboot_category", "mdm_resets_count", "user_reboot_count",
    "state", "county",
)
SNAPSHOT_COLUMNS = {
    "wifi_score": "wifi_score", "reliabilityScore": "reliabilityScore", "speedScore": "speedScore",
    "coverageScore": "coverageScore", "rssi_category": "RSSI_category", "phyrate_category": "phyrate_category",
    "reboot_category": "reboot_category", "airtime_category": "Airtime_Utilization_Category",
}
CARD_WIDTH = 38


def requests(asked: DataFrame, default_day: str) -> DataFrame:
    """Clean (sn, question, target_date) requests; blank ones are refused."""
    sn, question = F.upper(F.trim("sn")), F.trim("question")
    return asked.where((F.length(sn) > 0) & (F.length(question) > 0)).select(
        sn.alias("sn"), question.alias("question"),
        F.coalesce(F.nullif(F.trim("target_date"), F.lit("")), F.lit(default_day)).alias("target_date"),
    )


def lookup(scores: DataFrame, asked: DataFrame, day_column: str = "target_date") -> DataFrame:
    """One score row per requested (sn, day): the batched point lookup."""
    wanted = asked.select("sn", day_column).distinct()
    found = scores.join(wanted, ["sn", day_column], "left_semi")
    return found.groupBy("sn", day_column).agg(
        F.min(F.struct(*[c for c in found.columns if c not in ("sn", day_column)])).alias("_row")
    ).select("sn", day_column, "_row.*")


def metric_card(scores: DataFrame, columns: Sequence[str] = CARD_COLUMNS) -> DataFrame:
    """Each home's metrics as text lines and as a JSON snapshot."""
    have = set(scores.columns)

    def value(c: str):
        return text_or_na(F.col(c)) if c in have else F.lit("N/A")

    lines = [F.concat(F.lit(f"  {c:<{CARD_WIDTH}} = "), value(c)) for c in columns]
    snapshot = F.to_json(F.struct(*(value(c).alias(name) for name, c in SNAPSHOT_COLUMNS.items())))
    return scores.select("sn", "model_name", F.concat_ws("\n", *lines).alias("card"), snapshot.alias("snapshot"))


def code_counts(df: DataFrame, keys: Sequence[str], tests: Mapping[str, tuple[str, object]]) -> DataFrame:
    """Counters of coded columns side by side: ``{output: (column, code)}``."""
    return df.groupBy(*keys).agg(*(F.count_if(F.col(c) == v).alias(out) for out, (c, v) in tests.items()))


def distinct_settings(df: DataFrame, columns: Sequence[str], required: str, **where: object) -> DataFrame:
    """Distinct settings among rows that have the required one."""
    rows = df.where(F.col(required).isNotNull())
    for c, v in where.items():
        rows = rows.where(F.col(c) == v)
    return rows.select(*columns).distinct()
