"""Threshold profiles: each KPI's bands as text, turned into one CASE.

Values are given as SQL text (a column name or an expression): one parsed CASE
costs the driver far less than a chain of column calls.

A profile lists ``outcome: interval`` pairs in the order they are tried; the
first interval that holds the value wins. ``[``/``]`` include the bound,
``(``/``)`` exclude it, an empty side is unbounded.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

LABELS = ("Poor", "Fair", "Good", "Excellent")

_INTERVAL = re.compile(r"^([\[(])\s*([^,]*?)\s*,\s*([^,]*?)\s*([\])])$")


@dataclass(frozen=True)
class Profile:
    bands: tuple[tuple[object, str], ...]
    other: object = None
    when_null: object = None


def profile(*bands: tuple[object, str], other: object = None, when_null: object = None) -> Profile:
    for _, text in bands:
        if not _INTERVAL.match(text):
            raise ValueError(f"not an interval: {text}")
    return Profile(tuple(bands), other, when_null)


def labelled(poor: str, fair: str, good: str, excellent: str, **kw) -> Profile:
    return profile(*zip(LABELS, (poor, fair, good, excellent)), **kw)


def scored(one: str, two: str | None, three: str | None, four: str, **kw) -> Profile:
    """Bands for the numeric scores 4..1, best tried first."""
    ranges = ((4, four), (3, three), (2, two), (1, one))
    return profile(*((s, r) for s, r in ranges if r), **kw)


def literal(value: object) -> str:
    return f"'{value}'" if isinstance(value, str) else str(value)


def inside(value: str, interval: str) -> str:
    left, low, high, right = _INTERVAL.match(interval).groups()
    tests = []
    if low:
        tests.append(f"{value} {'>=' if left == '[' else '>'} {float(low)}D")
    if high:
        tests.append(f"{value} {'<=' if right == ']' else '<'} {float(high)}D")
    return " AND ".join(tests) or f"{value} IS NOT NULL"


def bucket_sql(value: str, rules: Profile) -> str:
    """First matching band of ``rules``; ``when_null`` for NULL, else ``other``."""
    value = f"({value})"
    branches = [f"WHEN {inside(value, interval)} THEN {literal(outcome)}" for outcome, interval in rules.bands]
    if rules.when_null is not None:
        branches.append(f"WHEN {value} IS NULL THEN {literal(rules.when_null)}")
    other = "" if rules.other is None else f" ELSE {literal(rules.other)}"
    return f"CASE {' '.join(branches)}{other} END"


def bucketize(value: str, rules: Profile) -> Column:
    return F.expr(bucket_sql(value, rules))


# --------------------------------------------------------------------------
# Thresholds that must equal the published KPI definitions.
# --------------------------------------------------------------------------

IP_CHANGES = labelled("(6,)", "[4,6]", "[1,3]", "[0,0]", other="Unknown")
IP_CHANGES_WITH_REBOOT = labelled("(16,)", "[7,16]", "[1,6]", "[0,0]", other="Unknown")
POOR_AIRTIME = labelled("(200,)", "[75,200]", "[26,74]", "[0,)", other="Unknown")
STEER_START = labelled("(60,)", "[31,60]", "[11,30]", "(,10]", other="Unknown", when_null="Excellent")
STEER_PER_STATION = labelled("(3,)", "(2,3]", "(1,2]", "(,1]", other="Unknown", when_null="Excellent")
REBOOTS = labelled("[5,)", "[4,4]", "[2,3]", "[0,)", when_null="Excellent")
USER_REBOOTS = labelled("[3,)", "[2,2]", "[1,1]", "[0,0]", when_null="Excellent")
SUDDEN_DROPS = profile(("Poor", "[2,)"), ("Fair", "[1,1]"), other="Good", when_null="Excellent")

DAILY_RSSI = {
    "2_4G": labelled("(,-78)", "[-78,-71]", "[-72,-56]", "(-56,)", other="No Data"),
    "5G": labelled("(,-75)", "[-75,-71]", "[-72,-56]", "(-56,)", other="No Data"),
    "6G": labelled("(,-70)", "[-70,-65]", "[-66,-56]", "(-56,)", other="No Data"),
}
DAILY_PHY = {
    "2_4G": labelled("(,80)", "[80,100)", "[100,120)", "[120,)", other="No Data"),
    "5G": labelled("(,200)", "[200,300)", "[300,500)", "[500,)", other="No Data"),
    "6G": labelled("(,200)", "[200,300)", "[300,500)", "[500,)", other="No Data"),
}

STATION_HOUR_RSSI = {
    "2_4G": scored("(,-85)", "[-85,-76]", "[-75,-66]", "[-65,)"),
    "5G": scored("(,-88)", "[-88,-79]", "[-78,-69]", "[-68,)"),
    "6G": scored("(,-82)", "[-82,-73]", "[-72,-63]", "[-62,)"),
}
STATION_HOUR_PHY = {
    "station_hour_mode": {
        "2_4G": scored("(,12)", "[12,71]", "[72,144]", "(144,)"),
        "5G": scored("(,86)", "[86,299]", "[300,600]", "(600,)"),
        "6G": scored("(,286)", "[286,599]", "[600,1200]", "(1200,)"),
    },
    "station_hour_deployed": {
        "2_4G": scored("(,1)", None, None, "[1,)"),
        "5G": scored("(,100)", "[100,199]", "[200,399]", "[400,)"),
        "6G": scored("(,200)", "[200,599]", "[600,1199]", "[1200,)"),
    },
    "station_hour_v1": {
        "2_4G": scored("(,10)", "[10,19]", "[20,49]", "[50,)"),
        "5G": scored("(,50)", "[50,99]", "[100,199]", "[200,)"),
    },
}
#: Old radios cannot go faster than this many Mbps: radio mode range -> rate cap.
LEGACY_MODE_CAPS = (((0, 0), 2), ((1, 2), 11), ((3, 3), 24), ((4, 7), 12), ((8, 29), 6))

PILLAR_SPEED = {
    "pillar_current": {
        "2_4G": scored("(,10)", "[10,19]", "[20,49]", "[50,)"),
        "5G": scored("(,50)", "[50,99]", "[100,199]", "[200,)"),
        "6G": scored("(,50)", "[50,99]", "[100,199]", "[200,)"),
    },
    "pillar_v1": {
        "2_4G": scored("(,80)", "[80,100]", "[101,120]", "(120,)"),
        "5G": scored("(,200)", "[200,300]", "[301,400]", "(400,)"),
    },
}
PILLAR_COVERAGE = {
    "2_4G": scored("(,-79)", "[-79,-71]", "[-70,-56]", "[-55,)"),
    "5G": scored("(,-77)", "[-77,-71]", "[-70,-56]", "[-55,)"),
    "6G": scored("(,-77)", "[-77,-71]", "[-70,-56]", "[-55,)"),
}
PILLAR_AIRTIME = profile((4, "(,40)"), (3, "[40,50]"), (2, "[50,70]"), other=1)
PILLAR_FINAL = profile((4, "(3.5,)"), (3, "(2.5,)"), (2, "(1.5,)"), other=1)
STATION_FINAL = profile((4, "[4,)"), (3, "[3,3]"), (2, "[2,2]"), other=1)

#: KPI averages cut just above the half; pillar averages cut at the half.
KPI_CUTS = labelled("(,1.5]", "(1.5,2.5]", "(2.5,3.5]", "(3.5,)")
PILLAR_CUTS = labelled("(,1.5)", "[1.5,2.5)", "[2.5,3.5)", "[3.5,)")


def label_score_sql(label: str) -> str:
    branches = " ".join(f"WHEN '{name}' THEN {score}" for score, name in enumerate(LABELS, start=1))
    return f"CASE {label} {branches} END"


def score_label_sql(score: str) -> str:
    branches = " ".join(f"WHEN {value} THEN '{name}'" for value, name in enumerate(LABELS, start=1))
    return f"CASE {score} {branches} END"


def label_to_score(label: str) -> Column:
    return F.expr(label_score_sql(label))


def score_to_label(score: str) -> Column:
    """Exact scores 1..4 back to their labels; anything else is NULL."""
    return F.expr(score_label_sql(score))
