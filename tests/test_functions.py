"""Golden rows of the KPI definitions."""

import pytest
from pyspark.sql import functions as F

from qoelens.functions import parsing as P
from qoelens.functions import profiles as R
from qoelens.functions.profiles import bucketize, label_to_score, score_to_label
from qoelens.functions.scoring import half_up, vote, weighted_mean, worst_label


def labels(spark, values, rules, kind="double"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(bucketize("x", rules)).collect()]


@pytest.mark.parametrize(
    "rules, values, expected",
    [
        (R.DAILY_RSSI["5G"], [-43, -63, -71, -81, -75, -72, -56, None], ["Excellent", "Good", "Fair", "Poor", "Fair", "Fair", "Good", "No Data"]),
        (R.DAILY_PHY["2_4G"], [79.9, 80, 100, 120], ["Poor", "Fair", "Good", "Excellent"]),
        (R.IP_CHANGES, [7, 6, 4, 3, 1, 0, None], ["Poor", "Fair", "Fair", "Good", "Good", "Excellent", "Unknown"]),
        (R.REBOOTS, [5, 4, 3, 2, 1, 0, None], ["Poor", "Fair", "Good", "Good", "Excellent", "Excellent", "Excellent"]),
        (R.USER_REBOOTS, [3, 2, 1, 0, None], ["Poor", "Fair", "Good", "Excellent", "Excellent"]),
        (R.STEER_START, [61, 60, 31, 30, 11, 10, None], ["Poor", "Fair", "Fair", "Good", "Good", "Excellent", "Excellent"]),
        (R.STEER_PER_STATION, [3.01, 3, 2, 1, None], ["Poor", "Fair", "Good", "Excellent", "Excellent"]),
        (R.SUDDEN_DROPS, [2, 1, 0, None], ["Poor", "Fair", "Good", "Excellent"]),
        (R.POOR_AIRTIME, [201, 200, 75, 74, 26, 25, 0], ["Poor", "Fair", "Fair", "Good", "Good", "Excellent", "Excellent"]),
        (R.PILLAR_AIRTIME, [39, 40, 50, 51, 70, 71], [4, 3, 3, 2, 2, 1]),
        (R.KPI_CUTS, [1.5, 1.51, 2.5, 3.5, 3.51], ["Poor", "Fair", "Fair", "Good", "Excellent"]),
        (R.PILLAR_CUTS, [1.49, 1.5, 2.5, 3.5], ["Poor", "Fair", "Good", "Excellent"]),
        (R.PILLAR_FINAL, [3.51, 3.5, 2.5, 1.5, None], [4, 3, 2, 1, 1]),
    ],
)
def test_bands(spark, rules, values, expected):
    assert labels(spark, [None if v is None else float(v) for v in values], rules) == expected


@pytest.mark.parametrize(
    "rules", [*R.STATION_HOUR_RSSI.values(), *R.PILLAR_COVERAGE.values(), *R.DAILY_RSSI.values(),
              *(p for family in R.STATION_HOUR_PHY.values() for p in family.values()),
              *(p for family in R.PILLAR_SPEED.values() for p in family.values())],
)
def test_profiles_have_no_hole_at_whole_numbers(spark, rules):
    missing = spark.range(-120, 3000).select(F.col("id").alias("x")).where(bucketize("x", rules).isNull())
    assert missing.isEmpty()


def test_labels_and_scores_are_inverse(spark):
    df = spark.createDataFrame([("Poor",), ("Fair",), ("Good",), ("Excellent",), ("No Data",), (None,)], "l string")
    df = df.withColumn("s", label_to_score("l")).withColumn("back", score_to_label("s"))
    assert [(r.s, r.back) for r in df.collect()] == [
        (1, "Poor"), (2, "Fair"), (3, "Good"), (4, "Excellent"), (None, None), (None, None)]


def test_worst_label_ignores_null(spark):
    df = spark.createDataFrame(
        [("Good", "Fair", "Poor"), ("Good", None, "Excellent"), (None, None, None)], "a string, b string, c string")
    assert [r[0] for r in df.select(worst_label("a", "b", "c")).collect()] == ["Poor", "Good", None]


def test_station_vote_needs_twelve_in_one_band(spark):
    df = spark.createDataFrame([(7, 0, 11, 1, 13, 1, 0, 0), (1, 11, 0, 0, 0, 0, 11, 2)],
                               "p5 int, p2 int, f5 int, f2 int, g5 int, g2 int, e5 int, e2 int")
    counts = {"Poor": ["p5", "p2"], "Fair": ["f5", "f2"], "Good": ["g5", "g2"], "Excellent": ["e5", "e2"]}
    assert [r[0] for r in df.select(vote(counts, 12)).collect()] == ["Good", "No Data"]


def test_weighted_mean_renormalises(spark):
    df = spark.createDataFrame([(1.0, 3.0), (None, 3.0), (None, None)], "a double, b double")
    got = [r[0] for r in df.select(weighted_mean({"a": 0.25, "b": 0.75})).collect()]
    assert got == [pytest.approx(2.5), pytest.approx(3.0), None]


def test_half_up_is_free_of_summation_noise(spark):
    df = spark.createDataFrame([(3.2249999999999996,), (0.125,)], "x double")
    assert [r[0] for r in df.select(half_up(F.col("x"), 2)).collect()] == [3.23, 0.13]


def test_keys_and_rates(spark):
    df = spark.createDataFrame([("7145-ABV30117145_78670EE00AAC", "144.4Mbps"), ("7145-ABV30117145_X", ""), ("x", None)], "k string, r string")
    got = df.select(
        P.serial(F.col("k")), P.serial(F.col("k"), P.ROUTER_UPPER), P.serial(F.col("k"), P.ROUTER_SERIAL),
        P.rate_mbps(F.col("r")), P.rate_without_unit(F.col("r")), P.rowkey_of(P.serial(F.col("k"))),
    ).collect()
    assert tuple(got[0]) == ("ABV30117145", "ABV30117145", "ABV30117145", 144.4, 144, "7145-ABV30117145")
    assert got[1][3] is None and got[1][4] is None and got[2][3] is None


def test_band_family(spark):
    df = spark.createDataFrame([("2.4GI",), ("5GH",), ("6G",), ("ETH",), (None,)], "c string")
    assert [r[0] for r in df.select(P.band_family(F.col("c"))).collect()] == ["2_4G", "5G", "6G", "ETH", None]
