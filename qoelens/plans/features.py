"""Device feature table: one row per row key, one pass per source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import top_rows
from ..operators.shape import merge_features

# Accepted radio modes and bandwidth codes.
MODES, BANDWIDTHS = (5, 11), (0, 5)
NEIGHBOUR_BANDS = ("2_4g", "5g", "6g")


def _whole(value: Column) -> Column:
    return value.try_cast("decimal(10,0)")


def top_names(history: DataFrame, k: int = 10) -> DataFrame:
    """The k most frequent station names of a row key, most frequent first."""
    name = F.col("Station_Data_connect_data.station_name").alias("station_name")
    counted = history.select("rowkey", name).groupBy("rowkey", "station_name").count()
    best = top_rows(counted, ["rowkey"], [F.desc("count"), F.col("station_name").asc_nulls_last()], k)
    ranked = F.array_sort(F.collect_list(F.when(F.col("station_name").isNotNull(), F.struct("rank", "station_name"))))
    return best.groupBy("rowkey").agg(F.transform(ranked, lambda x: x["station_name"]).alias("top_10_station_names"))


def station_features(history: DataFrame) -> DataFrame:
    """Signal by band, bytes, radio mode, bandwidth, airtime, channel, steering."""
    c = "Station_Data_connect_data"
    code = F.substring(F.col(f"{c}.connect_type"), 1, 2)
    signal = F.col(f"{c}.signal_strength").cast("long")
    mode, bandwidth = _whole(F.col(f"{c}.mode")), _whole(F.col(f"{c}.bw"))

    def band_average(band: str, name: str) -> Column:
        return F.round(F.avg(F.when(code == band, signal)), 2).alias(name)

    def occurrences(test: Column, name: str) -> Column:
        return F.nullif(F.count_if(test), F.lit(0)).alias(name)

    return history.groupBy("rowkey").agg(
        band_average("2.", "avg_2_4_signal_strength"),
        band_average("5G", "avg_5G_signal_strength"),
        band_average("6G", "avg_6G_signal_strength"),
        F.sum(f"{c}.diff_bs").alias("total_byte_send"),
        F.sum(f"{c}.diff_br").alias("total_byte_received"),
        occurrences(mode.between(*MODES), "total_count_mode"),
        F.avg(F.when(bandwidth.between(*BANDWIDTHS), bandwidth)).alias("avg_bandwidth"),
        F.avg(_whole(F.col(f"{c}.airtime_util"))).alias("avg_airtime_util"),
        F.avg(_whole(F.col(f"{c}.channel"))).alias("avg_channel"),
        occurrences(F.col("Diag_Result_band_steer.sta_type") == "2", "band_steer"),
        occurrences(F.col("Diag_Result_ap_steer.sta_type") == "2", "ap_steer"),
    )


def router_features(owl: DataFrame) -> DataFrame:
    """Restarts from the user interface and all channel reports."""
    gui = F.col("Diag_Result_dev_restart.reason") == "GUI"
    return owl.groupBy("rowkey").agg(
        F.nullif(F.count_if(gui), F.lit(0)).alias("restart_GUI"), F.count(F.lit(1)).alias("ch_change")
    )


def feature_table(history: DataFrame, owl: DataFrame) -> DataFrame:
    return merge_features([top_names(history), station_features(history), router_features(owl)], "rowkey")


def heard(scans: DataFrame, *more: str) -> DataFrame:
    """(rowkey, more, band, bssid) of every access point in every scan; bssid is NULL where a scan heard none."""
    by_band = F.array(
        *(
            F.struct(F.lit(b).alias("band"), F.flatten(F.col(f"wifi_scan_wifi_ap_data_{b}.data")).alias("points"))
            for b in NEIGHBOUR_BANDS
        )
    )
    scanned = scans.select("rowkey", *more, F.explode(by_band).alias("s"))
    points = scanned.select("rowkey", *more, "s.band", F.explode("s.points").alias("point"))
    return points.select("rowkey", *more, "band", F.col("point.bssid").alias("bssid"))


def _bit(band: Column) -> Column:
    """A bit for each band."""
    return F.element_at(F.create_map(*(F.lit(x) for i, b in enumerate(NEIGHBOUR_BANDS) for x in (b, 1 << i))), band)


def heard_once(scans: DataFrame, *more: str) -> DataFrame:
    """(rowkey, more, bssid, bands): every access point once, with a bit for each band it was heard on.

    What a task holds, and what travels, is a row per access point, whatever
    number of scans and bands had it.
    """
    return heard(scans, *more).groupBy("rowkey", *more, "bssid").agg(F.bit_or(_bit(F.col("band"))).alias("bands"))


def by_band(points: DataFrame) -> DataFrame:
    """The rows of ``heard_once``, one for each band."""
    bands = F.array(*(F.lit(b) for b in NEIGHBOUR_BANDS))
    each = F.explode(F.filter(bands, lambda b: F.col("bands").bitwiseAND(_bit(b)) != 0))
    return points.withColumn("band", each).drop("bands")


def neighbours(scans: DataFrame) -> DataFrame:
    """Distinct access points heard per band; NULL where a band heard none.

    One pass: every point is deduplicated across the cluster before
    it is counted, whatever number of scans a router sent.
    """
    points = heard_once(scans)
    on = {b: F.col("bands").bitwiseAND(_bit(F.lit(b))) != 0 for b in NEIGHBOUR_BANDS}
    counts = [F.count_if(on[b] & F.col("bssid").isNotNull()).alias(f"_{b}") for b in NEIGHBOUR_BANDS]
    seen = [F.count_if(on[b]).alias(f"_any_{b}") for b in NEIGHBOUR_BANDS]
    return points.groupBy("rowkey").agg(*counts, *seen).select(
        "rowkey",
        *(F.when(F.col(f"_any_{b}") > 0, F.col(f"_{b}")).alias(f"distinct_{b}_bssid_count") for b in NEIGHBOUR_BANDS),
    )
