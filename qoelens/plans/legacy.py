"""Percentage-based home score, device roles and the consumption report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import parsing as P
from ..functions.scoring import half_up, log_volume
from ..operators.histogram import percentiles_of_counts, value_counts
from ..operators.skew import keep_members, materialise, share_of_total
from ..operators.stationarity import POINTS, judge, with_bound

DEVICE = ["rowkey", "rk_row_sn", "serial_num", "station_mac"]
HOME = ["serial_num", "mdn", "cust_id"]

# Weak-signal limits by band code, rate limits, record minimum.
WEAK = {"2.": -78, "5G": -75, "6G": -70}
RATE_LOW, RATE_HIGH, CONTROL_RATES = 6, 2500, (12, 24)
POOR_RATE, SLOW_RATE = 65, 20.718
MIN_RECORDS = 36


def home_records(history: DataFrame) -> DataFrame:
    """Wireless station reports with signal and rate, keys cut by position."""
    c = "Station_Data_connect_data"
    serial = F.substring(F.col("rowkey"), F.lit(6), F.length("rowkey") - F.lit(18))
    band = F.substring(F.col(f"{c}.connect_type"), 1, 2)
    return (
        history.select(
            "rowkey",
            F.concat_ws("-", F.substring("rowkey", 1, 4), serial).alias("rk_row_sn"),
            serial.alias("serial_num"),
            F.col(f"{c}.station_mac").alias("station_mac"),
            F.col(f"{c}.parent_id").alias("parent_id"),
            F.col(f"{c}.signal_strength").cast("long").alias("signal"),
            P.rate_without_unit(F.col(f"{c}.tx_link_rate")).alias("rate"),
            band.alias("band"),
            F.col(f"{c}.diff_bs").cast("long").alias("byte_send"),
            F.col(f"{c}.diff_br").cast("long").alias("byte_received"),
        )
        .where(F.col("band").isin(*WEAK))
        .dropna(subset=["signal", "rate"])
    )


def signal_levels(records: DataFrame) -> DataFrame:
    """Everything summed per (device, parent, signal level): the one pass over the records."""
    weak = " OR ".join(f"(band = '{band}' AND signal < {limit})" for band, limit in WEAK.items())
    usable = f"rate > {RATE_LOW} AND rate < {RATE_HIGH} AND rate NOT IN {CONTROL_RATES}"
    sums = {
        "weak": F.expr(f"count_if({weak})"),
        "usable": F.expr(f"count_if({usable})"),
        "poor": F.expr(f"count_if({usable} AND rate < {POOR_RATE})"),
        "rates": F.expr(f"sum(if({usable}, rate, 0))"),
        "byte_send": F.sum("byte_send"),
        "byte_received": F.sum("byte_received"),
    }
    for i, band in enumerate(WEAK, start=1):
        sums[f"_on_{i}"] = F.expr(f"count_if(band = '{band}')")
        sums[f"_signal_{i}"] = F.expr(f"sum(if(band = '{band}', signal, 0))")
    return value_counts(records, [*DEVICE, "parent_id"], "signal", **sums)


def device_features(levels: DataFrame) -> DataFrame:
    """Weak-signal and low-rate shares, volume and weight per device; devices
    with at least 36 records, one usable rate and a surviving signal.

    The sums per signal level also give the percentiles behind the stationarity flag.
    """
    sums = [c for c in levels.columns if c not in (*DEVICE, "parent_id", "signal", "n")]
    devices = judge(with_bound(percentiles_of_counts(levels, DEVICE, "signal", POINTS, sums=sums)))
    slow = f"avg_phyrate < {SLOW_RATE} AND stationarity = '1'"
    return (
        devices.where(f"n >= {MIN_RECORDS} AND usable > 0")
        .withColumns(
            {
                "avg_phyrate": F.expr("rates / usable"),
                "poor_rssi": F.expr("weak / n * 100"),
                "poor_phyrate": F.expr("poor / usable * 100"),
                "volume": log_volume("byte_send", "byte_received"),
            }
            | {f"avg_sig_strength_cat{i}": F.expr(f"try_divide(_signal_{i}, _on_{i})") for i in range(1, len(WEAK) + 1)}
        )
        .withColumn("weight", F.expr(f"if({slow}, volume * avg_phyrate / {SLOW_RATE}, volume)"))
        .withColumn("device_score", F.expr("(100 - poor_rssi) * 0.5D + (100 - poor_phyrate) * 0.5D"))
        .select(
            *DEVICE, "stationarity", "avg_phyrate", "poor_rssi", "poor_phyrate", "byte_send", "byte_received", "volume",
            "weight", "device_score", *(f"avg_sig_strength_cat{i}" for i in range(1, len(WEAK) + 1)),
        )
    )


def group_devices(groups: DataFrame) -> DataFrame:
    """Routers and extenders of each group record.

    The largest of texts is found by sorting, so the boxes are written without
    their repeats first: what is sorted are boxes, not records.
    """
    boxes = groups.select("rowkey", F.explode("Group_Data_sys_info").alias("d")).select(
        F.col("rowkey").alias("dg_rowkey"), F.col("d.mac").alias("RouExt_mac"), F.col("d.model").alias("dg_model"), "d.parent_mac", "d.fw"
    )
    return (
        materialise(boxes.distinct(), "boxes")
        .groupBy("dg_rowkey", "RouExt_mac", "dg_model")
        .agg(F.max("parent_mac").alias("parent_mac"), F.max("fw").alias("firmware"))
    )


def with_roles(devices: DataFrame, group_table: DataFrame) -> DataFrame:
    """Every device with the box it hangs on; ``Rou_Ext`` is 1 for an extender."""
    on = [F.col("dg_rowkey") == F.col("rk_row_sn"), F.col("RouExt_mac") == F.col("parent_id")]
    return group_table.join(devices, on, "right").withColumn(
        "Rou_Ext", F.when(F.col("parent_mac").isNotNull(), 1).otherwise(0)
    )


def attachments(records: DataFrame) -> DataFrame:
    """Which parents each device was seen on; ``records`` or their signal levels."""
    return records.select(*DEVICE, "parent_id").distinct()


PARENT_SETS = ("RouExt_mac", "dg_model", "parent_mac", "firmware", "parent_id", "Rou_Ext")


def parents(records: DataFrame, groups: DataFrame) -> DataFrame:
    """Sets of the boxes each device hung on, with their models and roles."""
    roles = with_roles(attachments(records), group_table=group_devices(groups))
    return roles.groupBy(*DEVICE).agg(*(F.collect_set(c).alias(c) for c in PARENT_SETS))


def device_table(records: DataFrame, groups: DataFrame, mapping: DataFrame, date: str) -> DataFrame:
    """One row per device: its line, its nine measures (``weights`` is its share of the
    home's log volume) and the sets of its parents.

    The records are read once: their signal levels are written, and so are the
    devices, which are summed per home and meet the sums again.
    """
    levels = materialise(signal_levels(records), "signal-levels")
    shares = share_of_total(materialise(device_features(levels), "devices"), ["serial_num"], "volume", "weights")
    measures = [
        "avg_phyrate", "poor_phyrate", F.col("stationarity").cast("double").alias("stationarity"), "volume", "weights", "poor_rssi",
        *(f"avg_sig_strength_cat{i}" for i in range(1, len(WEAK) + 1)),
    ]
    lines = mapping.join(shares, "serial_num", "right").select("serial_num", "mdn", "cust_id", *DEVICE[:2], DEVICE[3], *measures)
    return lines.join(parents(levels, groups), DEVICE).withColumn("date", F.lit(date))


def home_percentages(records: DataFrame, groups: DataFrame, mapping: DataFrame, date: str) -> DataFrame:
    """Volume-weighted shares and score per home, one row per router model.

    Weights are only ever used as shares of their home, so the home sums
    normalise them: sum(score * weight) / sum(weight).
    """
    levels = materialise(signal_levels(records), "signal-levels")
    devices = mapping.join(device_features(levels), "serial_num", "right")
    hangs_on = parents(levels, groups).select(*DEVICE, F.col("dg_model").alias("_models"), F.col("Rou_Ext").alias("_roles"))

    def weighted(c: str):
        return half_up(F.try_divide(F.sum(F.col(c) * F.col("weight")), F.sum("weight")), 4).alias(out[c])

    out = {"poor_rssi": "poor_rssi", "poor_phyrate": "poor_phyrate", "device_score": "home_score"}
    homes = (
        devices.join(hangs_on, DEVICE)
        .groupBy(*HOME)
        .agg(
            F.count(F.lit(1)).alias("num_station"),
            *(weighted(c) for c in out),
            F.array_distinct(F.flatten(F.collect_set("_models"))).alias("dg_model"),
            F.array_distinct(F.flatten(F.collect_set("_roles"))).alias("Rou_Ext"),
        )
    )
    return homes.withColumn("dg_model_indiv", F.explode("dg_model")).withColumn("date", F.lit(date))


def station_bytes(history: DataFrame) -> DataFrame:
    """Bytes per station and band."""
    c = "Station_Data_connect_data"
    return history.groupBy(
        P.serial(F.col("rowkey"), P.ROUTER_SERIAL).alias("sn"), "rowkey",
        P.band_family(F.col(f"{c}.connect_type")).alias("connect_type"),
    ).agg(F.sum(f"{c}.diff_bs").alias("byte_send"), F.sum(f"{c}.diff_br").alias("byte_received"))


def consumption_report(
    used: DataFrame, devices: DataFrame, scores: DataFrame, bands: Sequence[str] = ("2_4G", "5G")
) -> DataFrame:
    """Data volume by home score and band, over stations with a known class."""
    return (
        keep_members(used.where(F.col("connect_type").isin(*bands)), devices, ["rowkey"])
        .join(scores.select("sn", "score"), "sn")
        .groupBy("score", "connect_type")
        .agg(F.sum(F.col("byte_send") + F.col("byte_received")).alias("data_volume"))
        .orderBy("score", "connect_type")
    )


def consumption_by_class(
    used: DataFrame, classes: DataFrame, scores: DataFrame, models: Sequence[str], bands: Sequence[str] = ("2_4G", "5G")
) -> DataFrame:
    """Data volume by the home's overall score, device class and band, over homes of ``models``.

    A station of two classes counts in both; one without a class or whose home has no
    score counts nowhere. Volumes are summed per (station's home, class, band) before they
    meet the scores, so a home joins with as many rows as it has classes and bands.
    """
    known = classes.select("rowkey", "device_class").distinct()
    stations = used.where(F.col("connect_type").isin(*bands)).join(known, "rowkey")
    homes = stations.groupBy("sn", "device_class", "connect_type").agg(
        F.sum(F.col("byte_send") + F.col("byte_received")).alias("data_volume")
    )
    rated = scores.where(F.col("model_name").isin(*models)).select("sn", F.col("wifi_score").alias("score")).distinct()
    return homes.join(rated, "sn").groupBy("score", "device_class", "connect_type").agg(F.sum("data_volume").alias("data_volume"))
