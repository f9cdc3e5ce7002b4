"""Hourly scores: connection records -> station score -> home score.

Every job takes any number of hours at once; ``date`` and ``hour`` are part of
all keys, so one run may score an hour or backfill a month.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import parsing as P
from ..functions import profiles as R
from ..functions.percentiles import band_value, percentiles
from ..functions.profiles import bucketize
from ..functions.scoring import half_up, least_available, mean_of_available
from ..operators.histogram import percentiles_of_counts, value_counts
from ..operators.ranking import heavy_hitter_blend
from ..operators.skew import join_back, materialise

HOME = ["sn", "date", "hour"]
STATION = ["sn", "station_mac", "date", "hour"]

# Eligibility limits of the scorers.
STATION_MIN_RECORDS = 9
PILLAR_MIN_RECORDS = 8
CONTROL_RATE = 24
CONSUMPTION_LIMIT = 1_875_000_000
SNR_RANGE, STEERS, RATE_RANGE_24, RATE_RANGE_5 = 13, 6, 30, 300


# ---------------------------------------------------------------- enrichment


def connection_records(history: DataFrame, *extra: str) -> DataFrame:
    """Nested station reports as one flat, numeric row each."""
    return history.selectExpr(
        f"regexp_extract(rowkey, r'{P.ROUTER_UPPER}', 1) AS sn",
        "rowkey",
        "Station_Data_connect_data.station_mac",
        "Station_Data_connect_data.station_name",
        "Station_Data_connect_data.connect_type AS band",
        "Station_Data_connect_data.signal_strength AS rssi",
        "Station_Data_connect_data.snr",
        "int(try_cast(replace(Station_Data_connect_data.link_rate, 'Mbps') AS double)) AS phy_rate",
        "int(try_cast(replace(Station_Data_connect_data.tx_link_rate, 'Mbps') AS double)) AS tx_phy_rate",
        "Station_Data_connect_data.mode",
        "Tplg_Data_model_name AS model",
        "date_format(timestamp_millis(ts), 'HH') AS hour",
        "date_format(timestamp_millis(ts), 'yyyyMMdd') AS date",
        *extra,
    )


#: A steering record whose band action is ``1``.
STEERING_SUCCESS = (
    "(Diag_Result_band_steer.sta_type IS NOT NULL OR Diag_Result_ap_steer.sta_type IS NOT NULL) "
    "AND Diag_Result_band_steer.action = '1'"
)


def steering_successes(history: DataFrame) -> DataFrame:
    """Steering successes per row key and hour; only keys that have any."""
    hours = [P.day_of(F.col("ts")).alias("date"), P.day_of(F.col("ts"), "HH").alias("hour")]
    return history.where(STEERING_SUCCESS).groupBy("rowkey", *hours).agg(F.count(F.lit(1)).alias("son"))


#: What a signal count and the enrichment of a record belong to.
REPORTER = ["date", "hour", "sn", "station_mac", "rowkey"]


def signal_counts(history: DataFrame) -> DataFrame:
    """Records ``n`` and steering successes ``son`` per station, hour and signal level, written once.

    The one pass over the records that percentiles, steering counts, mobility and the station list share.
    """
    flagged = connection_records(history, f"{STEERING_SUCCESS} AS _success")
    return materialise(value_counts(flagged, REPORTER, "rssi", son=F.count_if(F.col("_success"))), "signal-counts")


def station_enrichment(history: DataFrame, mobility: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Signal percentiles, steering count, mobility and records ``n`` of every station and hour.

    ``counts`` are the history's ``signal_counts``, which are made unless given.
    """
    mac_hour = ["date", "hour", "station_mac"]
    counts = signal_counts(history) if counts is None else counts
    # One row per level of a MAC, however many homes a placeholder MAC appears in.
    levels = counts.groupBy(*mac_hour, "rssi").agg(F.sum("n").alias("n"))
    signal = percentiles_of_counts(levels, mac_hour, "rssi", {"p50_rssi": 0.5, "p90_rssi": 0.9}).drop("top", "n")
    signal = signal.withColumnsRenamed({k: f"_s_{k}" for k in mac_hour})
    same_mac = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in mac_hour))
    steers = counts.groupBy("rowkey", "date", "hour").agg(F.nullif(F.sum("son"), F.lit(0)).alias("son"))
    return (
        counts.groupBy(*REPORTER).agg(F.sum("n").alias("n"))
        .join(signal, same_mac, "left").drop(*signal.columns[:3])
        .join(steers, ["rowkey", "date", "hour"], "left")
        .join(mobility.select("sn", "station_mac", "mobility_status"), ["sn", "station_mac"], "left")
    )


def enrich(history: DataFrame, mobility: DataFrame, counts: DataFrame | None = None, **join_options) -> DataFrame:
    """Connection records with signal percentiles, steering count and mobility.

    The additions meet on the small station table, so the records themselves are
    read once for their counts and joined once.
    """
    return enrich_records(history, station_enrichment(history, mobility, counts), **join_options)


def enrich_records(history: DataFrame, stations: DataFrame, **join_options) -> DataFrame:
    """Connection records with the columns of their ``station_enrichment``."""
    return join_back(connection_records(history), stations, REPORTER, size="n", **join_options)


def enrich_contract(records: DataFrame, **join_options) -> DataFrame:
    """Enrichment of already flat records: percentiles and mobility by station
    alone (p90 - p50 <= 5, no outlier rule), no steering."""
    counts = value_counts(records, ["station_mac"], "rssi")
    signal = percentiles_of_counts(counts, ["station_mac"], "rssi", {"p50_rssi": 0.5, "p90_rssi": 0.9})
    still = F.when(F.col("p90_rssi") - F.col("p50_rssi") <= 5, "Stationary").otherwise("Non-stationary")
    stats = signal.drop("top", "n").withColumn("mobility_status", still)
    joined = join_back(records, stats, ["station_mac"], how="left", **join_options)
    joined = joined.fillna({"mobility_status": "Non-stationary"})
    return joined if "son" in joined.columns else joined.withColumn("son", F.lit(0))


# ------------------------------------------------------------- station score


def scorable(records: DataFrame) -> DataFrame:
    """Drop no-signal sentinels, records without any metric and wired stations."""
    sentinel = (F.col("phy_rate") == 0) & (F.col("rssi") == 0) & (F.col("p90_rssi") == -100)
    metric = F.col("p90_rssi").isNotNull() | F.col("phy_rate").isNotNull() | F.col("snr").isNotNull()
    wireless = F.col("band").isNotNull() & ~F.col("band").isin(*P.WIRED)
    return records.where(~sentinel).where(metric).where(wireless)


def _suffix(band: str) -> str:
    return band.lower()


def rate_score(rate: str, mode: str, rules: R.Profile, legacy_caps: bool) -> Column:
    """Rate bands; an old radio at or below its mode's cap counts as excellent."""
    if not legacy_caps:
        return bucketize(rate, rules)
    capped = " OR ".join(
        f"({mode} BETWEEN {low} AND {high} AND {rate} <= {cap})" for (low, high), cap in R.LEGACY_MODE_CAPS
    )
    return F.expr(f"CASE WHEN {capped} THEN 4 ELSE {R.bucket_sql(rate, rules)} END")


def _value_range(value: str) -> Column:
    return F.expr(f"max({value}) - min({value})").cast("double")


def station_score(
    records: DataFrame, profile: str = "station_hour_mode", min_records: int = STATION_MIN_RECORDS
) -> DataFrame:
    """Score 1..4 per station and hour, from one aggregation over the records."""
    rate_rules = R.STATION_HOUR_PHY[profile]
    bands = list(rate_rules)
    grouped = (
        scorable(records)
        .groupBy(*STATION)
        .agg(
            F.count(F.lit(1)).alias("_records"),
            F.max("model").alias("model"),
            F.max("mobility_status").alias("mobility_status"),
            F.max("station_name").alias("station_name"),
            F.max(F.col("mode").cast("int")).alias("mode"),
            *(percentiles(band_value("p90_rssi", b), (0.9, 0.5, 0.95)).alias(f"_rssi_{b}") for b in bands),
            *(percentiles(band_value("phy_rate", b), (0.9,)).alias(f"_phy_{b}") for b in bands),
            _value_range("snr").alias("snr_range"),
            F.count_if(F.col("son") >= 1).alias("son_count"),
            _value_range(band_value("phy_rate", "2_4G")).alias("phy_rate_range_2_4g"),
            _value_range(band_value("phy_rate", "5G")).alias("phy_rate_range_5g"),
        )
        .where(F.col("_records") >= min_records)
    )
    levels = {}
    for b in bands:
        for i, p in enumerate(("p90", "p50", "p95")):
            levels[f"{p}_rssi_{_suffix(b)}"] = F.get(f"_rssi_{b}", F.lit(i))
        levels[f"p90_phy_rate_{_suffix(b)}"] = F.get(f"_phy_{b}", F.lit(0))
    flat = grouped.withColumns(levels)

    rssi = {b: f"rssi_score_{_suffix(b)}" for b in bands}
    phy = {b: f"phy_rate_score_{_suffix(b)}" for b in bands}
    legacy = profile == "station_hour_mode"
    scores = {rssi[b]: bucketize(f"p90_rssi_{_suffix(b)}", R.STATION_HOUR_RSSI[b]) for b in bands}
    scores |= {
        phy[b]: rate_score(f"p90_phy_rate_{_suffix(b)}", "mode", rate_rules[b], legacy) for b in bands
    }
    unstable = (
        (F.col("snr_range") > SNR_RANGE)
        | (F.col("son_count") > STEERS)
        | (F.col("phy_rate_range_2_4g") > RATE_RANGE_24)
        | (F.col("phy_rate_range_5g") > RATE_RANGE_5)
    )
    scored = (
        flat.withColumns(scores)
        .withColumn("final_rssi_score", least_available(rssi.values()))
        .withColumn("final_phy_rate_score", least_available(phy.values()))
        .where(F.col("final_rssi_score").isNotNull() | F.col("final_phy_rate_score").isNotNull())
        .withColumn("base_score", F.least("final_rssi_score", "final_phy_rate_score"))
        .withColumn("variation_score", F.when(unstable, 1).otherwise(0))
        .withColumn("station_score_num", bucketize("base_score - variation_score", R.STATION_FINAL))
        .withColumn("station_score", R.score_to_label("station_score_num"))
    )
    silent = _any_equal([c for c in levels if "rssi" in c], -100)
    stalled = _any_equal([c for c in levels if "phy" in c], 0)
    return scored.where(~(silent & stalled)).select(
        "sn", "station_mac", "station_name", "model", "mobility_status", "date", "hour",
        *(F.col(c).alias(f"{c}_base") for c in (*levels, *rssi.values(), *phy.values())),
        "final_rssi_score", "final_phy_rate_score",
        *(
            F.col(c).alias(f"{c}_variation")
            for c in ("snr_range", "son_count", "phy_rate_range_2_4g", "phy_rate_range_5g")
        ),
        "base_score", "variation_score", "station_score", "station_score_num",
    )


def _any_equal(columns: Sequence[str], value: float) -> Column:
    return F.expr(" OR ".join(f"coalesce({c} = {value}, false)" for c in columns))


# ---------------------------------------------------------------- home score


def consumption(history: DataFrame, limit: int = CONSUMPTION_LIMIT) -> DataFrame:
    """Bytes per station and hour; totals at or above ``limit``, and those beyond
    38 digits, are dropped as counter faults."""
    c = "Station_Data_connect_data"
    sent, received = (F.col(f"{c}.{x}").try_cast("decimal(38,0)") for x in ("bs", "br"))
    return (
        history.where(F.col(c).isNotNull())
        .groupBy(
            P.serial(F.col("rowkey"), P.ROUTER_OF_BYTES).alias("sn"),
            F.col(f"{c}.station_mac").alias("station_mac"),
            P.day_of(F.col("ts")).alias("date"),
            P.day_of(F.col("ts"), "HH").alias("hour"),
        )
        .agg(F.try_sum(F.try_add(sent, received)).alias("total_bytes"))
        .where(F.col("total_bytes") < limit)
    )


def pillar_features(
    records: DataFrame, bands: Sequence[str] = P.BANDS, snr_max: int = 95, min_records: int = PILLAR_MIN_RECORDS,
    enrichment: DataFrame | None = None,
) -> DataFrame:
    """What both station pillars need, from one aggregation over the records.

    Their mobility comes from the records, or from their ``station_enrichment``, which
    meets the stations and not the records.
    """
    usable = f"tx_phy_rate > {CONTROL_RATE}"
    valid_snr = f"CASE WHEN snr BETWEEN 0 AND {snr_max} THEN snr END"
    tx = f"CASE WHEN {usable} THEN tx_phy_rate END"
    labels = ("model", "station_name") if enrichment is not None else ("model", "mobility_status", "station_name")
    stations = (
        records.groupBy(*STATION)
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.count_if(F.expr(usable)).alias("usable_rates"),
            *(F.expr(f"max(CASE WHEN {usable} THEN {c} END)").alias(c) for c in labels),
            *(percentiles(band_value(tx, b), (0.9,)).alias(f"_tx_{b}") for b in bands),
            *(percentiles(band_value("rssi", b), (0.9,)).alias(f"_rssi_{b}") for b in bands),
            _value_range(valid_snr).alias("snr_range_variation"),
        )
        .where(F.col("records") >= min_records)
    )
    if enrichment is not None:
        moves = enrichment.groupBy(*(F.col(k).alias(f"_e_{k}") for k in STATION)).agg(F.max("mobility_status").alias("_moves"))
        same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_e_{k}")) for k in STATION))
        stations = stations.join(moves, same, "left").withColumn("mobility_status", F.when(F.col("usable_rates") > 0, F.col("_moves")))
    return stations.select(
        *STATION, "records", "usable_rates", "model", "mobility_status", "station_name",
        *(F.get(f"_tx_{b}", F.lit(0)).alias(f"p90_phy_rate_{_suffix(b)}_speed") for b in bands),
        *(F.get(f"_rssi_{b}", F.lit(0)).alias(f"p90_rssi_{_suffix(b)}") for b in bands),
        "snr_range_variation",
    )


def with_station_pillars(
    features: DataFrame, speed_profile: str = "pillar_current", include_6g: bool = False
) -> DataFrame:
    """Band scores and the station's mean speed and coverage scores."""
    speed_rules = R.PILLAR_SPEED[speed_profile]
    bands = list(speed_rules)
    out = features.withColumns(
        {
            f"phy_rate_score_{_suffix(b)}_speed": bucketize(f"p90_phy_rate_{_suffix(b)}_speed", speed_rules[b])
            for b in bands
        }
        | {f"rssi_score_{_suffix(b)}": bucketize(f"p90_rssi_{_suffix(b)}", R.PILLAR_COVERAGE[b]) for b in bands}
    )
    covered = [b for b in bands if include_6g or b != "6G"]
    return out.withColumns(
        {
            "station_speed": mean_of_available(f"phy_rate_score_{_suffix(b)}_speed" for b in bands),
            "station_coverage": mean_of_available(f"rssi_score_{_suffix(b)}" for b in covered),
            "speed_variation_score": F.when(F.col("snr_range_variation") > SNR_RANGE, 1).otherwise(0),
        }
    )


def reliability(groups: DataFrame) -> DataFrame:
    """p90 of 2.4 GHz airtime per home and hour, scored; radios off or with
    unreadable or impossible readings are left out."""
    samples = groups.select(
        P.serial(F.col("rowkey"), P.ROUTER_STRICT).alias("sn"),
        P.day_of(F.col("ts")).alias("date"),
        P.day_of(F.col("ts"), "HH").alias("hour"),
        F.explode("Group_Diag_History_radio_wifi_info").alias("radio"),
    )
    util = F.col("radio._2_4g.airtime_util").try_cast("int")
    return (
        samples.where(F.col("radio._2_4g.enable") == "1")
        .withColumn("util", util)
        .where(F.col("util").between(0, 100))
        .groupBy(*HOME)
        .agg(F.get(percentiles("util", (0.9,)), F.lit(0)).alias("p90_airtime_util_2_4g"))
        .withColumn("reliability_score_num", bucketize("p90_airtime_util_2_4g", R.PILLAR_AIRTIME))
    )


def pillar_stations(records: DataFrame, bytes_used: DataFrame, speed_profile: str = "pillar_current", **options) -> DataFrame:
    """Station-hour table behind the home score, with its bytes."""
    include_6g = options.pop("include_6g", False)
    features = pillar_features(records, tuple(R.PILLAR_SPEED[speed_profile]), **options)
    return with_station_pillars(features, speed_profile, include_6g).join(bytes_used, STATION, "left")


def speed_blend(stations: DataFrame, **options) -> DataFrame:
    rated = stations.where(F.col("usable_rates") > 0)
    return heavy_hitter_blend(rated, HOME, "station_speed", "total_bytes", "home_weighted_avg_base_score_speed", **options)


def coverage_blend(stations: DataFrame, **options) -> DataFrame:
    return heavy_hitter_blend(
        stations, HOME, "station_coverage", "total_bytes", "home_weighted_avg_base_score_coverage", **options
    )


def home_blends(stations: DataFrame, **options) -> DataFrame:
    """Both blends of a home; a home without a usable rate has no speed."""
    return coverage_blend(stations, **options).join(speed_blend(stations, **options).drop("n"), HOME, "left")


def combine_pillars(speed: Column, coverage: Column, reliability: Column) -> Column:
    """Mean of the pillars present; NULL when speed or coverage is missing."""
    total = speed + coverage + F.coalesce(reliability, F.lit(0))
    present = reduce(lambda a, b: a + b, (c.isNotNull().cast("int") for c in (speed, coverage, reliability)))
    return F.try_divide(total, present)


def home_score(
    records: DataFrame, history: DataFrame, groups: DataFrame, blend: Mapping[str, object] | None = None, **options
) -> DataFrame:
    """One row per station-hour with its home's speed, coverage, reliability
    and overall score.

    The station-hour table is written once: the two blends and the final rows
    all read it instead of the records. ``records`` are enriched, or the option
    ``enrichment`` has the ``station_enrichment`` of plain ones.
    """
    stations = materialise(pillar_stations(records, consumption(history), **options), "stations")
    homes = home_blends(stations, **(blend or {})).join(reliability(groups), HOME, "left")
    rows = stations.where((F.col("usable_rates") > 0) & F.col("snr_range_variation").isNotNull())
    joined = (
        join_back(rows, homes, HOME, how="left")
        .withColumn("rssi_range_variation", F.lit(0))
        .withColumn("coverage_variation_score", F.lit(0))
        .withColumn("speed_score_num", F.col("home_weighted_avg_base_score_speed") - F.col("speed_variation_score"))
        .withColumn("coverage_score_num", F.col("home_weighted_avg_base_score_coverage").cast("double"))
        .withColumn(
            "_mean", combine_pillars(F.col("speed_score_num"), F.col("coverage_score_num"), F.col("reliability_score_num"))
        )
        .withColumn("wifi_score_num_unrounded", half_up(F.col("_mean"), 2))
        .withColumn("wifi_score_num", bucketize("_mean", R.PILLAR_FINAL))
        .withColumn("wifi_score_category", R.score_to_label("wifi_score_num"))
    )
    bands = [c.removeprefix("p90_rssi_") for c in stations.columns if c.startswith("p90_rssi_")]
    return joined.select(
        "sn", "station_mac", "station_name", "model", "mobility_status", "date", "hour",
        *(f"p90_phy_rate_{b}_speed" for b in bands), *(f"phy_rate_score_{b}_speed" for b in bands),
        "snr_range_variation", "home_weighted_avg_base_score_speed", "speed_variation_score", "speed_score_num",
        *(f"p90_rssi_{b}" for b in bands), *(f"rssi_score_{b}" for b in bands),
        "rssi_range_variation", "home_weighted_avg_base_score_coverage", "coverage_variation_score",
        "coverage_score_num", "p90_airtime_util_2_4g", "reliability_score_num",
        "wifi_score_num_unrounded", "wifi_score_num", "wifi_score_category",
    )
