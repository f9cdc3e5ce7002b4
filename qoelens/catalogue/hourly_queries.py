"""Hourly scores over the telemetry built from ``lineitem``."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from .. import telemetry as data
from ..operators.skew import materialise
from ..operators.stationarity import drop_low_outliers, mobility, stationarity
from ..plans import hourly as H
from ..plans.jobs import HourlyPaths, backfill_hours, by_hour, score_hour, store_mobility
from ..session import run_dir
from ..sources import sinks, tables
from . import sql as S
from .base import query


def _mobility(history):
    flat = H.connection_records(history)
    return mobility(flat, ["sn", "station_mac"], "rssi")


def _counted_mobility(counts):
    """The same from signal counts."""
    return mobility(counts, ["sn", "station_mac"], "rssi", counted="n")


def _enrichment(history):
    counts = H.signal_counts(history)
    return H.station_enrichment(history, _counted_mobility(counts), counts)


def _enriched(spark, sf_dir):
    history = data.station_history(spark, sf_dir)
    return H.enrich_records(history, _enrichment(history))


_ENRICH_COLUMNS = (
    "sn, rowkey, station_mac, station_name, band, rssi, snr, phy_rate, tx_phy_rate, mode, model, hour, date, "
    "CAST(p50_rssi AS BIGINT) AS p50_rssi, CAST(p90_rssi AS BIGINT) AS p90_rssi, son, mobility_status"
)


@query("station_connection", f"WITH {S.ENRICHED} SELECT {_ENRICH_COLUMNS} FROM conn")
def station_connection(spark, sf_dir):
    return _enriched(spark, sf_dir).select(*(c.split(" AS ")[-1].strip() for c in _ENRICH_COLUMNS.split(", ")))


@query("mobility_status", f"WITH {S.REC}, {S.MOBILITY} SELECT * FROM mobility")
def mobility_status(spark, sf_dir):
    return _mobility(data.station_history(spark, sf_dir)).drop("n")


@query(
    "outlier_filter",
    f"""WITH {S.REC}, {S.MOBILITY}
    SELECT r.sn, r.station_mac, r.band, r.rssi, r.snr,
      CAST(least(p[2] - 2 * (p[4] - p[2]), p[1]) AS DOUBLE) AS bound
    FROM rec r JOIN bounds b ON r.sn = b.sn AND r.station_mac = b.station_mac
    WHERE r.rssi > least(p[2] - 2 * (p[4] - p[2]), p[1])""",
)
def outlier_filter(spark, sf_dir):
    flat = H.connection_records(data.station_history(spark, sf_dir))
    return drop_low_outliers(flat, ["sn", "station_mac"], "rssi").select(
        "sn", "station_mac", "band", "rssi", "snr", "bound"
    )


def _stationary_sql(spread: int) -> str:
    return f"""WITH {S.REC},
    b AS (SELECT sn, rowkey, max(rssi) AS top, quantile_disc(rssi, [0.03, 0.1, 0.5, 0.9]) AS p
          FROM rec WHERE rssi IS NOT NULL GROUP BY sn, rowkey)
    SELECT sn, rowkey, CASE WHEN p[4] - p[3] <= {spread} THEN '1' ELSE '0' END AS stationarity
    FROM b WHERE top > least(p[2] - 2 * (p[4] - p[2]), p[1])"""


@query("stationarity", _stationary_sql(5))
def stationarity_query(spark, sf_dir):
    flat = H.connection_records(data.station_history(spark, sf_dir))
    return stationarity(flat, ["sn", "rowkey"], "rssi").drop("n")


@query("stationary_daily", _stationary_sql(3))
def stationary_daily(spark, sf_dir):
    flat = H.connection_records(data.station_history(spark, sf_dir))
    return stationarity(flat, ["sn", "rowkey"], "rssi", spread=3).drop("n")


@query(
    "steering_successes",
    f"""WITH {S.REC} SELECT rowkey, date, hour, count(*) AS son FROM rec
    WHERE (band_station IS NOT NULL OR ap_station IS NOT NULL) AND band_action = '1' GROUP BY ALL""",
)
def steering_successes(spark, sf_dir):
    return H.steering_successes(data.station_history(spark, sf_dir))


# ------------------------------------------------------------- station score

_RSSI_RULES = {
    "2_4g": ((4, "x >= -65"), (3, "x BETWEEN -75 AND -66"), (2, "x BETWEEN -85 AND -76"), (1, "x < -85")),
    "5g": ((4, "x >= -68"), (3, "x BETWEEN -78 AND -69"), (2, "x BETWEEN -88 AND -79"), (1, "x < -88")),
    "6g": ((4, "x >= -62"), (3, "x BETWEEN -72 AND -63"), (2, "x BETWEEN -82 AND -73"), (1, "x < -82")),
}
_CAPS = (
    "(mode = 0 AND x <= 2) OR (mode BETWEEN 1 AND 2 AND x <= 11) OR (mode = 3 AND x <= 24) "
    "OR (mode BETWEEN 4 AND 7 AND x <= 12) OR (mode BETWEEN 8 AND 29 AND x <= 6)"
)
_PHY_RULES = {
    "station_hour_mode": {
        "2_4g": ((4, _CAPS), (4, "x > 144"), (3, "x BETWEEN 72 AND 144"), (2, "x BETWEEN 12 AND 71"), (1, "x < 12")),
        "5g": ((4, _CAPS), (4, "x > 600"), (3, "x BETWEEN 300 AND 600"), (2, "x BETWEEN 86 AND 299"), (1, "x < 86")),
        "6g": ((4, _CAPS), (4, "x > 1200"), (3, "x BETWEEN 600 AND 1200"), (2, "x BETWEEN 286 AND 599"), (1, "x < 286")),
    },
    "station_hour_deployed": {
        "2_4g": ((4, "x >= 1"), (1, "x < 1")),
        "5g": ((4, "x >= 400"), (3, "x BETWEEN 200 AND 399"), (2, "x BETWEEN 100 AND 199"), (1, "x < 100")),
        "6g": ((4, "x >= 1200"), (3, "x BETWEEN 600 AND 1199"), (2, "x BETWEEN 200 AND 599"), (1, "x < 200")),
    },
    "station_hour_v1": {
        "2_4g": ((4, "x >= 50"), (3, "x BETWEEN 20 AND 49"), (2, "x BETWEEN 10 AND 19"), (1, "x < 10")),
        "5g": ((4, "x >= 200"), (3, "x BETWEEN 100 AND 199"), (2, "x BETWEEN 50 AND 99"), (1, "x < 50")),
    },
}
_PREFIX = {"2_4g": "2.4G", "5g": "5G", "6g": "6G"}


def _dbl(expr: str, name: str) -> str:
    return f"CAST({expr} AS DOUBLE) AS {name}"


def station_score_sql(profile: str, source: str) -> str:
    rules = _PHY_RULES[profile]
    bands = list(rules)

    def on(b, v):
        return f"CASE WHEN band LIKE '{_PREFIX[b]}%' THEN {v} END"

    levels = [f"quantile_disc({on(b, 'p90_rssi')}, {q}) AS {n}_rssi_{b}"
              for b in bands for n, q in (("p90", 0.9), ("p50", 0.5), ("p95", 0.95))]
    levels += [f"quantile_disc({on(b, 'phy_rate')}, 0.9) AS p90_phy_rate_{b}" for b in bands]
    ranges = [f"max({on(b, 'phy_rate')}) - min({on(b, 'phy_rate')}) AS phy_rate_range_{b}" for b in ("2_4g", "5g")]
    scores = [S.first_match(f"p90_rssi_{b}", *_RSSI_RULES[b]) + f" AS rssi_score_{b}" for b in bands]
    scores += [S.first_match(f"p90_phy_rate_{b}", *rules[b]) + f" AS phy_rate_score_{b}" for b in bands]
    rssi_s = ", ".join(f"rssi_score_{b}" for b in bands)
    phy_s = ", ".join(f"phy_rate_score_{b}" for b in bands)
    silent = " OR ".join(f"coalesce({n}_rssi_{b}, 0) = -100" for b in bands for n in ("p90", "p50", "p95"))
    stalled = " OR ".join(f"coalesce(p90_phy_rate_{b}, -1) = 0" for b in bands)
    out = [_dbl(f"{n}_rssi_{b}", f"{n}_rssi_{b}_base") for b in bands for n in ("p90", "p50", "p95")]
    out += [_dbl(f"p90_phy_rate_{b}", f"p90_phy_rate_{b}_base") for b in bands]
    out += [f"CAST({k}_{b} AS BIGINT) AS {k}_{b}_base" for k in ("rssi_score", "phy_rate_score") for b in bands]
    return f"""WITH {source},
    kept AS (SELECT * FROM conn WHERE NOT (phy_rate = 0 AND rssi = 0 AND p90_rssi = -100)
             AND (p90_rssi IS NOT NULL OR phy_rate IS NOT NULL OR snr IS NOT NULL)
             AND band NOT IN ('ETH', 'Ether', 'ethernet') AND band IS NOT NULL),
    counted AS (SELECT *, count(*) OVER (PARTITION BY sn, station_mac, date, hour) AS record_count FROM kept),
    g AS (SELECT sn, station_mac, date, hour, max(model) AS model, max(mobility_status) AS mobility_status,
            max(station_name) AS station_name, max(mode) AS mode, {', '.join(levels)}, {', '.join(ranges)},
            max(snr) - min(snr) AS snr_range, count(*) FILTER (WHERE son >= 1) AS son_count
          FROM counted WHERE record_count >= 9 GROUP BY sn, station_mac, date, hour),
    s AS (SELECT *, {', '.join(scores)},
            CASE WHEN snr_range > 13 OR son_count > 6 OR phy_rate_range_2_4g > 30 OR phy_rate_range_5g > 300
                 THEN 1 ELSE 0 END AS variation_score FROM g),
    f AS (SELECT *, least({rssi_s}) AS final_rssi_score, least({phy_s}) AS final_phy_rate_score FROM s),
    b AS (SELECT *, least(final_rssi_score, final_phy_rate_score) AS base_score FROM f
          WHERE (final_rssi_score IS NOT NULL OR final_phy_rate_score IS NOT NULL)
            AND NOT (({silent}) AND ({stalled}))),
    n AS (SELECT *, CASE WHEN base_score - variation_score >= 4 THEN 4 WHEN base_score - variation_score = 3 THEN 3
                    WHEN base_score - variation_score = 2 THEN 2 ELSE 1 END AS num FROM b)
    SELECT sn, station_mac, station_name, model, mobility_status, date, hour, {', '.join(out)},
      CAST(final_rssi_score AS BIGINT) AS final_rssi_score, CAST(final_phy_rate_score AS BIGINT) AS final_phy_rate_score,
      {_dbl('snr_range', 'snr_range_variation')}, son_count AS son_count_variation,
      {_dbl('phy_rate_range_2_4g', 'phy_rate_range_2_4g_variation')},
      {_dbl('phy_rate_range_5g', 'phy_rate_range_5g_variation')},
      CAST(base_score AS BIGINT) AS base_score, CAST(variation_score AS BIGINT) AS variation_score,
      CASE num WHEN 4 THEN 'Excellent' WHEN 3 THEN 'Good' WHEN 2 THEN 'Fair' ELSE 'Poor' END AS station_score,
      CAST(num AS BIGINT) AS station_score_num
    FROM n"""


@query("station_score", station_score_sql("station_hour_mode", S.ENRICHED))
def station_score(spark, sf_dir):
    return H.station_score(_enriched(spark, sf_dir))


@query("station_score_deployed", station_score_sql("station_hour_deployed", S.ENRICHED))
def station_score_deployed(spark, sf_dir):
    return H.station_score(_enriched(spark, sf_dir), profile="station_hour_deployed")


@query("station_score_v1", station_score_sql("station_hour_v1", S.ENRICHED))
def station_score_v1(spark, sf_dir):
    return H.station_score(_enriched(spark, sf_dir), profile="station_hour_v1")


_CONTRACT = S.REC + """,
sig AS (SELECT station_mac, quantile_disc(rssi, 0.5) AS p50_rssi, quantile_disc(rssi, 0.9) AS p90_rssi
        FROM rec GROUP BY station_mac),
conn AS (SELECT r.*, p50_rssi, p90_rssi, 0 AS son,
           CASE WHEN p90_rssi - p50_rssi <= 5 THEN 'Stationary' ELSE 'Non-stationary' END AS mobility_status
         FROM rec r JOIN sig USING (station_mac))"""


@query("station_score_combined", station_score_sql("station_hour_mode", _CONTRACT))
def station_score_combined(spark, sf_dir):
    records = H.connection_records(data.station_history(spark, sf_dir))
    return H.station_score(H.enrich_contract(records))


# ---------------------------------------------------------------- home score

_BYTES = """
used AS (SELECT sn, station_mac, date, hour, sum(bytes) AS total_bytes FROM rec
         GROUP BY sn, station_mac, date, hour HAVING sum(bytes) < 1875000000)"""

_SPEED = {
    "pillar_current": {
        "2_4g": ((4, "x >= 50"), (3, "x >= 20 AND x <= 49"), (2, "x >= 10 AND x <= 19"), (1, "x < 10")),
        "5g": ((4, "x >= 200"), (3, "x >= 100 AND x <= 199"), (2, "x >= 50 AND x <= 99"), (1, "x < 50")),
        "6g": ((4, "x >= 200"), (3, "x >= 100 AND x <= 199"), (2, "x >= 50 AND x <= 99"), (1, "x < 50")),
    },
    "pillar_v1": {
        "2_4g": ((4, "x > 120"), (3, "x BETWEEN 101 AND 120"), (2, "x BETWEEN 80 AND 100"), (1, "x < 80")),
        "5g": ((4, "x > 400"), (3, "x BETWEEN 301 AND 400"), (2, "x BETWEEN 200 AND 300"), (1, "x < 200")),
    },
}
_COVER = {
    "2_4g": ((4, "x >= -55"), (3, "x BETWEEN -70 AND -56"), (2, "x BETWEEN -79 AND -71"), (1, "x < -79")),
    "5g": ((4, "x >= -55"), (3, "x BETWEEN -70 AND -56"), (2, "x BETWEEN -77 AND -71"), (1, "x < -77")),
    "6g": ((4, "x >= -55"), (3, "x BETWEEN -70 AND -56"), (2, "x BETWEEN -77 AND -71"), (1, "x < -77")),
}


def _mean(columns):
    total = " + ".join(f"coalesce(CAST({c} AS DOUBLE), 0)" for c in columns)
    n = " + ".join(f"CASE WHEN {c} IS NULL THEN 0 ELSE 1 END" for c in columns)
    return f"({total}) / nullif({n}, 0)"


def pillars_sql(profile: str = "pillar_current", min_records: int = 8, snr_max: int = 95) -> str:
    """CTEs up to ``speed`` and ``cover``: station rows with their home's blends."""
    rules = _SPEED[profile]
    bands = list(rules)

    def on(b, v):
        return f"quantile_disc(CASE WHEN band LIKE '{_PREFIX[b]}%' THEN {v} END, 0.9)"

    blend = """SELECT *, rank() OVER (PARTITION BY sn, date, hour ORDER BY total_bytes DESC NULLS LAST) AS rk FROM {src}"""
    home = (
        "SELECT sn, date, hour, "
        + S.half_up("0.8 * coalesce(avg({c}) FILTER (WHERE rk <= 5), 0) + 0.2 * coalesce(avg({c}) FILTER (WHERE rk > 5), 0)", 2)
        + " AS blend FROM {src} GROUP BY sn, date, hour"
    )
    return f"""{S.ENRICHED}, {_BYTES}, {S.RADIO},
    counted AS (SELECT *, count(*) OVER (PARTITION BY sn, station_mac, date, hour) AS record_count FROM conn),
    sp0 AS (SELECT sn, station_mac, date, hour, max(model) AS model, max(mobility_status) AS mobility_status,
              max(station_name) AS station_name, {', '.join(f"{on(b, 'tx_phy_rate')} AS tx_{b}" for b in bands)}
            FROM counted WHERE record_count >= {min_records} AND tx_phy_rate > 24 GROUP BY sn, station_mac, date, hour),
    sp1 AS (SELECT *, {', '.join(S.first_match(f'tx_{b}', *rules[b]) + f' AS speed_{b}' for b in bands)} FROM sp0),
    sp2 AS (SELECT sp1.*, {_mean([f'speed_{b}' for b in bands])} AS station_speed, total_bytes
            FROM sp1 LEFT JOIN used USING (sn, station_mac, date, hour)),
    sp3 AS ({blend.format(src='sp2')}),
    sp_home AS ({home.format(c='station_speed', src='sp3')}),
    var AS (SELECT sn, station_mac, date, hour, max(snr) - min(snr) AS snr_range FROM counted
            WHERE record_count >= {min_records} AND snr BETWEEN 0 AND {snr_max} GROUP BY sn, station_mac, date, hour),
    speed AS (SELECT sp2.*, sp_home.blend AS speed_blend, snr_range,
                CASE WHEN snr_range > 13 THEN 1 ELSE 0 END AS speed_variation
              FROM sp2 JOIN sp_home USING (sn, date, hour) JOIN var USING (sn, station_mac, date, hour)),
    cv0 AS (SELECT sn, station_mac, date, hour, {', '.join(f"{on(b, 'rssi')} AS rssi_{b}" for b in bands)}
            FROM counted WHERE record_count >= {min_records} GROUP BY sn, station_mac, date, hour),
    cv1 AS (SELECT *, {', '.join(S.first_match(f'rssi_{b}', *_COVER[b]) + f' AS cover_{b}' for b in bands)} FROM cv0),
    cv2 AS (SELECT cv1.*, {_mean(['cover_2_4g', 'cover_5g'])} AS station_coverage, total_bytes
            FROM cv1 LEFT JOIN used USING (sn, station_mac, date, hour)),
    cv3 AS ({blend.format(src='cv2')}),
    cv_home AS ({home.format(c='station_coverage', src='cv3')}),
    cover AS (SELECT cv2.*, cv_home.blend AS cover_blend FROM cv2 JOIN cv_home USING (sn, date, hour)),
    rel AS (SELECT sn, '20240130' AS date, lpad(CAST(hour_no AS VARCHAR), 2, '0') AS hour,
              quantile_disc(util, 0.9) AS p90_airtime
            FROM radio WHERE enable = '1' AND util BETWEEN 0 AND 100 GROUP BY sn, hour_no),
    rel2 AS (SELECT *, CASE WHEN p90_airtime < 40 THEN 4 WHEN p90_airtime BETWEEN 40 AND 50 THEN 3
                       WHEN p90_airtime BETWEEN 50 AND 70 THEN 2 ELSE 1 END AS rel_num FROM rel)"""


def home_score_sql(profile: str = "pillar_current", min_records: int = 8, snr_max: int = 95) -> str:
    bands = list(_SPEED[profile])
    out = [_dbl(f"tx_{b}", f"p90_phy_rate_{b}_speed") for b in bands]
    out += [f"CAST(speed_{b} AS BIGINT) AS phy_rate_score_{b}_speed" for b in bands]
    out += [_dbl(f"rssi_{b}", f"p90_rssi_{b}") for b in bands]
    out += [f"CAST(cover_{b} AS BIGINT) AS rssi_score_{b}" for b in bands]
    return f"""WITH {pillars_sql(profile, min_records, snr_max)},
    j AS (SELECT s.*, c.* EXCLUDE (sn, station_mac, date, hour, total_bytes), r.p90_airtime, r.rel_num,
            speed_blend - speed_variation AS speed_num,
            (speed_blend - speed_variation + cover_blend + coalesce(rel_num, 0))
              / (2 + CASE WHEN rel_num IS NULL THEN 0 ELSE 1 END) AS mean
          FROM speed s JOIN cover c USING (sn, station_mac, date, hour) LEFT JOIN rel2 r USING (sn, date, hour)),
    k AS (SELECT *, CASE WHEN mean > 3.5 THEN 4 WHEN mean > 2.5 THEN 3 WHEN mean > 1.5 THEN 2 ELSE 1 END AS num FROM j)
    SELECT sn, station_mac, station_name, model, mobility_status, date, hour, {', '.join(out)},
      {_dbl('snr_range', 'snr_range_variation')}, speed_blend AS home_weighted_avg_base_score_speed,
      CAST(speed_variation AS BIGINT) AS speed_variation_score, speed_num AS speed_score_num,
      CAST(0 AS BIGINT) AS rssi_range_variation, cover_blend AS home_weighted_avg_base_score_coverage,
      CAST(0 AS BIGINT) AS coverage_variation_score, cover_blend AS coverage_score_num,
      {_dbl('p90_airtime', 'p90_airtime_util_2_4g')}, CAST(rel_num AS BIGINT) AS reliability_score_num,
      {S.half_up('mean', 2)} AS wifi_score_num_unrounded, CAST(num AS BIGINT) AS wifi_score_num,
      CASE num WHEN 4 THEN 'Excellent' WHEN 3 THEN 'Good' WHEN 2 THEN 'Fair' ELSE 'Poor' END AS wifi_score_category
    FROM k"""


def _home(spark, sf_dir, **options):
    history = data.station_history(spark, sf_dir)
    enrichment = materialise(_enrichment(history), "enrichment")
    groups = data.device_groups(spark, sf_dir)
    return H.home_score(H.connection_records(history), history, groups, enrichment=enrichment, **options)


@query("home_score", home_score_sql())
def home_score(spark, sf_dir):
    return _home(spark, sf_dir)


@query("home_score_v1", home_score_sql("pillar_v1", 9, 50))
def home_score_v1(spark, sf_dir):
    return _home(spark, sf_dir, speed_profile="pillar_v1", min_records=9, snr_max=50)


@query(
    "data_consumption",
    f"WITH {S.REC}, {_BYTES} SELECT sn, station_mac, date, hour, CAST(total_bytes AS BIGINT) AS total_bytes FROM used",
)
def data_consumption(spark, sf_dir):
    return H.consumption(data.station_history(spark, sf_dir))


@query(
    "airtime_reliability",
    f"""WITH {pillars_sql()} SELECT sn, date, hour, {_dbl('p90_airtime', 'p90_airtime_util_2_4g')},
    CAST(rel_num AS BIGINT) AS reliability_score_num FROM rel2""",
)
def airtime_reliability(spark, sf_dir):
    return H.reliability(data.device_groups(spark, sf_dir))


def _pillar_stations(spark, sf_dir):
    history = data.station_history(spark, sf_dir)
    records = H.connection_records(history).withColumn("mobility_status", F.lit(None).cast("string"))
    return H.pillar_stations(records, H.consumption(history))


@query(
    "heavy_hitter_blend",
    f"""WITH {pillars_sql()} SELECT sn, date, hour, sp_home.blend AS speed, cv_home.blend AS coverage,
    (SELECT count(*) FROM cv2 WHERE cv2.sn = cv_home.sn AND cv2.hour = cv_home.hour) AS n
    FROM cv_home LEFT JOIN sp_home USING (sn, date, hour)""",
)
def heavy_hitter_blend(spark, sf_dir):
    blends = H.home_blends(materialise(_pillar_stations(spark, sf_dir), "stations"))
    return blends.withColumnsRenamed(
        {"home_weighted_avg_base_score_speed": "speed", "home_weighted_avg_base_score_coverage": "coverage"}
    )


@query(
    "speed_pillar",
    f"""WITH {pillars_sql()} SELECT sn, station_mac, date, hour, station_speed, CAST(total_bytes AS BIGINT) AS total_bytes,
    {_dbl('snr_range', 'snr_range_variation')}, CAST(speed_variation AS BIGINT) AS speed_variation_score FROM speed""",
)
def speed_pillar(spark, sf_dir):
    return _pillar_stations(spark, sf_dir).where("usable_rates > 0 AND snr_range_variation IS NOT NULL").select(
        "sn", "station_mac", "date", "hour", "station_speed", "total_bytes", "snr_range_variation", "speed_variation_score"
    )


@query(
    "coverage_pillar",
    f"""WITH {pillars_sql()} SELECT sn, station_mac, date, hour, {_dbl('rssi_2_4g', 'p90_rssi_2_4g')},
    {_dbl('rssi_5g', 'p90_rssi_5g')}, {_dbl('rssi_6g', 'p90_rssi_6g')}, station_coverage FROM cover""",
)
def coverage_pillar(spark, sf_dir):
    return _pillar_stations(spark, sf_dir).select(
        "sn", "station_mac", "date", "hour", "p90_rssi_2_4g", "p90_rssi_5g", "p90_rssi_6g", "station_coverage"
    )


@query(
    "hourly_jobs",
    f"""SELECT 'home' AS kind, * FROM ({home_score_sql()}) UNION ALL BY NAME
    SELECT 'station' AS kind, * FROM ({station_score_sql("station_hour_mode", S.ENRICHED)})""",
)
def hourly_jobs(spark, sf_dir):
    """Two of three hours are scored by the hour's job, the third is found and
    scored by the back-fill; mobility is stored from the day before."""
    base = run_dir(spark, "hourly")
    paths = HourlyPaths(*(f"{base}/{t}" for t in ("history", "groups", "mobility", "stations", "homes")))
    history = data.station_history(spark, sf_dir)
    sinks.write_partitions(data.day_earlier(history).unionByName(history), paths.history)
    sinks.write_partitions(data.device_groups(spark, sf_dir), paths.groups)
    store_mobility(spark, paths, data.DATE_BEFORE)
    for hour in ("08", "18"):
        if not all(done.published for done in score_hour(spark, paths, data.SCORE_DATE, hour)):
            raise RuntimeError(f"hour {hour} was refused")
    for jobs in (2, 0):
        if len(backfill_hours(spark, paths, [data.SCORE_DATE], datetime(2024, 1, 31))) != jobs:
            raise RuntimeError("the back-fill did not run both outputs of the missing hour, once")
    homes, stations = (by_hour(spark, p).read().withColumn("kind", F.lit(k)) for p, k in ((paths.homes, "home"), (paths.stations, "station")))
    return homes.unionByName(stations, allowMissingColumns=True)
