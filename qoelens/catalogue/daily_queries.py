"""Daily KPIs and scores over the telemetry built from ``lineitem`` and ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import telemetry as data
from ..functions.profiles import KPI_CUTS, PILLAR_CUTS, bucketize, label_to_score
from ..functions.scoring import vote, weighted_mean, worst_label
from ..operators.shape import exclude_keys
from ..plans import daily as D
from ..plans.jobs import DailyPaths, backfill_days, by_date, score_day
from ..session import run_dir
from ..sources import sinks
from . import sql as S
from .base import query

DAY = data.SCORE_DAY


def _owl(spark, sf_dir):
    return data.owl_history(spark, sf_dir)


def _history(spark, sf_dir):
    return data.station_history(spark, sf_dir)


# ------------------------------------------------------------ daily counters


@query("ip_changes", f"WITH {S.OWL}, {S.IP_DAILY} SELECT * FROM ip_daily")
def ip_changes(spark, sf_dir):
    return D.ip_changes_daily(_owl(spark, sf_dir), ["event_id"])


@query("restart_counts", f"WITH {S.OWL}, {S.RESTART_DAILY} SELECT * FROM restart_daily")
def restart_counts(spark, sf_dir):
    return D.restarts_daily(_owl(spark, sf_dir))


_AIR_DAILY = """
air_daily AS (SELECT sn, '2024-01-30' AS day, count(*) FILTER (WHERE util > 70) AS no_poor_airtime
              FROM radio WHERE enable = '1' GROUP BY sn)"""


@query("poor_airtime", f"WITH {S.LI}, {S.RADIO}, {_AIR_DAILY} SELECT * FROM air_daily")
def poor_airtime(spark, sf_dir):
    return D.airtime_daily(data.device_groups(spark, sf_dir))


# ----------------------------------------------------------------- home KPIs

_IP_KPI = """
ip_kpi AS (SELECT *, CASE WHEN no_ip_changes > 6 THEN 'Poor' WHEN no_ip_changes BETWEEN 4 AND 6 THEN 'Fair'
             WHEN no_ip_changes BETWEEN 1 AND 3 THEN 'Good' WHEN no_ip_changes = 0 THEN 'Excellent'
             ELSE 'Unknown' END AS ip_change_category
           FROM (SELECT sn, CAST(sum(no_ip_changes) AS BIGINT) AS no_ip_changes FROM ip_daily
                 WHERE day BETWEEN '2024-01-20' AND '2024-01-29' GROUP BY sn))"""
_AIR_KPI = """
air_kpi AS (SELECT *, CASE WHEN no_poor_airtime > 200 THEN 'Poor' WHEN no_poor_airtime >= 75 THEN 'Fair'
              WHEN no_poor_airtime >= 26 THEN 'Good' WHEN no_poor_airtime >= 0 THEN 'Excellent'
              ELSE 'Unknown' END AS "Airtime_Utilization_Category"
            FROM (SELECT sn, CAST(sum(no_poor_airtime) AS BIGINT) AS no_poor_airtime FROM air_daily
                  WHERE day BETWEEN '2024-01-24' AND '2024-01-30' GROUP BY sn))"""


def _reboots(c):
    return (
        f"CASE WHEN {c} >= 5 THEN 'Poor' WHEN {c} = 4 THEN 'Fair' WHEN {c} BETWEEN 2 AND 3 THEN 'Good' "
        f"WHEN {c} >= 0 THEN 'Excellent' WHEN {c} IS NULL THEN 'Excellent' END"
    )


_RESTART_KPI = f"""
restart_kpi AS (SELECT *, {_reboots('total_reboots_count')} AS reboot_category,
    {_reboots('mdm_resets_count')} AS modem_reset_category,
    CASE WHEN user_reboot_count >= 3 THEN 'Poor' WHEN user_reboot_count = 2 THEN 'Fair'
         WHEN user_reboot_count = 1 THEN 'Good' ELSE 'Excellent' END AS customer_reboot_category
  FROM (SELECT sn, CAST(sum(coalesce(num_mdm_crashes, 0)) AS BIGINT) AS mdm_resets_count,
          CAST(sum(coalesce(num_user_reboots, 0)) AS BIGINT) AS user_reboot_count,
          CAST(sum(coalesce(num_total_reboots, 0)) AS BIGINT) AS total_reboots_count
        FROM restart_daily WHERE day BETWEEN '2024-01-01' AND '2024-01-30' GROUP BY sn))"""
_STEER_KPI = """
bs AS (SELECT sn, count(*) FILTER (WHERE band_action = '2') AS band_success_count FROM rec
       WHERE band_station = '2' GROUP BY sn),
aps AS (SELECT sn, count(*) FILTER (WHERE ap_action = '2') AS ap_success_count FROM rec
       WHERE ap_station = '2' GROUP BY sn),
keys AS (SELECT sn, count(DISTINCT rowkey) AS distinct_rowkey_count FROM rec GROUP BY sn),
steer0 AS (SELECT sn, band_success_count, ap_success_count,
             coalesce(band_success_count, 0) + coalesce(ap_success_count, 0) AS steer_start_count, distinct_rowkey_count
           FROM (bs FULL JOIN aps USING (sn)) JOIN keys USING (sn)),
steer_kpi AS (SELECT *, CAST(steer_start_count AS DOUBLE) / distinct_rowkey_count AS "steer_start_perHome_count",
    CASE WHEN steer_start_count > 60 THEN 'Poor' WHEN steer_start_count >= 31 THEN 'Fair'
         WHEN steer_start_count >= 11 THEN 'Good' ELSE 'Excellent' END AS steer_start_category,
    CASE WHEN steer_start_count / distinct_rowkey_count > 3 THEN 'Poor'
         WHEN steer_start_count / distinct_rowkey_count > 2 THEN 'Fair'
         WHEN steer_start_count / distinct_rowkey_count > 1 THEN 'Good' ELSE 'Excellent' END AS "steer_start_perHome_category"
  FROM steer0)"""


@query("ip_change_kpi", f"WITH {S.OWL}, {S.IP_DAILY}, {_IP_KPI} SELECT * FROM ip_kpi")
def ip_change_kpi(spark, sf_dir):
    return D.ip_change_kpi(D.ip_changes_daily(_owl(spark, sf_dir), ["event_id"]), DAY)


@query("airtime_kpi", f"WITH {S.LI}, {S.RADIO}, {_AIR_DAILY}, {_AIR_KPI} SELECT * FROM air_kpi")
def airtime_kpi(spark, sf_dir):
    return D.airtime_kpi(D.airtime_daily(data.device_groups(spark, sf_dir)), DAY)


@query("restart_kpi", f"WITH {S.OWL}, {S.RESTART_DAILY}, {_RESTART_KPI} SELECT * FROM restart_kpi")
def restart_kpi(spark, sf_dir):
    return D.restart_kpi(D.restarts_daily(_owl(spark, sf_dir)), DAY)


@query("steering", f"WITH {S.REC}, {_STEER_KPI} SELECT * FROM steer_kpi")
def steering(spark, sf_dir):
    return D.steering_kpi(D.station_day(_history(spark, sf_dir)))


@query(
    "lookback_sum",
    f"""WITH {S.OWL}, {S.RESTART_DAILY} SELECT sn, CAST(sum(coalesce(num_total_reboots, 0)) AS BIGINT) AS week,
    CAST(sum(coalesce(num_mdm_crashes, 0)) AS BIGINT) AS crashes
    FROM restart_daily WHERE day BETWEEN '2024-01-22' AND '2024-01-28' GROUP BY sn""",
)
def lookback_sum(spark, sf_dir):
    counters = {"num_total_reboots": "week", "num_mdm_crashes": "crashes"}
    return D.lookback(D.restarts_daily(_owl(spark, sf_dir)), DAY, 7, counters, ends_before=2)


# --------------------------------------------------------- signal and rate KPI

_BANDS = {"2_4G": "2.4G", "5G": "5G", "6G": "6G"}
_SIGNAL = {"2_4G": (-78, -71), "5G": (-75, -71), "6G": (-70, -65)}


def _signal_case(x):
    parts = []
    for band, (poor, fair) in _SIGNAL.items():
        parts.append(
            f"WHEN band LIKE '{_BANDS[band]}%' THEN CASE WHEN {x} < {poor} THEN 'Poor' "
            f"WHEN {x} BETWEEN {poor} AND {fair} THEN 'Fair' WHEN {x} BETWEEN {fair - 1} AND -56 THEN 'Good' "
            f"WHEN {x} > -56 THEN 'Excellent' ELSE 'No Data' END"
        )
    return "CASE " + " ".join(parts) + " ELSE 'No Data' END"


_RATE = {"2_4G": (80, 100, 120), "5G": (200, 300, 500), "6G": (200, 300, 500)}


def _rate_case(x):
    parts = []
    for band, (poor, fair, good) in _RATE.items():
        parts.append(
            f"WHEN band LIKE '{_BANDS[band]}%' THEN CASE WHEN {x} < {poor} THEN 'Poor' WHEN {x} < {fair} THEN 'Fair' "
            f"WHEN {x} < {good} THEN 'Good' WHEN {x} >= {good} THEN 'Excellent' ELSE 'No Data' END"
        )
    return "CASE " + " ".join(parts) + " ELSE 'No Data' END"


_LABELS = ("Poor", "Fair", "Good", "Excellent")


def _stations_sql(name, case, where):
    counters = ", ".join(
        f"count(*) FILTER (WHERE level = '{lab}' AND band LIKE '{pre}%') AS \"{lab.lower()}_count_{b}Hz\""
        for lab in _LABELS for b, pre in _BANDS.items()
    )
    votes = " ".join(
        "WHEN " + " OR ".join(f'"{lab.lower()}_count_{b}Hz" >= 12' for b in _BANDS) + f" THEN '{lab}'" for lab in _LABELS
    )
    return f"""
{name}_lv AS (SELECT *, {case} AS level FROM rec WHERE {where}),
{name}_g AS (SELECT sn, rowkey, count(*) AS total_count, {counters}, CAST(sum(sent) AS BIGINT) AS byte_send,
    CAST(sum(received) AS BIGINT) AS byte_received FROM {name}_lv GROUP BY sn, rowkey),
{name}_st0 AS (SELECT *, CASE {votes} ELSE 'No Data' END AS category,
    CASE WHEN byte_send + byte_received > 0 THEN ln(byte_send + byte_received) END AS volume FROM {name}_g),
{name}_st AS (SELECT *, CAST(CASE category WHEN 'Poor' THEN 1 WHEN 'Fair' THEN 2 WHEN 'Good' THEN 3
    WHEN 'Excellent' THEN 4 END AS BIGINT) AS score FROM {name}_st0)"""


def _kpi_sql(name, numeric, category):
    value = S.half_up(f"sum(score * weight)", 4)
    return f"""
{name}_w AS (SELECT *, volume / nullif(sum(volume) OVER (PARTITION BY sn), 0) AS weight FROM {name}_st),
{name}_kpi AS (SELECT *, CASE WHEN {numeric} <= 1.5 THEN 'Poor' WHEN {numeric} <= 2.5 THEN 'Fair'
    WHEN {numeric} <= 3.5 THEN 'Good' WHEN {numeric} > 3.5 THEN 'Excellent' END AS "{category}"
  FROM (SELECT sn, {value} AS {numeric} FROM {name}_w GROUP BY sn))"""


_RSSI = _stations_sql("rssi", _signal_case("rssi"), "rssi IS NOT NULL")
_PHY = _stations_sql("phy", _rate_case("tx_phy_rate"), "band LIKE '2.4G%' OR band LIKE '5G%' OR band LIKE '6G%'")
_RSSI_KPI = _kpi_sql("rssi", "rssi_numeric", "RSSI_category")
_PHY_KPI = _kpi_sql("phy", "phyrate_numeric", "phyrate_category")


def _station_columns(df):
    return df.withColumn("volume", F.round("volume", 6))


@query("rssi_stations", f"WITH {S.REC}, {_RSSI} SELECT * REPLACE (round(volume, 6) AS volume) FROM rssi_st")
def rssi_stations(spark, sf_dir):
    return _station_columns(D.rssi_stations(_history(spark, sf_dir)))


@query("phyrate_stations", f"WITH {S.REC}, {_PHY} SELECT * REPLACE (round(volume, 6) AS volume) FROM phy_st")
def phyrate_stations(spark, sf_dir):
    return _station_columns(D.phyrate_stations(_history(spark, sf_dir)))


@query("rssi_daily", f"WITH {S.REC}, {_RSSI}, {_RSSI_KPI} SELECT * FROM rssi_kpi")
def rssi_daily(spark, sf_dir):
    return D.rssi_kpi(D.rssi_stations(_history(spark, sf_dir)))


@query("phyrate_daily", f"WITH {S.REC}, {_PHY}, {_PHY_KPI} SELECT * FROM phy_kpi")
def phyrate_daily(spark, sf_dir):
    return D.phyrate_kpi(D.phyrate_stations(_history(spark, sf_dir)))


@query(
    "station_weights",
    f"WITH {S.REC}, {_RSSI}, {_RSSI_KPI} SELECT sn, rowkey, round(volume, 6) AS volume, round(weight, 6) AS weights FROM rssi_w",
)
def station_weights(spark, sf_dir):
    weighted = D.station_weights(D.rssi_stations(_history(spark, sf_dir)))
    return weighted.select("sn", "rowkey", F.round("volume", 6).alias("volume"), F.round("weights", 6).alias("weights"))


_DOMINANT = """
dom AS (SELECT sn, rowkey, connect_type, station_name FROM (
    SELECT *, rank() OVER (PARTITION BY sn, rowkey ORDER BY n DESC) AS rk FROM (
      SELECT sn, rowkey, station_name, CASE WHEN band LIKE '2.4G%' THEN '2_4G' WHEN band LIKE '5G%' THEN '5G'
          WHEN band LIKE '6G%' THEN '6G' ELSE band END AS connect_type, count(*) AS n
      FROM rec WHERE station_name IS NOT NULL AND band IS NOT NULL GROUP BY ALL))
  WHERE rk = 1)"""


@query("dominant_type", f"WITH {S.REC}, {_DOMINANT} SELECT * FROM dom")
def dominant_type(spark, sf_dir):
    return D.dominant_connection(_history(spark, sf_dir))


@query(
    "station_report",
    f"""WITH {S.REC}, {_RSSI}, {_DOMINANT} SELECT s.* EXCLUDE (volume), connect_type, station_name, '2024-01-30' AS date
    FROM rssi_st s LEFT JOIN dom USING (sn, rowkey)""",
)
def station_report(spark, sf_dir):
    history = _history(spark, sf_dir)
    return D.station_report(D.rssi_stations(history), history, DAY).drop("volume")


def _pair_sql():
    def side(kind, src):
        counters = ", ".join(
            f'"{lab.lower()}_count_{b}Hz" AS "{lab.lower()}_count_{b}Hz_{kind}"' for lab in _LABELS for b in _BANDS
        )
        return (
            f"SELECT sn, rowkey, total_count AS total_count_{kind}, {counters}, category AS {kind}_category_rowkey, "
            f"score AS {kind}_numeric_rowkey FROM {src}"
        )

    return (
        f"WITH {S.REC}, {_RSSI}, {_PHY}, a AS ({side('rssi', 'rssi_st')}), b AS ({side('phyrate', 'phy_st')}) "
        "SELECT * FROM a JOIN b USING (sn, rowkey)"
    )


@query("daily_station_score", _pair_sql())
def daily_station_score(spark, sf_dir):
    return D.daily_station_score(_history(spark, sf_dir))


# --------------------------------------------------------------- sudden drops

_DROPS = """
fb AS (SELECT sn, rowkey, max(rssi) AS top, quantile_disc(rssi, [0.03, 0.1, 0.5, 0.9]) AS p
       FROM rec WHERE rssi IS NOT NULL GROUP BY sn, rowkey),
fixed AS (SELECT sn, rowkey FROM fb WHERE top > least(p[2] - 2 * (p[4] - p[2]), p[1]) AND p[4] - p[3] <= 5),
present AS (SELECT sn, second_of_day, count(station_mac) AS cnt FROM rec SEMI JOIN fixed USING (sn, rowkey)
            GROUP BY sn, second_of_day),
lagged AS (SELECT *, lag(cnt) OVER (PARTITION BY sn ORDER BY second_of_day) AS prev FROM present),
drops AS (SELECT sn, count(*) AS no_sudden_drop, CASE WHEN count(*) >= 2 THEN 'Poor' WHEN count(*) = 1 THEN 'Fair'
            ELSE 'Good' END AS sudden_drop_category
          FROM lagged WHERE prev - cnt > {limit} GROUP BY sn)"""


@query("sudden_drop", f"WITH {S.REC}, {_DROPS.format(limit=3)} SELECT * FROM drops")
def sudden_drop(spark, sf_dir):
    return D.sudden_drops(_history(spark, sf_dir))


_MODELS = """
mods AS (SELECT sn, 'MODEL-' || CAST(l_suppkey % 4 AS VARCHAR) AS model_name,
           max('fw' || CAST(l_linenumber AS VARCHAR)) AS firmware FROM li GROUP BY ALL
         UNION ALL
         SELECT 'EX' || substring(sn, 3, 8), 'EXT-' || CAST(l_suppkey % 3 AS VARCHAR),
           max('fw' || CAST(l_linenumber AS VARCHAR)) FROM li GROUP BY ALL)"""


@query("latest_firmware", f"WITH {S.LI}, {_MODELS} SELECT * FROM mods")
def latest_firmware(spark, sf_dir):
    return D.models(data.device_groups(spark, sf_dir))


# ----------------------------------------------------------------- home score

_ALL_KPIS = (
    f"{S.REC}, {S.OWL}, {S.RADIO}, {S.IP_DAILY}, {S.RESTART_DAILY}, {_AIR_DAILY}, {_IP_KPI}, {_AIR_KPI}, "
    f"{_RESTART_KPI}, {_STEER_KPI}, {_RSSI}, {_RSSI_KPI}, {_PHY}, {_PHY_KPI}, {_DROPS.format(limit=3)}, {_MODELS}"
)
_FILLED_LABELS = [f'"{c}"' for c in D.FILLED_LABELS]
_FILLED_COUNTS = [f'"{c}"' for c in D.FILLED_COUNTS]


def _num(c):
    return f"CASE {c} WHEN 'Poor' THEN 1 WHEN 'Fair' THEN 2 WHEN 'Good' THEN 3 WHEN 'Excellent' THEN 4 END"


def _cut(c):
    return (
        f"CASE WHEN {c} < 1.5 THEN 'Poor' WHEN {c} < 2.5 THEN 'Fair' WHEN {c} < 3.5 THEN 'Good' "
        f"WHEN {c} >= 3.5 THEN 'Excellent' END"
    )


def _home_sql():
    labels = [*_FILLED_LABELS, "phyrate_category", '"RSSI_category"']
    fills = ", ".join([f"coalesce({c}, 'Excellent') AS {c}" for c in _FILLED_LABELS] + [f"coalesce({c}, 0) AS {c}" for c in _FILLED_COUNTS])
    nums = ", ".join(f"CAST({_num(c)} AS BIGINT) AS \"{c.strip(chr(34))}_numeric\"" for c in labels)
    rel = [f'"{c}_numeric"' for c in D.RELIABILITY]
    spd = [f'"{c}_numeric"' for c in D.SPEED]

    def mean(cols):
        return "(" + " + ".join(f"coalesce({c}, 0)" for c in cols) + ") / nullif(" + " + ".join(
            f"CASE WHEN {c} IS NULL THEN 0 ELSE 1 END" for c in cols) + ", 0)"

    worst = f"least({_num('rel')}, {_num('spd')}, {_num('cov')})"
    return f"""WITH {_ALL_KPIS},
    j AS (SELECT * FROM ip_kpi FULL JOIN steer_kpi USING (sn) FULL JOIN restart_kpi USING (sn)
          FULL JOIN rssi_kpi USING (sn) FULL JOIN phy_kpi USING (sn) FULL JOIN air_kpi USING (sn)
          FULL JOIN drops USING (sn)),
    f AS (SELECT * REPLACE ({fills}), '01-30-2024' AS day FROM j JOIN mods USING (sn)),
    n AS (SELECT *, {nums} FROM f),
    s AS (SELECT *, {S.half_up(mean(rel), 2)} AS nr, {S.half_up(mean(spd), 2)} AS ns, rssi_numeric AS nc FROM n),
    t AS (SELECT *, {_cut('nr')} AS rel, {_cut('ns')} AS spd, {_cut('nc')} AS cov FROM s)
    SELECT * EXCLUDE (nr, ns, nc, rel, spd, cov), nr AS "numerical_reliabilityScore", ns AS "numerical_speedScore",
      nc AS "numerical_coverageScore", rel AS "reliabilityScore", spd AS "speedScore", cov AS "coverageScore",
      CASE {worst} WHEN 1 THEN 'Poor' WHEN 2 THEN 'Fair' WHEN 3 THEN 'Good' WHEN 4 THEN 'Excellent' END AS wifi_score
    FROM t"""


def _daily(spark, sf_dir):
    return D.daily_home_score(
        _history(spark, sf_dir), data.device_groups(spark, sf_dir), _owl(spark, sf_dir), DAY, tiebreak=["event_id"]
    )


@query("daily_home_score", _home_sql())
def daily_home_score(spark, sf_dir):
    return _daily(spark, sf_dir)


# ------------------------------------------------------------------- day jobs


def _day_jobs_sql():
    """Two days with the same telemetry: look-backs of the first end a day earlier,
    those of the second have both days' airtime."""
    windows = {
        "'2024-01-20' AND '2024-01-29'": "'2024-01-19' AND '2024-01-28'",
        "'2024-01-01' AND '2024-01-30'": "'2023-12-31' AND '2024-01-29'",
        "'01-30-2024' AS day": "'01-29-2024' AS day",
    }
    earlier = _home_sql()
    for own, before in windows.items():
        earlier = earlier.replace(own, before)
    later = _home_sql().replace("count(*) FILTER (WHERE util > 70) AS no_poor", "2 * count(*) FILTER (WHERE util > 70) AS no_poor")
    parts = [("home", data.DATE_BEFORE, earlier), ("home", data.SCORE_DATE, later)]
    parts += [("station", d, _pair_sql()) for d in (data.DATE_BEFORE, data.SCORE_DATE)]
    return " UNION ALL BY NAME ".join(f"SELECT '{kind}' AS kind, '{d}' AS date, * FROM ({sql})" for kind, d, sql in parts)


@query("day_jobs", _day_jobs_sql())
def day_jobs(spark, sf_dir):
    """The newer day is scored first, the back-fill finds the older one and runs it once;
    then the newer day is scored anew and read in its second version."""
    base = run_dir(spark, "daily")
    paths = DailyPaths(*(f"{base}/{t}" for t in ("history", "groups", "events", "mobility", "stations", "homes")))
    for path, records in ((paths.history, _history(spark, sf_dir)), (paths.groups, data.device_groups(spark, sf_dir))):
        sinks.write_partitions(data.day_earlier(records).unionByName(records), path)
    events = _owl(spark, sf_dir).withColumn("date", F.date_format(F.timestamp_millis("ts"), "yyyyMMdd"))
    sinks.write_partitions(events, paths.events, ["date"])
    days, order = [data.DATE_BEFORE, data.SCORE_DATE], {"tiebreak": ["event_id"]}
    score_day(spark, paths, data.SCORE_DATE, **order)
    for jobs in (3, 0):
        if len(backfill_days(spark, paths, days, **order)) != jobs:
            raise RuntimeError("the back-fill did not run all outputs of the missing day, once")
    homes, stations = by_date(spark, paths.homes), by_date(spark, paths.stations)
    score_day(spark, paths, data.SCORE_DATE, outputs=["stations"], **order)
    if stations.superseded().count() != 1:
        raise RuntimeError("the second version of a day did not replace the first")
    parts = [table.read().withColumn("kind", F.lit(kind)) for table, kind in ((homes, "home"), (stations, "station"))]
    return parts[0].unionByName(parts[1], allowMissingColumns=True)


# ------------------------------------------------------------ label functions


@query(
    "label_roundtrip",
    f"""WITH {S.REC}, {_RSSI}, {_RSSI_KPI}
    SELECT sn, rssi_numeric, "RSSI_category" AS kpi_label, {_cut('rssi_numeric')} AS pillar_label,
      CAST({_num('"RSSI_category"')} AS BIGINT) AS kpi_score FROM rssi_kpi""",
)
def label_roundtrip(spark, sf_dir):
    kpi = D.rssi_kpi(D.rssi_stations(_history(spark, sf_dir)))
    return kpi.select(
        "sn", "rssi_numeric",
        bucketize("rssi_numeric", KPI_CUTS).alias("kpi_label"),
        bucketize("rssi_numeric", PILLAR_CUTS).alias("pillar_label"),
        label_to_score("RSSI_category").alias("kpi_score"),
    )


_WM = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
    CASE WHEN l_tax > 0.015 THEN CAST(l_linenumber AS DOUBLE) END AS a,
    CASE WHEN l_discount > 0.015 THEN CAST(l_partkey % 5 AS DOUBLE) END AS b,
    CASE WHEN l_quantity > 10 THEN CAST(l_suppkey % 3 AS DOUBLE) END AS c FROM lineitem"""


@query(
    "weighted_mean",
    f"""SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, round(
      (coalesce(a * 0.5, 0) + coalesce(b * 0.3, 0) + coalesce(c * 0.2, 0)) / nullif(
      (CASE WHEN a IS NULL THEN 0.0 ELSE 0.5 END + CASE WHEN b IS NULL THEN 0.0 ELSE 0.3 END
       + CASE WHEN c IS NULL THEN 0.0 ELSE 0.2 END), 0), 6) AS score FROM ({_WM})""",
)
def weighted_mean_query(spark, sf_dir):
    rows = data.table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey",
        "CASE WHEN l_tax > 0.015 THEN CAST(l_linenumber AS DOUBLE) END AS a",
        "CASE WHEN l_discount > 0.015 THEN CAST(l_partkey % 5 AS DOUBLE) END AS b",
        "CASE WHEN l_quantity > 10 THEN CAST(l_suppkey % 3 AS DOUBLE) END AS c",
    )
    score = F.round(weighted_mean({"a": 0.5, "b": 0.3, "c": 0.2}), 6).alias("score")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", score)


_WORST = """SELECT l_orderkey, l_linenumber, l_partkey,
    CASE l_partkey % 5 WHEN 0 THEN 'Poor' WHEN 1 THEN 'Fair' WHEN 2 THEN 'Good' WHEN 3 THEN 'Excellent' END AS a,
    CASE l_suppkey % 5 WHEN 1 THEN 'Fair' WHEN 2 THEN 'Good' WHEN 3 THEN 'Excellent' END AS b,
    CASE l_orderkey % 4 WHEN 2 THEN 'Good' WHEN 3 THEN 'Excellent' END AS c FROM lineitem"""


@query(
    "worst_of",
    f"""SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, CASE least({_num('a')}, {_num('b')}, {_num('c')})
      WHEN 1 THEN 'Poor' WHEN 2 THEN 'Fair' WHEN 3 THEN 'Good' WHEN 4 THEN 'Excellent' END AS worst FROM ({_WORST})""",
)
def worst_of(spark, sf_dir):
    def label(x, *names):
        chain = F
        for value, name in names:
            chain = chain.when(x == value, name)
        return chain

    rows = data.table(spark, sf_dir, "lineitem")
    a = label(F.col("l_partkey") % 5, (0, "Poor"), (1, "Fair"), (2, "Good"), (3, "Excellent"))
    b = label(F.col("l_suppkey") % 5, (1, "Fair"), (2, "Good"), (3, "Excellent"))
    c = label(F.col("l_orderkey") % 4, (2, "Good"), (3, "Excellent"))
    labels = rows.select("l_orderkey", "l_linenumber", "l_partkey", a.alias("a"), b.alias("b"), c.alias("c"))
    return labels.withColumn("worst", worst_label("a", "b", "c")).drop("a", "b", "c")


@query(
    "station_vote",
    f"""WITH {S.REC} SELECT sn, hour, CASE WHEN greatest(p1, p2, p3) >= 12 THEN 'Poor' WHEN greatest(f1, f2, f3) >= 12 THEN 'Fair'
      WHEN greatest(g1, g2, g3) >= 12 THEN 'Good' WHEN greatest(e1, e2, e3) >= 12 THEN 'Excellent' ELSE 'No Data' END AS category
    FROM (SELECT sn, hour,
      count(*) FILTER (WHERE band = '2.4GI' AND rssi < -78) AS p3, count(*) FILTER (WHERE band = '2.4GI' AND rssi BETWEEN -78 AND -71) AS f3,
      count(*) FILTER (WHERE band = '2.4GI' AND rssi BETWEEN -70 AND -56) AS g3, count(*) FILTER (WHERE band = '2.4GI' AND rssi > -56) AS e3,
      count(*) FILTER (WHERE band = '5GI' AND rssi < -75) AS p1, count(*) FILTER (WHERE band = '6GI' AND rssi < -70) AS p2,
      count(*) FILTER (WHERE band = '5GI' AND rssi BETWEEN -75 AND -71) AS f1,
      count(*) FILTER (WHERE band = '6GI' AND rssi BETWEEN -70 AND -65) AS f2,
      count(*) FILTER (WHERE band = '5GI' AND rssi BETWEEN -70 AND -56) AS g1,
      count(*) FILTER (WHERE band = '6GI' AND rssi BETWEEN -64 AND -56) AS g2,
      count(*) FILTER (WHERE band = '5GI' AND rssi > -56) AS e1, count(*) FILTER (WHERE band = '6GI' AND rssi > -56) AS e2
      FROM rec GROUP BY sn, hour)""",
)
def station_vote(spark, sf_dir):
    from ..functions.profiles import DAILY_RSSI, LABELS
    from ..plans.hourly import connection_records

    records = connection_records(_history(spark, sf_dir))
    bands = {"2_4G": "2.4GI", "5G": "5GI", "6G": "6GI"}
    counts = [
        F.count_if((F.col("band") == bands[b]) & (bucketize("rssi", DAILY_RSSI[b]) == lab)).alias(f"{lab}_{b}")
        for lab in LABELS for b in bands
    ]
    counted = records.groupBy("sn", "hour").agg(*counts)
    return counted.select(
        "sn", "hour", vote({lab: [f"{lab}_{b}" for b in bands] for lab in LABELS}, 12).alias("category")
    )


# ----------------------------------------------------------- merge and export


@query(
    "location_export",
    f"""WITH {S.LI}, {_MODELS}
    SELECT m.sn, model_name, right(m.sn, 4) || '-' || m.sn AS rowkey, s.s_name AS mdn, n.n_name AS state, r.r_name AS county,
      s.s_acctbal AS latitude, CAST(n.n_regionkey AS DOUBLE) AS longitude
    FROM mods m LEFT JOIN (supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
      JOIN region r ON n.n_regionkey = r.r_regionkey)
      ON m.sn = 'HM' || lpad(CAST(s.s_suppkey AS VARCHAR), 8, '0')
    WHERE model_name IN ('MODEL-0', 'MODEL-2', 'EXT-1')""",
)
def location_export(spark, sf_dir):
    scores = D.models(data.device_groups(spark, sf_dir))
    return D.export_rows(D.with_location(scores, _places(spark, sf_dir)), ["MODEL-0", "MODEL-2", "EXT-1"])


def _places(spark, sf_dir):
    nation, region = (data.table(spark, sf_dir, t) for t in ("nation", "region"))
    return (
        data.table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.concat(F.lit("HM"), F.lpad(F.col("s_suppkey").cast("string"), 8, "0")).alias("sn"),
            F.col("s_name").alias("mdn"), F.col("n_name").alias("state"), F.col("r_name").alias("county"),
            F.col("s_acctbal").alias("latitude"), F.col("n_regionkey").cast("double").alias("longitude"),
        )
    )


@query(
    "key_blocklist",
    f"WITH {S.LI}, {_MODELS} SELECT * FROM mods WHERE sn NOT IN ('HM00000003', 'EX00000007')",
)
def key_blocklist(spark, sf_dir):
    return exclude_keys(D.models(data.device_groups(spark, sf_dir)), "sn", ["HM00000003", "EX00000007"])
