"""Reshaping, merging, sources, sinks, features, legacy score and reports."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import telemetry as data
from ..functions import parsing as P
from ..functions.profiles import DAILY_RSSI, bucketize
from ..operators import shape
from ..operators.ranking import top_rows
from ..operators.stationarity import mobility
from ..plans import daily as D
from ..plans import features as X
from ..plans import hourly as H
from ..plans import legacy as L
from ..plans import reports as R
from ..session import run_dir
from ..sources import gaps, sinks, tables
from . import daily_queries as DQ
from . import sql as S
from .base import query


# -------------------------------------------------------------- shape and merge

_UPDATE = "o_orderpriority IN ('1-URGENT', '3-MEDIUM')"


def _orders(spark, sf_dir):
    return data.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


def _updates(orders):
    fresh = orders.where("o_totalprice > 400000").where(F.col("o_orderpriority").isin("1-URGENT", "3-MEDIUM"))
    return fresh.withColumn("o_orderstatus", F.lit("U"))


_REPLACE = f"""WITH o AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders),
    u AS (SELECT * REPLACE ('U' AS o_orderstatus) FROM o WHERE o_totalprice > 400000 AND {_UPDATE})
    SELECT * FROM o WHERE o_custkey NOT IN (SELECT o_custkey FROM u) UNION ALL SELECT * FROM u"""


@query("replace_rows", _REPLACE)
def replace_rows(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    return shape.with_fallback(orders, _updates(orders), "o_custkey")


@query(
    "union_by_name",
    """SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS nation
    FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL, NULL FROM supplier
    UNION ALL SELECT CAST(n_nationkey AS BIGINT), n_name, NULL, NULL, n_name FROM nation""",
)
def union_by_name(spark, sf_dir):
    customer, supplier, nation = (data.table(spark, sf_dir, t) for t in ("customer", "supplier", "nation"))
    return shape.union_frames(
        [
            customer.selectExpr("c_custkey AS id", "c_name AS name", "c_acctbal AS balance", "c_mktsegment AS segment"),
            supplier.selectExpr("s_acctbal AS balance", "s_suppkey AS id", "s_name AS name"),
            nation.selectExpr("CAST(n_nationkey AS BIGINT) AS id", "n_name AS name", "n_name AS nation"),
        ]
    )


@query(
    "merge_features",
    """WITH e AS (SELECT user_id, event_type, value FROM events),
    a AS (SELECT user_id, count(*) AS clicks FROM e WHERE event_type = 'click' GROUP BY 1),
    b AS (SELECT user_id, count(*) AS big FROM e WHERE value > 40 GROUP BY 1),
    c AS (SELECT user_id, max(value) AS top FROM e WHERE event_type = 'purchase' GROUP BY 1)
    SELECT user_id, coalesce(clicks, 0) AS clicks, coalesce(big, 0) AS big, top
    FROM a FULL JOIN b USING (user_id) FULL JOIN c USING (user_id)""",
)
def merge_features(spark, sf_dir):
    e = data.table(spark, sf_dir, "events")
    parts = [
        e.where("event_type = 'click'").groupBy("user_id").agg(F.count(F.lit(1)).alias("clicks")),
        e.where("value > 40").groupBy("user_id").agg(F.count(F.lit(1)).alias("big")),
        e.where("event_type = 'purchase'").groupBy("user_id").agg(F.max("value").alias("top")),
    ]
    return shape.fill(shape.merge_features(parts, "user_id"), {"clicks": 0, "big": 0})


@query(
    "json_extract",
    "SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events WHERE props IS NOT NULL",
)
def json_extract(spark, sf_dir):
    events = data.table(spark, sf_dir, "events").where(F.col("props").isNotNull())
    return events.select("event_id", P.json_field(F.col("props"), "k").try_cast("bigint").alias("k"))


@query(
    "zip_explode",
    f"""WITH {S.LI} SELECT sn, l_orderkey, l_partkey, hour_no, i, enable, util FROM (
      SELECT sn, l_orderkey, l_partkey, hour_no, 0 AS i, CASE WHEN l_linenumber % 4 = 0 THEN '0' ELSE '1' END AS enable,
        CAST((l_partkey * (1 + l_suppkey % 3)) % 101 AS VARCHAR) AS util FROM li
      UNION ALL SELECT sn, l_orderkey, l_partkey, hour_no, 1, '1',
        CASE WHEN l_orderkey % 10 = 0 THEN '' ELSE CAST(l_orderkey % 111 AS VARCHAR) END FROM li)""".replace(
        "SELECT sn, l_orderkey, l_partkey, hour_no, i, enable, util FROM",
        "SELECT sn, CAST(hour_no AS BIGINT) AS hour_no, CAST(i AS BIGINT) AS i, enable, util, count(*) AS n FROM",
    ) + " GROUP BY ALL",
)
def zip_explode(spark, sf_dir):
    info = "Group_Diag_History_radio_wifi_info"
    zipped = F.arrays_zip(
        F.col(f"{info}._2_4g.airtime_util").alias("util"), F.col(f"{info}._2_4g.enable").alias("enable")
    )
    samples = data.device_groups(spark, sf_dir).select(
        P.serial(F.col("rowkey"), P.ROUTER_OF_GROUP).alias("sn"), F.col("hour").cast("bigint").alias("hour_no"),
        F.posexplode(zipped).alias("i", "z"),
    )
    return samples.groupBy("sn", "hour_no", "i", "z.enable", "z.util").agg(F.count(F.lit(1)).alias("n"))


@query(
    "flatten_nested",
    f"""WITH {S.LI}, d AS (
      SELECT right(sn, 4) || '-' || sn AS rowkey, sn AS s, 'MODEL-' || CAST(l_suppkey % 4 AS VARCHAR) AS m,
        'RTR' || CAST(l_suppkey AS VARCHAR) AS mac, NULL AS p, 'fw' || CAST(l_linenumber AS VARCHAR) AS fw FROM li
      UNION ALL SELECT right(sn, 4) || '-' || sn, 'EX' || substring(sn, 3, 8), 'EXT-' || CAST(l_suppkey % 3 AS VARCHAR),
        'EXT' || CAST(l_suppkey AS VARCHAR), 'RTR' || CAST(l_suppkey AS VARCHAR), 'ex' || CAST(l_linenumber AS VARCHAR) FROM li)
    SELECT rowkey, s AS "Group_Data_sys_info_b_sn", m AS "Group_Data_sys_info_b_model", mac AS "Group_Data_sys_info_b_mac",
      p AS "Group_Data_sys_info_b_parent_mac", fw AS "Group_Data_sys_info_b_fw", count(*) AS n FROM d GROUP BY ALL""",
)
def flatten_nested(spark, sf_dir):
    flat = shape.flatten(data.device_groups(spark, sf_dir).select("rowkey", "Group_Data_sys_info"))
    return flat.groupBy(*flat.columns).agg(F.count(F.lit(1)).alias("n"))


@query(
    "flatten_station",
    f"""WITH {S.REC} SELECT rowkey, rssi AS "Station_Data_connect_data_b_signal_strength",
      band AS "Station_Data_connect_data_b_connect_type", band_station AS "Diag_Result_band_steer_b_sta_type",
      band_action AS "Diag_Result_band_steer_b_action", count(*) AS n FROM rec GROUP BY ALL""",
)
def flatten_station(spark, sf_dir):
    flat = shape.flatten(data.station_history(spark, sf_dir).drop("ts", "date", "hour", "Tplg_Data_model_name"))
    keys = ["rowkey", "Station_Data_connect_data_b_signal_strength", "Station_Data_connect_data_b_connect_type",
            "Diag_Result_band_steer_b_sta_type", "Diag_Result_band_steer_b_action"]
    return flat.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


@query(
    "round_columns",
    f"""SELECT s_nationkey::BIGINT AS nation, {S.half_up('avg(s_acctbal)', 2)} AS mean,
    {S.half_up('max(s_acctbal) / 7', 2)} AS seventh, count(*) AS n FROM supplier GROUP BY 1""",
)
def round_columns(spark, sf_dir):
    grouped = data.table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(
        F.avg("s_acctbal").alias("mean"), (F.max("s_acctbal") / 7).alias("seventh"), F.count(F.lit(1)).alias("n")
    )
    return shape.round_columns(shape.round_columns(grouped, 9), 2)


# ----------------------------------------------------------- features, ranking

_FEATURES = f"""{S.REC}, {S.OWL},
names AS (SELECT rowkey, station_name, row_number() OVER (PARTITION BY rowkey ORDER BY n DESC, station_name NULLS LAST) AS rk
          FROM (SELECT rowkey, station_name, count(*) AS n FROM rec GROUP BY ALL)),
top10 AS (SELECT rowkey, coalesce(string_agg(station_name, ',' ORDER BY station_name), '') AS names FROM names
          WHERE rk <= 10 GROUP BY rowkey),
st AS (SELECT rowkey, {S.half_up("avg(rssi) FILTER (WHERE band LIKE '2.%')", 2)} AS avg_2_4_signal_strength,
    {S.half_up("avg(rssi) FILTER (WHERE band LIKE '5G%')", 2)} AS "avg_5G_signal_strength",
    {S.half_up("avg(rssi) FILTER (WHERE band LIKE '6G%')", 2)} AS "avg_6G_signal_strength",
    CAST(sum(sent) AS BIGINT) AS total_byte_send, CAST(sum(received) AS BIGINT) AS total_byte_received,
    nullif(count(*) FILTER (WHERE mode BETWEEN 5 AND 11), 0) AS total_count_mode,
    {S.half_up("avg(bw) FILTER (WHERE bw BETWEEN 0 AND 5)", 4)} AS avg_bandwidth,
    {S.half_up("avg(airtime_util)", 4)} AS avg_airtime_util, {S.half_up("avg(channel)", 4)} AS avg_channel,
    nullif(count(*) FILTER (WHERE band_station = '2'), 0) AS band_steer,
    nullif(count(*) FILTER (WHERE ap_station = '2'), 0) AS ap_steer FROM rec GROUP BY rowkey),
rt AS (SELECT rowkey, nullif(count(*) FILTER (WHERE reboot AND reason = 'GUI'), 0) AS "restart_GUI",
    count(*) AS ch_change FROM owl2 GROUP BY rowkey)"""


@query(
    "feature_table",
    f"""WITH {_FEATURES} SELECT * EXCLUDE (names), names AS top_10_station_names
    FROM top10 FULL JOIN st USING (rowkey) FULL JOIN rt USING (rowkey)""",
)
def feature_table(spark, sf_dir):
    return X.feature_table(data.station_history(spark, sf_dir), data.owl_history(spark, sf_dir))


@query("top10_names", f"WITH {_FEATURES} SELECT rowkey, names AS top_10_station_names FROM top10")
def top10_names(spark, sf_dir):
    return X.top_names(data.station_history(spark, sf_dir))


def _scan_sql():
    parts = []
    for band, step in (("2_4g", 1), ("5g", 2), ("6g", 3)):
        for point in (f"(l_orderkey * {step}) % 37", f"(l_orderkey * {step} + 1) % 37", "l_partkey % 41"):
            parts.append(f"SELECT sn, '{band}' AS band, {point} AS b FROM li WHERE l_tax > {data.HEARD[step]}")
    return " UNION ALL ".join(parts)


@query(
    "neighbor_distinct",
    f"""WITH {S.LI}, scans AS ({_scan_sql()}) SELECT right(sn, 4) || '-' || sn AS rowkey,
    nullif(count(DISTINCT b) FILTER (WHERE band = '2_4g'), 0) AS distinct_2_4g_bssid_count,
    nullif(count(DISTINCT b) FILTER (WHERE band = '5g'), 0) AS distinct_5g_bssid_count,
    nullif(count(DISTINCT b) FILTER (WHERE band = '6g'), 0) AS distinct_6g_bssid_count FROM scans GROUP BY sn""",
)
def neighbor_distinct(spark, sf_dir):
    return X.neighbours(data.neighbour_scans(spark, sf_dir))


# ---------------------------------------------------------------- legacy score

_LEGACY = f"""{S.REC},
kept AS (SELECT *, sn AS serial_num, right(sn, 4) || '-' || sn AS rk_row_sn, left(band, 2) AS code, tx_phy_rate AS rate
         FROM rec WHERE left(band, 2) IN ('2.', '5G', '6G') AND rssi IS NOT NULL AND tx_phy_rate IS NOT NULL),
sb AS (SELECT rowkey, max(rssi) AS top, quantile_disc(rssi, [0.03, 0.1, 0.5, 0.9]) AS p FROM kept GROUP BY rowkey),
fixed AS (SELECT rowkey, CASE WHEN p[4] - p[3] <= 5 THEN '1' ELSE '0' END AS stationarity FROM sb
          WHERE top > least(p[2] - 2 * (p[4] - p[2]), p[1])),
rs AS (SELECT rowkey, rk_row_sn, serial_num, station_mac, count(*) AS n,
    100.0 * count(*) FILTER (WHERE (code = '2.' AND rssi < -78) OR (code = '5G' AND rssi < -75) OR (code = '6G' AND rssi < -70))
      / count(*) AS poor_rssi, sum(sent) + sum(received) AS total
  FROM kept GROUP BY ALL HAVING count(*) >= 36),
ph AS (SELECT rowkey, avg(rate) AS avg_phyrate, 100.0 * count(*) FILTER (WHERE rate < 65) / count(*) AS poor_phyrate
  FROM kept WHERE rate > 6 AND rate < 2500 AND rate NOT IN (12, 24) GROUP BY rowkey),
dev AS (SELECT rs.*, avg_phyrate, poor_phyrate, stationarity, CASE WHEN total > 0 THEN ln(total) END AS volume,
    (100 - poor_rssi) * 0.5 + (100 - poor_phyrate) * 0.5 AS device_score
  FROM rs JOIN ph USING (rowkey) JOIN fixed USING (rowkey)),
w0 AS (SELECT *, volume / sum(volume) OVER (PARTITION BY serial_num) AS w FROM dev),
w1 AS (SELECT * REPLACE (CASE WHEN avg_phyrate < 20.718 AND stationarity = '1' THEN w * avg_phyrate / 20.718 ELSE w END AS w) FROM w0),
w2 AS (SELECT *, w / sum(w) OVER (PARTITION BY serial_num) AS share FROM w1),
mapping AS (SELECT s_name AS mdn, 'HM' || lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS serial_num,
    'C' || CAST(s_nationkey AS VARCHAR) AS cust_id FROM supplier WHERE s_acctbal > 0),
boxes AS (SELECT DISTINCT right(sn, 4) || '-' || sn AS rk, 'RTR' || CAST(l_suppkey AS VARCHAR) AS mac,
    'MODEL-' || CAST(l_suppkey % 4 AS VARCHAR) AS model, NULL AS parent FROM li
  UNION ALL SELECT DISTINCT right(sn, 4) || '-' || sn, 'EXT' || CAST(l_suppkey AS VARCHAR),
    'EXT-' || CAST(l_suppkey % 3 AS VARCHAR), 'RTR' || CAST(l_suppkey AS VARCHAR) FROM li),
roles AS (SELECT k.rowkey, k.serial_num, k.parent_id, model, CASE WHEN parent IS NULL THEN 0 ELSE 1 END AS role
  FROM (SELECT DISTINCT rowkey, serial_num, rk_row_sn, parent_id FROM kept) k
  LEFT JOIN boxes ON rk = rk_row_sn AND mac = parent_id)"""


def _legacy_records(spark, sf_dir):
    return L.home_records(data.station_history(spark, sf_dir))


def _mapping_rows(spark, sf_dir):
    return data.table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("mdn_5g"),
        F.concat(F.lit("HM"), F.lpad(F.col("s_suppkey").cast("string"), 8, "0")).alias("serialnumber"),
        F.concat(F.lit("C"), F.col("s_nationkey").cast("string")).alias("cust_id"),
        F.when(F.col("s_acctbal") > 0, "INSTALL COMPLETE").otherwise("PENDING").alias("status"),
    )


def _mapping(spark, sf_dir):
    """Mapping CSVs of two days; the newest existing one is read back."""
    base = run_dir(spark, "mapping")
    template = base + "/{}/mapping.csv"
    sinks.export_csv(_mapping_rows(spark, sf_dir), template.format("2024-01-27"))
    return tables.read_mapping(spark, tables.newest(spark, template, tables.days_back(data.SCORE_DAY, 5, 1)))


@query(
    "mapping_csv",
    """SELECT s_name AS mdn, 'HM' || lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS serial_num,
    'C' || CAST(s_nationkey AS VARCHAR) AS cust_id FROM supplier WHERE s_acctbal > 0""",
)
def mapping_csv(spark, sf_dir):
    return _mapping(spark, sf_dir)


@query(
    "poor_share_devices",
    f"""WITH {_LEGACY} SELECT rowkey, serial_num, station_mac, stationarity, round(avg_phyrate, 6) AS avg_phyrate,
    round(poor_rssi, 6) AS poor_rssi, round(poor_phyrate, 6) AS poor_phyrate, round(device_score, 6) AS device_score,
    round(volume, 6) AS volume FROM dev""",
)
def poor_share_devices(spark, sf_dir):
    features = L.device_features(L.signal_levels(_legacy_records(spark, sf_dir)))
    rounded = ("avg_phyrate", "poor_rssi", "poor_phyrate", "device_score", "volume")
    return features.select(
        "rowkey", "serial_num", "station_mac", "stationarity", *(F.round(c, 6).alias(c) for c in rounded)
    )


@query(
    "poor_share_score",
    f"""WITH {_LEGACY},
    home AS (SELECT w2.serial_num, m.mdn, m.cust_id, count(*) AS num_station, {S.half_up('sum(poor_rssi * share)', 4)} AS poor_rssi,
        {S.half_up('sum(poor_phyrate * share)', 4)} AS poor_phyrate, {S.half_up('sum(device_score * share)', 4)} AS home_score
      FROM w2 LEFT JOIN mapping m USING (serial_num) GROUP BY ALL),
    sets AS (SELECT serial_num, string_agg(DISTINCT model, ',' ORDER BY model) AS dg_model,
        string_agg(DISTINCT CAST(role AS VARCHAR), ',' ORDER BY CAST(role AS VARCHAR)) AS "Rou_Ext"
      FROM roles JOIN w2 USING (rowkey, serial_num) GROUP BY serial_num),
    models AS (SELECT DISTINCT serial_num, model FROM roles JOIN w2 USING (rowkey, serial_num) WHERE model IS NOT NULL)
    SELECT home.*, dg_model, "Rou_Ext", model AS dg_model_indiv, '2024-01-30' AS date
    FROM home JOIN sets USING (serial_num) JOIN models USING (serial_num)""",
)
def poor_share_score(spark, sf_dir):
    homes = L.home_percentages(
        _legacy_records(spark, sf_dir), data.device_groups(spark, sf_dir), _mapping(spark, sf_dir), data.SCORE_DAY
    )
    return homes.withColumn("Rou_Ext", F.transform("Rou_Ext", lambda x: x.cast("string")))


_SETS = {"RouExt_mac": "mac", "dg_model": "model", "parent_mac": "parent", "firmware": "firmware", "parent_id": "parent_id", "Rou_Ext": "role"}


@query(
    "device_table",
    f"""WITH {_LEGACY},
    fws AS (SELECT right(sn, 4) || '-' || sn AS rk, 'RTR' || CAST(l_suppkey AS VARCHAR) AS mac, max('fw' || CAST(l_linenumber AS VARCHAR)) AS firmware
        FROM li GROUP BY ALL UNION ALL
      SELECT right(sn, 4) || '-' || sn, 'EXT' || CAST(l_suppkey AS VARCHAR), max('ex' || CAST(l_linenumber AS VARCHAR)) FROM li GROUP BY ALL),
    hung AS (SELECT k.rowkey, parent_id, mac, model, parent, firmware, CASE WHEN parent IS NULL THEN '0' ELSE '1' END AS role
      FROM (SELECT DISTINCT rowkey, rk_row_sn, parent_id FROM kept) k LEFT JOIN (boxes JOIN fws USING (rk, mac)) ON rk = rk_row_sn AND mac = parent_id),
    sets AS (SELECT rowkey, {", ".join(f"coalesce(string_agg(DISTINCT {v}, ',' ORDER BY {v}), '') AS " + f'"{k}"' for k, v in _SETS.items())}
      FROM hung GROUP BY rowkey),
    levels AS (SELECT rowkey, {", ".join(f"avg(rssi) FILTER (WHERE code = '{c}') AS cat{i}" for i, c in enumerate(L.WEAK, start=1))} FROM kept GROUP BY rowkey)
    SELECT w0.rowkey, rk_row_sn, w0.serial_num, station_mac, mdn, cust_id, '2024-01-30' AS date, sets.* EXCLUDE (rowkey),
      CAST(stationarity AS DOUBLE) AS stationarity, round(avg_phyrate, 6) AS avg_phyrate, round(poor_phyrate, 6) AS poor_phyrate,
      round(volume, 6) AS volume, round(w, 6) AS weights, round(poor_rssi, 6) AS poor_rssi,
      {", ".join(f"round(cat{i}, 6) AS avg_sig_strength_cat{i}" for i in (1, 2, 3))}
    FROM w0 JOIN sets USING (rowkey) JOIN levels USING (rowkey) LEFT JOIN mapping USING (serial_num)""",
)
def device_table(spark, sf_dir):
    out = L.device_table(
        _legacy_records(spark, sf_dir), data.device_groups(spark, sf_dir), _mapping(spark, sf_dir), data.SCORE_DAY
    )
    measures = ("avg_phyrate", "poor_phyrate", "volume", "weights", "poor_rssi", *(f"avg_sig_strength_cat{i}" for i in (1, 2, 3)))
    rounded = out.withColumns({c: F.round(c, 6) for c in measures})
    return rounded.withColumn("Rou_Ext", F.transform("Rou_Ext", lambda x: x.cast("string")))


@query(
    "router_extender",
    f"""WITH {_LEGACY} SELECT rowkey, serial_num, parent_id, model AS dg_model, CAST(role AS BIGINT) AS "Rou_Ext" FROM roles""",
)
def router_extender(spark, sf_dir):
    records = _legacy_records(spark, sf_dir)
    roles = L.with_roles(L.attachments(records), L.group_devices(data.device_groups(spark, sf_dir)))
    return roles.select("rowkey", "serial_num", "parent_id", "dg_model", "Rou_Ext")


@query(
    "consumption_report",
    f"""WITH {S.REC}, {DQ._RSSI}, {DQ._RSSI_KPI}
    SELECT "RSSI_category" AS score, CASE WHEN band LIKE '2.4G%' THEN '2_4G' ELSE '5G' END AS connect_type,
      CAST(sum(s) AS BIGINT) AS data_volume
    FROM (SELECT sn, rowkey, band, sum(sent) + sum(received) AS s FROM rec
          WHERE band LIKE '2.4G%' OR band LIKE '5G%' GROUP BY ALL) JOIN rssi_kpi USING (sn)
    WHERE rowkey IN (SELECT rowkey FROM rec WHERE station_name IS NOT NULL) GROUP BY 1, 2""",
)
def consumption_report(spark, sf_dir):
    history = data.station_history(spark, sf_dir)
    devices = history.where(F.col("Station_Data_connect_data.station_name").isNotNull()).select("rowkey")
    scores = D.rssi_kpi(D.rssi_stations(history)).withColumnRenamed("RSSI_category", "score")
    return L.consumption_report(L.station_bytes(history), devices, scores)


@query(
    "consumption_by_class",
    f"""WITH homes AS ({DQ._home_sql()}), {S.REC},
    known AS (SELECT DISTINCT rowkey, CASE CAST(right(station_mac, 2) AS BIGINT) % 4 WHEN 0 THEN 'Phone' WHEN 1 THEN 'Computer' WHEN 2 THEN 'Television' END
      AS device_class FROM rec)
    SELECT wifi_score AS score, device_class, CASE WHEN band LIKE '2.4G%' THEN '2_4G' ELSE '5G' END AS connect_type, CAST(sum(s) AS BIGINT) AS data_volume
    FROM (SELECT sn, rowkey, band, sum(sent) + sum(received) AS s FROM rec WHERE band LIKE '2.4G%' OR band LIKE '5G%' GROUP BY ALL)
    JOIN known USING (rowkey) JOIN homes USING (sn) WHERE device_class IS NOT NULL AND model_name IN ('MODEL-1', 'MODEL-3') GROUP BY ALL""",
)
def consumption_by_class(spark, sf_dir):
    history = data.station_history(spark, sf_dir)
    number = F.substring("Station_Data_connect_data.station_mac", -2, 2).cast("int") % 4
    named = F.when(number == 0, "Phone").when(number == 1, "Computer").when(number == 2, "Television")
    classes = history.select("rowkey", named.alias("device_class")).where("device_class is not null")
    return L.consumption_by_class(L.station_bytes(history), classes, DQ._daily(spark, sf_dir), ["MODEL-1", "MODEL-3"])


# ------------------------------------------------------------ sources and sinks


@query(
    "partition_roundtrip",
    f"""WITH {S.REC} SELECT station_mac, date, hour,
    CAST(sum(bytes) + max(CASE WHEN hour = '12' THEN 0 ELSE 1 END) AS BIGINT) AS total_bytes FROM rec GROUP BY ALL""",
)
def partition_roundtrip(spark, sf_dir):
    """Write all hours, then two of them anew with other values: these are
    replaced, the third stays."""
    base = run_dir(spark, "hours")
    c = "Station_Data_connect_data"
    used = data.station_history(spark, sf_dir).groupBy("date", "hour", F.col(f"{c}.station_mac")).agg(
        F.sum(F.col(f"{c}.bs").cast("bigint") + F.col(f"{c}.br").cast("bigint")).alias("total_bytes")
    )
    sinks.write_partitions(used, base)
    sinks.write_partitions(used.where("hour <> '12'").withColumn("total_bytes", F.col("total_bytes") + 1), base)
    return reduce(
        DataFrame.unionByName, (tables.read_partitioned(spark, base, date=data.SCORE_DATE, hour=h) for h in ("08", "12", "18"))
    )


@query(
    "lookback_read",
    f"""WITH {S.OWL}, {S.RESTART_DAILY} SELECT sn, CAST(sum(num_total_reboots) AS BIGINT) AS reboots FROM restart_daily
    WHERE day BETWEEN '2024-01-15' AND '2024-01-30' AND num_total_reboots IS NOT NULL GROUP BY sn""",
)
def lookback_read(spark, sf_dir):
    """Daily directories; days outside the table are asked for and skipped."""
    base = run_dir(spark, "daily")
    daily = D.restarts_daily(data.owl_history(spark, sf_dir)).where("num_total_reboots IS NOT NULL")
    sinks.write_partitions(daily, base, by=["day"])
    days = tables.days_back("2024-02-03", 20)
    stored = tables.read_days(spark, base + "/day={}", days)
    return stored.groupBy("sn").agg(F.sum("num_total_reboots").alias("reboots"))


@query(
    "csv_export",
    f"""WITH {S.LI}, {DQ._MODELS} SELECT sn, model_name FROM mods WHERE model_name IN ('MODEL-1', 'MODEL-3')""",
)
def csv_export(spark, sf_dir):
    path = run_dir(spark, "export")
    rows = D.export_rows(D.models(data.device_groups(spark, sf_dir)), ["MODEL-1", "MODEL-3"])
    sinks.export_csv(rows, path)
    return spark.read.schema("sn string, model_name string").option("header", True).csv(path)


@query(
    "volume_gate",
    """SELECT h AS hour, n AS rows_seen, n > (SELECT count(*) // 3 FROM lineitem) AS published FROM (
      SELECT CASE l_returnflag WHEN 'A' THEN '08' WHEN 'N' THEN '12' ELSE '18' END AS h, count(*) AS n
      FROM lineitem GROUP BY 1)""",
)
def volume_gate(spark, sf_dir):
    """Each hour is published only when it holds over a third of the day."""
    base = run_dir(spark, "gated")
    history = data.station_history(spark, sf_dir).select("rowkey", "ts", "hour")
    limit = data.table(spark, sf_dir, "lineitem").count() // 3
    verdicts = []
    for hour in ("08", "12", "18"):
        published, rows = sinks.publish_if_volume(
            history.where(F.col("hour") == hour).drop("hour"), base, data.SCORE_DATE, hour, limit
        )
        if published != (sinks.is_ready(spark, base, data.SCORE_DATE, hour, limit) if published else False):
            raise RuntimeError(f"hour {hour} was published incompletely")
        verdicts.append((hour, rows, published))
    return spark.createDataFrame(verdicts, "hour string, rows_seen bigint, published boolean")


@query(
    "missing_slots",
    """WITH d AS (SELECT strftime(CAST('2024-01-01' AS DATE) + CAST(i AS INTEGER), '%Y%m%d') AS date FROM range(30) t(i)),
    h AS (SELECT lpad(CAST(i AS VARCHAR), 2, '0') AS hour FROM range(24) t(i)),
    w AS (SELECT date, hour FROM d, h WHERE date < '20240130' OR hour < '15'),
    p AS (SELECT DISTINCT strftime(ts, '%Y%m%d') AS date, strftime(ts, '%H') AS hour, event_type FROM events)
    SELECT date, hour, string_agg(name, ',' ORDER BY name) AS missing FROM (
      SELECT w.date, w.hour, name FROM w CROSS JOIN (VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view')) n(name)
      WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.date = w.date AND p.hour = w.hour AND p.event_type = name))
    GROUP BY date, hour""",
)
def missing_slots(spark, sf_dir):
    events = data.table(spark, sf_dir, "events")
    dates = [d.replace("-", "") for d in tables.days_back(data.SCORE_DAY, 30)]
    wanted = gaps.wanted_hours(spark, dates, datetime(2024, 1, 30, 15, 30))
    present = {
        kind: gaps.slots_of(events.where(F.col("event_type") == kind), F.col("ts"))
        for kind in ("click", "error", "purchase", "signup", "view")
    }
    return gaps.missing_slots(wanted, present)


@query(
    "gap_backfill",
    f"""WITH {S.REC} SELECT hour, station_mac, count(*) AS n FROM rec GROUP BY ALL""",
)
def gap_backfill(spark, sf_dir):
    """An output lacking two of three hours is found incomplete and completed."""
    base = run_dir(spark, "backfill")
    history = data.station_history(spark, sf_dir)

    def shared(date, hour):
        return history.where((F.col("date") == date) & (F.col("hour") == hour))

    def count_stations(rows, date, hour):
        counted = rows.groupBy(F.col("Station_Data_connect_data.station_mac").alias("station_mac")).agg(
            F.count(F.lit(1)).alias("n")
        )
        sinks.write_partitions(counted.withColumns({"date": F.lit(date), "hour": F.lit(hour)}), f"{base}/stations")

    count_stations(shared(data.SCORE_DATE, "08"), data.SCORE_DATE, "08")
    missing = gaps.missing_partitions(
        spark, {"stations": f"{base}/stations"}, [data.SCORE_DATE], datetime(2024, 1, 31)
    )
    hours = history.select("date", "hour").distinct()
    gaps.backfill(missing.join(hours, ["date", "hour"], "left_semi"), shared, {"stations": count_stations})
    return tables.read_partitioned(spark, f"{base}/stations").select("hour", "station_mac", "n")


@query("read_through", f"WITH {S.REC}, {S.MOBILITY} SELECT mobility_status, count(*) AS stations FROM mobility GROUP BY 1")
def read_through(spark, sf_dir):
    """The second read finds the stored table and does not compute."""
    path = run_dir(spark, "stationarity")

    def build():
        flat = H.connection_records(data.station_history(spark, sf_dir))
        return mobility(flat, ["sn", "station_mac"], "rssi").drop("n")

    def refuse():
        raise RuntimeError("a stored table was computed again")

    tables.read_or_compute(spark, path, build)
    return tables.read_or_compute(spark, path, refuse).groupBy("mobility_status").agg(F.count(F.lit(1)).alias("stations"))


# ------------------------------------------------------------ lookups and cards


@query(
    "key_lookup",
    f"""WITH {S.REC}, {DQ._RSSI}, {DQ._RSSI_KPI},
    asked AS (SELECT DISTINCT upper(trim(' hm' || lpad(CAST(s_suppkey AS VARCHAR), 8, '0') || ' ')) AS sn FROM supplier
              WHERE s_acctbal > 5000)
    SELECT sn, '2024-01-30' AS target_date, rssi_numeric, "RSSI_category" FROM rssi_kpi JOIN asked USING (sn)""",
)
def key_lookup(spark, sf_dir):
    asked = data.table(spark, sf_dir, "supplier").where("s_acctbal > 5000").select(
        F.concat(F.lit(" hm"), F.lpad(F.col("s_suppkey").cast("string"), 8, "0"), F.lit(" ")).alias("sn"),
        F.lit("why is it slow?").alias("question"), F.lit("").alias("target_date"),
    )
    scores = D.rssi_kpi(D.rssi_stations(data.station_history(spark, sf_dir))).withColumn("target_date", F.lit(data.SCORE_DAY))
    return R.lookup(scores, R.requests(asked, data.SCORE_DAY))


_CARD_LINES = " || chr(10) || ".join(f"'  {c:<38} = ' || coalesce(CAST(\"{c}\" AS VARCHAR), 'N/A')" for c in R.CARD_COLUMNS)
_SNAPSHOT = " || ',' || ".join(f"""'"{k}":"' || coalesce("{c}", 'N/A') || '"'""" for k, c in R.SNAPSHOT_COLUMNS.items())


@query(
    "metric_card",
    f"""WITH homes AS ({DQ._home_sql()}), placed AS (SELECT homes.*, n_name AS state, r_name AS county FROM homes
      LEFT JOIN (supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
      ON sn = 'HM' || lpad(CAST(s_suppkey AS VARCHAR), 8, '0'))
    SELECT sn, model_name, {_CARD_LINES} AS card, '{{' || {_SNAPSHOT} || '}}' AS snapshot FROM placed""",
)
def metric_card(spark, sf_dir):
    return R.metric_card(D.with_location(DQ._daily(spark, sf_dir), DQ._places(spark, sf_dir)))


@query(
    "ticket_pivot",
    "SELECT o_custkey, " + ", ".join(
        f"count(*) FILTER (WHERE o_orderpriority = '{p}') AS {n}"
        for n, p in (("urgent", "1-URGENT"), ("high", "2-HIGH"), ("medium", "3-MEDIUM"), ("unspecified", "4-NOT SPECIFIED"), ("low", "5-LOW"))
    ) + ", count(*) FILTER (WHERE o_orderstatus = 'F') AS finished, count(*) FILTER (WHERE o_orderstatus = 'P') AS pending "
    "FROM orders GROUP BY o_custkey",
)
def ticket_pivot(spark, sf_dir):
    p, s = "o_orderpriority", "o_orderstatus"
    return R.code_counts(
        data.table(spark, sf_dir, "orders"), ["o_custkey"],
        {
            "urgent": (p, "1-URGENT"), "high": (p, "2-HIGH"), "medium": (p, "3-MEDIUM"), "unspecified": (p, "4-NOT SPECIFIED"),
            "low": (p, "5-LOW"), "finished": (s, "F"), "pending": (s, "P"),
        },
    )


@query("distinct_settings", "SELECT DISTINCT c_nationkey::BIGINT AS c_nationkey, c_mktsegment FROM customer WHERE c_acctbal IS NOT NULL")
def distinct_settings(spark, sf_dir):
    return R.distinct_settings(data.table(spark, sf_dir, "customer"), ["c_nationkey", "c_mktsegment"], "c_acctbal")


@query(
    "top_k_per_group",
    """SELECT l_suppkey, l_partkey, n, CAST(rank AS BIGINT) AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_partkey) AS rank FROM (
        SELECT l_suppkey, l_partkey, count(*) AS n FROM lineitem GROUP BY ALL)) WHERE rank <= 5""",
)
def top_k_per_group(spark, sf_dir):
    counted = data.table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.count(F.lit(1)).alias("n"))
    return top_rows(counted, ["l_suppkey"], [F.desc("n"), F.col("l_partkey")], 5)


@query(
    "record_labels",
    f"""WITH {S.REC} SELECT band, rssi, {DQ._signal_case('rssi')} AS label, count(*) AS n FROM rec GROUP BY ALL""",
)
def record_labels(spark, sf_dir):
    records = H.connection_records(data.station_history(spark, sf_dir))
    label = F.lit("No Data")
    for band in P.BANDS:
        label = F.when(P.band_family(F.col("band")) == band, bucketize("rssi", DAILY_RSSI[band])).otherwise(label)
    return records.groupBy("band", "rssi", label.alias("label")).agg(F.count(F.lit(1)).alias("n"))
