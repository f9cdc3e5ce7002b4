"""SQL fragments the comparison queries share: flat telemetry as CTEs."""

LI = """
li AS (
  SELECT *, 'HM' || lpad(CAST(l_suppkey AS VARCHAR), 8, '0') AS sn,
    'AC' || lpad(CAST((l_suppkey - l_suppkey % 2) * 6 + l_partkey % 12 AS VARCHAR), 10, '0') AS mac,
    l_partkey % 12 AS slot,
    CASE l_returnflag WHEN 'A' THEN 8 WHEN 'N' THEN 12 ELSE 18 END AS hour_no,
    (l_orderkey * 7 + l_linenumber * 13 + l_partkey) % 60 * 60 AS second_no,
    CAST(floor(l_extendedprice * 100) AS BIGINT) AS cents
  FROM lineitem)"""

REC = LI + """,
rec AS (
  SELECT sn, right(sn, 4) || '-' || sn || '_' || mac AS rowkey, mac AS station_mac,
    CASE WHEN slot <> 11 THEN 'st' || CAST(l_partkey % 5 AS VARCHAR) END AS station_name,
    CASE WHEN l_linenumber = 7 THEN 'ETH' WHEN l_linenumber % 3 = 0 THEN '2.4GI'
         WHEN l_linenumber % 3 = 1 THEN '5GI' ELSE '6GI' END AS band,
    CASE WHEN l_linenumber = 7 THEN NULL WHEN l_orderkey % 89 = 0 THEN 0
         ELSE -(38 + (slot * 5) % 48 + (l_partkey * 7 + l_linenumber * 11 + CAST(floor(l_quantity) AS BIGINT))
                % (CASE WHEN slot % 3 = 0 THEN 7 ELSE 30 END)) END AS rssi,
    CASE WHEN l_discount > 0.095 THEN NULL
         ELSE 20 + CAST(floor(l_quantity) AS BIGINT) % (CASE WHEN slot % 4 = 0 THEN 10 ELSE 40 END) END AS snr,
    CASE WHEN l_orderkey % 89 = 0 THEN 0 WHEN l_orderkey % 83 = 0 THEN NULL
         ELSE CAST(floor(l_extendedprice / 160) AS BIGINT) END AS phy_rate,
    CASE WHEN l_orderkey % 83 = 0 THEN NULL ELSE CAST(floor(l_extendedprice / 80) AS BIGINT) END AS tx_phy_rate,
    (l_suppkey * 12 + slot) % 30 AS mode,
    'MODEL-' || CAST(l_suppkey % 4 AS VARCHAR) AS model,
    '20240130' AS date, lpad(CAST(hour_no AS VARCHAR), 2, '0') AS hour,
    hour_no * 3600 + second_no AS second_of_day,
    cents * (CASE WHEN slot = 0 THEN 40 ELSE 1 END) AS bytes,
    CASE WHEN l_tax > 0.005 THEN cents % 1000003 END AS sent,
    CASE WHEN l_tax > 0.005 THEN cents - cents % 1000003 END AS received,
    (CASE WHEN slot % 4 = 1 THEN 'EXT' ELSE 'RTR' END) || CAST(l_suppkey AS VARCHAR) AS parent_id,
    l_linenumber - 1 AS bw, l_partkey % 101 AS airtime_util, 1 + l_partkey % 11 AS channel,
    CASE WHEN l_tax > 0.035 THEN CASE WHEN l_linenumber % 2 = 0 THEN '2' ELSE '1' END END AS band_station,
    CASE WHEN l_tax > 0.035 THEN CAST(1 + l_orderkey % 3 AS VARCHAR) END AS band_action,
    CASE WHEN l_discount > 0.075 THEN CASE WHEN l_orderkey % 2 = 0 THEN '2' ELSE '1' END END AS ap_station,
    CASE WHEN l_discount > 0.075 THEN CAST(1 + l_partkey % 3 AS VARCHAR) END AS ap_action
  FROM li)"""

MOBILITY = """
bounds AS (
  SELECT sn, station_mac, max(rssi) AS top, quantile_disc(rssi, [0.03, 0.1, 0.5, 0.9]) AS p
  FROM rec WHERE rssi IS NOT NULL GROUP BY sn, station_mac),
mobility AS (
  SELECT sn, station_mac, CASE WHEN p[4] - p[3] <= 5 THEN 'Stationary' ELSE 'Non-stationary' END AS mobility_status
  FROM bounds WHERE top > least(p[2] - 2 * (p[4] - p[2]), p[1]))"""

ENRICHED = REC + "," + MOBILITY + """,
sig AS (SELECT date, hour, station_mac, quantile_disc(rssi, 0.5) AS p50_rssi, quantile_disc(rssi, 0.9) AS p90_rssi
        FROM rec GROUP BY date, hour, station_mac),
steers AS (SELECT rowkey, date, hour, count(*) AS son FROM rec
           WHERE (band_station IS NOT NULL OR ap_station IS NOT NULL) AND band_action = '1' GROUP BY rowkey, date, hour),
conn AS (
  SELECT r.*, g.p50_rssi, g.p90_rssi, s.son, m.mobility_status
  FROM rec r JOIN sig g ON r.date = g.date AND r.hour = g.hour AND r.station_mac = g.station_mac
  LEFT JOIN steers s ON r.rowkey = s.rowkey AND r.date = s.date AND r.hour = s.hour
  LEFT JOIN mobility m ON r.sn = m.sn AND r.station_mac = m.station_mac)"""

OWL = """
owl AS (
  SELECT right(sn, 4) || '-' || sn || '_OWL' AS rowkey, * FROM (
    SELECT 'HM' || lpad(CAST(user_id AS VARCHAR), 8, '0') AS sn, epoch_ms(ts) AS ts, event_id, event_type,
      CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k
    FROM events)),
owl2 AS (
  SELECT *, CASE WHEN event_type <> 'view' THEN '10.0.0.' || CAST(CASE WHEN k < 70 THEN 0 ELSE k % 9 END AS VARCHAR) END AS ip,
    event_type = 'error' AS crash, event_type IN ('signup', 'purchase') AS reboot,
    CASE k % 4 WHEN 0 THEN 'GUI' WHEN 1 THEN 'APP' WHEN 2 THEN 'BTN' ELSE 'SYS' END AS reason
  FROM owl)"""

IP_DAILY = """
ip_daily AS (
  SELECT sn, day, CAST(sum(CASE WHEN prev IS NOT NULL AND prev <> ip THEN 1 ELSE 0 END) AS BIGINT) AS no_ip_changes
  FROM (SELECT *, lag(ip) OVER (PARTITION BY sn ORDER BY ts, event_id) AS prev FROM owl2 WHERE ip IS NOT NULL)
  GROUP BY sn, day)"""

RESTART_DAILY = """
restart_daily AS (
  SELECT sn, day, nullif(count(*) FILTER (WHERE crash), 0) AS num_mdm_crashes,
    nullif(count(*) FILTER (WHERE reboot AND reason IN ('GUI', 'APP', 'BTN')), 0) AS num_user_reboots,
    nullif(count(*) FILTER (WHERE reboot), 0) AS num_total_reboots
  FROM owl2 WHERE crash OR reboot GROUP BY sn, day)"""

RADIO = """
radio AS (
  SELECT sn, hour_no, CASE WHEN l_linenumber % 4 = 0 THEN '0' ELSE '1' END AS enable,
    (l_partkey * (1 + l_suppkey % 3)) % 101 AS util FROM li
  UNION ALL
  SELECT sn, hour_no, '1', CASE WHEN l_orderkey % 10 = 0 THEN NULL ELSE l_orderkey % 111 END FROM li)"""


def first_match(value: str, *bands: tuple[object, str], other: str = "NULL") -> str:
    """CASE with one branch per (outcome, condition); ``x`` stands for the value."""
    branches = " ".join(f"WHEN {cond.replace('x', value)} THEN {_lit(out)}" for out, cond in bands)
    return f"CASE {branches} ELSE {other} END"


def _lit(v: object) -> str:
    return f"'{v}'" if isinstance(v, str) else str(v)


def half_up(expr: str, digits: int) -> str:
    """Round half up on the decimal reading, as a double."""
    return f"CAST(round(CAST(({expr}) AS DECIMAL(28, {digits + 7})), {digits}) AS DOUBLE)"
