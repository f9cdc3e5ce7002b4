"""The driver's tables in the shape of raw telemetry.

``lineitem`` becomes one day of station and device-group records, ``events``
thirty days of router records. Every row of the tables is used. The nested
layout (structs, arrays of structs, JSON text, rates with units) is what the
jobs in ``plans`` read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCORE_DAY = "2024-01-30"
SCORE_DATE = "20240130"
DATE_BEFORE = "20240129"
DAY_MS = 86_400_000
#: Midnight UTC of the score day in epoch milliseconds.
DAY_START_MS = 1706572800000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give every core a share of a table that splits into fewer parts than cores.

    A test table is one file with one row group, so one task. A real table has
    many splits and is left as it is: no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def _lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain columns the nested records below are built from."""
    return spread(table(spark, sf_dir, "lineitem"), "l_orderkey").selectExpr(
        "*",
        "concat('HM', lpad(cast(l_suppkey as string), 8, '0')) as sn",
        "concat('AC', lpad(cast((l_suppkey - l_suppkey % 2) * 6 + l_partkey % 12 as string), 10, '0')) as mac",
        "l_partkey % 12 as slot",
        "case l_returnflag when 'A' then 8 when 'N' then 12 else 18 end as hour_no",
        "(l_orderkey * 7 + l_linenumber * 13 + l_partkey) % 60 * 60 as second_no",
        "cast(floor(l_extendedprice * 100) as bigint) as cents",
    ).selectExpr(
        "*",
        f"{DAY_START_MS} + hour_no * 3600000 + second_no * 1000 as ts",
        "cents * (case when slot = 0 then 40 else 1 end) as bytes",
    )


def station_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested record per station report."""
    return _lineitem(spark, sf_dir).selectExpr(
        "concat(substring(sn, -4, 4), '-', sn, '_', mac) as rowkey",
        "ts",
        "concat('MODEL-', cast(l_suppkey % 4 as string)) as Tplg_Data_model_name",
        """named_struct(
            'station_mac', mac,
            'station_name', case when slot <> 11 then concat('st', cast(l_partkey % 5 as string)) end,
            'connect_type', case when l_linenumber = 7 then 'ETH' when l_linenumber % 3 = 0 then '2.4GI'
                                 when l_linenumber % 3 = 1 then '5GI' else '6GI' end,
            'signal_strength', cast(case when l_linenumber = 7 then null when l_orderkey % 89 = 0 then 0
                else -(38 + (slot * 5) % 48 + (l_partkey * 7 + l_linenumber * 11 + floor(l_quantity))
                       % (case when slot % 3 = 0 then 7 else 30 end)) end as int),
            'snr', cast(case when l_discount > 0.095 then null
                else 20 + floor(l_quantity) % (case when slot % 4 = 0 then 10 else 40 end) end as int),
            'link_rate', case when l_orderkey % 89 = 0 then '0Mbps' when l_orderkey % 83 = 0 then ''
                else concat(cast(floor(l_extendedprice / 160) as string), '.4Mbps') end,
            'tx_link_rate', case when l_orderkey % 83 = 0 then null
                else concat(cast(floor(l_extendedprice / 80) as string), 'Mbps') end,
            'bs', cast(bytes % 1000003 as string),
            'br', cast(bytes - bytes % 1000003 as string),
            'diff_bs', case when l_tax > 0.005 then cents % 1000003 end,
            'diff_br', case when l_tax > 0.005 then cents - cents % 1000003 end,
            'parent_id', concat(case when slot % 4 = 1 then 'EXT' else 'RTR' end, cast(l_suppkey as string)),
            'mode', cast((l_suppkey * 12 + slot) % 30 as int),
            'bw', cast(l_linenumber - 1 as int),
            'airtime_util', cast(l_partkey % 101 as double),
            'channel', cast(1 + l_partkey % 11 as int)) as Station_Data_connect_data""",
        """case when l_tax > 0.035 then named_struct(
            'sta_type', case when l_linenumber % 2 = 0 then '2' else '1' end,
            'action', cast(1 + l_orderkey % 3 as string),
            'intend_band', '5G', 'orig_band', '2.4G', 'target_band', '5G') end as Diag_Result_band_steer""",
        """case when l_discount > 0.075 then named_struct(
            'sta_type', case when l_orderkey % 2 = 0 then '2' else '1' end,
            'action', cast(1 + l_partkey % 3 as string),
            'intend_band', '5G', 'orig_band', '2.4G', 'target_band', '5G') end as Diag_Result_ap_steer""",
        f"'{SCORE_DATE}' as date",
        "lpad(cast(hour_no as string), 2, '0') as hour",
    )


def device_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Router reports: the devices of a home and two radio samples each."""
    return _lineitem(spark, sf_dir).selectExpr(
        "concat(substring(sn, -4, 4), '-', sn) as rowkey",
        "ts",
        "concat('fw', cast(l_linenumber as string)) as Tplg_Data_fw_ver",
        """array(
            named_struct('sn', sn, 'model', concat('MODEL-', cast(l_suppkey % 4 as string)),
                'mac', concat('RTR', cast(l_suppkey as string)), 'parent_mac', cast(null as string),
                'fw', concat('fw', cast(l_linenumber as string))),
            named_struct('sn', concat('EX', substring(sn, 3, 8)), 'model', concat('EXT-', cast(l_suppkey % 3 as string)),
                'mac', concat('EXT', cast(l_suppkey as string)), 'parent_mac', concat('RTR', cast(l_suppkey as string)),
                'fw', concat('ex', cast(l_linenumber as string)))) as Group_Data_sys_info""",
        """array(
            named_struct('ts', ts, '_2_4g', named_struct(
                'enable', case when l_linenumber % 4 = 0 then '0' else '1' end,
                'airtime_util', cast((l_partkey * (1 + l_suppkey % 3)) % 101 as string))),
            named_struct('ts', ts + 1000, '_2_4g', named_struct(
                'enable', '1',
                'airtime_util', case when l_orderkey % 10 = 0 then '' else cast(l_orderkey % 111 as string) end))
            ) as Group_Diag_History_radio_wifi_info""",
        f"'{SCORE_DATE}' as date",
        "lpad(cast(hour_no as string), 2, '0') as hour",
    )


def day_earlier(records: DataFrame) -> DataFrame:
    """The same records, reported a day before."""
    return records.withColumns({"ts": F.col("ts") - DAY_MS, "date": F.lit(DATE_BEFORE)})


def owl_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Router event log: addresses, modem events, restarts, channel changes."""
    return (
        spread(table(spark, sf_dir, "events"), "event_id")
        .selectExpr(
            "*",
            "concat('HM', lpad(cast(user_id as string), 8, '0')) as sn",
            "cast(regexp_extract(props, '([0-9]+)', 1) as bigint) as k",
            "unix_millis(cast(ts as timestamp)) as ms",
        )
        .selectExpr(
            "concat(substring(sn, -4, 4), '-', sn, '_OWL') as rowkey",
            "ms as ts",
            "event_id",
            """case when event_type <> 'view' then
                concat('{"ipv4_ip": "10.0.0.', cast(case when k < 70 then 0 else k % 9 end as string), '"}')
                end as Owl_Data_fwa_cpe_data""",
            "case when event_type = 'error' then named_struct('code', k) end as owl_data_modem_event",
            """case when event_type in ('signup', 'purchase') then named_struct(
                'ts', ms, 'action', '1',
                'reason', case k % 4 when 0 then 'GUI' when 1 then 'APP' when 2 then 'BTN' else 'SYS' end,
                'sn', sn, 'fw', concat('fw', cast(k % 3 as string))) end as Diag_Result_dev_restart""",
            """case when event_type = 'click' then
                named_struct('reason', concat('r', cast(k % 5 as string))) end as owl_data_acs_ch_change""",
        )
    )


#: A band was scanned in records above this tax rate.
HEARD = {1: 0.005, 2: 0.015, 3: 0.025}


def neighbour_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wi-Fi scans: per band an array of scans, each an array of access points."""
    def scans(band: str, step: int) -> str:
        points = ", ".join(f"named_struct('bssid', concat('B', cast((l_orderkey * {step} + {i}) % 37 as string)))" for i in range(2))
        more = f"named_struct('data', array(named_struct('bssid', concat('B', cast(l_partkey % 41 as string)))))"
        return (
            f"case when l_tax > {HEARD[step]} then array(named_struct('data', array({points})), {more}) end "
            f"as wifi_scan_wifi_ap_data_{band}"
        )

    return _lineitem(spark, sf_dir).selectExpr(
        "concat(substring(sn, -4, 4), '-', sn) as rowkey", scans("2_4g", 1), scans("5g", 2), scans("6g", 3),
        "lpad(cast(hour_no as string), 2, '0') as hour",
    )
