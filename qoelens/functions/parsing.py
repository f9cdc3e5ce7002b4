"""Keys, link rates, bands and clocks as found in the raw telemetry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The key patterns of the telemetry row keys.
ROUTER_OF_STATION = r"-(\w+)_"
ROUTER_OF_GROUP = r"-(\w+)"
ROUTER_UPPER = r"-([A-Z0-9]+)_"
ROUTER_STRICT = r"-([^-_]+)"
ROUTER_OF_BYTES = r"-([^-_]+)_"
ROUTER_SERIAL = r"([A-Z]+\d+)"

BANDS = ("2_4G", "5G", "6G")
WIRED = ("ETH", "Ether", "ethernet")


def serial(rowkey: Column, pattern: str = ROUTER_OF_STATION) -> Column:
    return F.regexp_extract(rowkey, pattern, 1)


def rowkey_of(sn: Column) -> Column:
    """``last four of the serial - serial``."""
    return F.concat(F.substring(sn, -4, 4), F.lit("-"), sn)


def event_time(ts_ms: Column) -> Column:
    return F.timestamp_millis(ts_ms)


def day_of(ts_ms: Column, fmt: str = "yyyyMMdd") -> Column:
    return F.date_format(event_time(ts_ms), fmt)


def band_family(connect_type: Column) -> Column:
    """``2.4G...`` -> ``2_4G``, ``5G...`` -> ``5G``, ``6G...`` -> ``6G``, else unchanged."""
    return (
        F.when(connect_type.startswith("2.4G"), "2_4G")
        .when(connect_type.startswith("5G"), "5G")
        .when(connect_type.startswith("6G"), "6G")
        .otherwise(connect_type)
    )


def on_band(connect_type: Column, band: str, value: Column) -> Column:
    """``value`` where the record belongs to ``band``, NULL elsewhere."""
    prefix = "2.4G" if band == "2_4G" else band
    return F.when(connect_type.startswith(prefix), value)


def rate_mbps(text: Column, to: str = "double") -> Column:
    """``"144.4Mbps"`` -> 144.4; blank or broken text -> NULL."""
    return F.regexp_replace(text, "Mbps", "").try_cast(to)


def rate_without_unit(text: Column) -> Column:
    """Whole-number rate left after cutting the four unit letters."""
    return F.substring(text, F.lit(1), F.length(text) - F.lit(4)).try_cast("double").cast("long")


def json_field(text: Column, name: str) -> Column:
    return F.get_json_object(text, f"$.{name}")
