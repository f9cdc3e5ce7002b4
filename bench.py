"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
the data and the cores. Each query runs once to warm up and is then timed over
its full result (noop sink).
"""

from __future__ import annotations

import json
import os
import sys
import time

from qoelens.catalogue import QUERIES
from qoelens.session import build_session

HEADLINE = (
    "station_connection", "station_score", "station_score_combined", "home_score", "heavy_hitter_blend",
    "data_consumption", "airtime_reliability", "daily_home_score", "daily_station_score", "rssi_daily", "phyrate_daily",
    "steering", "ip_changes", "sudden_drop", "stationarity", "outlier_filter", "restart_kpi", "feature_table",
    "neighbor_distinct", "poor_share_score", "consumption_report", "replace_rows", "flatten_station", "stream_sliding",
    "stream_lag", "chunk_documents", "dense_topk", "bm25_topk",
)


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"}
    )
    seconds = {}
    for name in names:
        run(spark, name, sf_dir)
        seconds[name] = round(run(spark, name, sf_dir), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
