"""Refinements described in the requirements, over telemetry and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import telemetry as data
from ..plans import daily as D
from ..plans import extensions as E
from ..operators.skew import join_back, materialise
from ..plans import features as X
from ..plans import hourly as H
from ..plans import sketches as K
from ..session import run_dir
from . import daily_queries as DQ
from . import sql as S
from . import table_queries as TQ
from .base import query


def _records(spark, sf_dir):
    return H.connection_records(data.station_history(spark, sf_dir))


def _events(spark, sf_dir):
    return data.table(spark, sf_dir, "events")


def _daily(spark, sf_dir):
    return E.daily_values(_events(spark, sf_dir), ["user_id"], F.col("ts"), F.round(F.sum("value"), 4))


_DAILY = """
daily AS (SELECT user_id, date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS day_no, round(sum(value), 4) AS value
  FROM events GROUP BY ALL)"""


@query(
    "segment_thresholds",
    f"""WITH {S.REC}, own AS (SELECT model, quantile_disc(tx_phy_rate, 0.1) AS lim FROM rec WHERE tx_phy_rate IS NOT NULL GROUP BY model),
    g AS (SELECT quantile_disc(tx_phy_rate, 0.1) AS everyone FROM rec)
    SELECT model, count(*) AS records, lim AS segment_limit, CAST(everyone AS DOUBLE) AS global_limit,
      count(*) FILTER (WHERE tx_phy_rate < lim) AS below_segment, count(*) FILTER (WHERE tx_phy_rate < everyone) AS below_global
    FROM rec JOIN own USING (model), g WHERE tx_phy_rate IS NOT NULL GROUP BY ALL""",
)
def segment_thresholds(spark, sf_dir):
    return E.segment_thresholds(_records(spark, sf_dir), "model", "tx_phy_rate")


@query(
    "novelty",
    f"""WITH {_DAILY}, b AS (SELECT *, avg(value) OVER w AS baseline, stddev_samp(value) OVER w AS spread FROM daily
      WINDOW w AS (PARTITION BY user_id ORDER BY day_no RANGE BETWEEN 7 PRECEDING AND 1 PRECEDING))
    SELECT user_id, day_no, value, round(baseline, 4) AS baseline, round(spread, 4) AS spread,
      coalesce(abs(value - baseline) > 2 * spread, FALSE) AS novel FROM b""",
)
def novelty(spark, sf_dir):
    out = E.novelty(_daily(spark, sf_dir), ["user_id"])
    return out.withColumns({c: F.round(c, 4) for c in ("baseline", "spread")})


@query(
    "rolling_median",
    f"""WITH {_DAILY} SELECT *, round(quantile_cont(value, 0.5) OVER (PARTITION BY user_id ORDER BY day_no
      RANGE BETWEEN 6 PRECEDING AND CURRENT ROW), 5) AS rolling_median FROM daily""",
)
def rolling_median(spark, sf_dir):
    return E.rolling_median(_daily(spark, sf_dir), ["user_id"]).withColumn("rolling_median", F.round("rolling_median", 5))


@query(
    "trimmed_mean",
    f"""WITH {S.REC}, p AS (SELECT sn, quantile_disc(rssi, [0.1, 0.9]) AS q FROM rec WHERE rssi IS NOT NULL GROUP BY sn)
    SELECT sn, round(avg(rssi), 6) AS trimmed_mean, count(*) AS kept FROM rec JOIN p USING (sn)
    WHERE rssi BETWEEN q[1] AND q[2] GROUP BY sn""",
)
def trimmed_mean(spark, sf_dir):
    out = E.trimmed_mean(_records(spark, sf_dir), ["sn"], "rssi")
    return out.withColumn("trimmed_mean", F.round("trimmed_mean", 6))


def _restarts(spark, sf_dir):
    return D.restarts_daily(data.owl_history(spark, sf_dir))


@query(
    "rate_per_active_day",
    f"""WITH {S.OWL}, {S.RESTART_DAILY}, act AS (SELECT sn, count(DISTINCT day) AS active_days FROM owl GROUP BY sn),
    ev AS (SELECT sn, CAST(sum(coalesce(num_total_reboots, 0)) AS BIGINT) AS events FROM restart_daily GROUP BY sn)
    SELECT sn, coalesce(events, 0) AS events, active_days, round(coalesce(events, 0) / active_days, 6) AS rate
    FROM act LEFT JOIN ev USING (sn)""",
)
def rate_per_active_day(spark, sf_dir):
    reports = D.with_router_keys(data.owl_history(spark, sf_dir)).select("sn", "day")
    out = E.rate_per_active_day(_restarts(spark, sf_dir), reports, ["sn"], "num_total_reboots")
    return out.withColumn("rate", F.round("rate", 6))


@query(
    "alerts",
    f"""WITH {S.OWL}, {S.RESTART_DAILY} SELECT sn, min(day) AS alert_day FROM (
      SELECT sn, day, sum(coalesce(num_total_reboots, 0)) OVER (PARTITION BY sn ORDER BY day) AS total FROM restart_daily)
    WHERE total > 10 GROUP BY sn""",
)
def alerts(spark, sf_dir):
    return E.cumulative_alerts(_restarts(spark, sf_dir), ["sn"], "num_total_reboots", 10)


@query(
    "segment_alerts",
    f"""WITH {S.REC} SELECT model, hour, count(*) AS members, count(*) FILTER (WHERE rssi < -75) AS flagged,
    round(count(*) FILTER (WHERE rssi < -75) / count(*), 6) AS share FROM rec GROUP BY ALL
    HAVING count(*) FILTER (WHERE rssi < -75) / count(*) > 0.15""",
)
def segment_alerts(spark, sf_dir):
    out = E.segment_alerts(_records(spark, sf_dir), ["model", "hour"], F.col("rssi") < -75, 0.15)
    return out.withColumn("share", F.round("share", 6))


@query(
    "precision_at_top_k",
    """WITH s AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, user_id, round(sum(value), 4) AS score FROM events GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY score, user_id) AS rank FROM s),
    k AS (SELECT DISTINCT c_custkey AS user_id, 1 AS hit FROM customer WHERE c_acctbal < 3000)
    SELECT day, count(*) AS listed, count(hit) AS confirmed, round(avg(coalesce(hit, 0)), 6) AS precision
    FROM r LEFT JOIN k USING (user_id) WHERE rank <= 20 GROUP BY day""",
)
def precision_at_top_k(spark, sf_dir):
    scores = _events(spark, sf_dir).groupBy(F.to_date("ts").cast("string").alias("day"), "user_id").agg(
        F.round(F.sum("value"), 4).alias("score")
    )
    confirmed = data.table(spark, sf_dir, "customer").where("c_acctbal < 3000").select(F.col("c_custkey").alias("user_id"))
    out = E.precision_of_worst(scores, confirmed, ["day"], "user_id")
    return out.withColumn("precision", F.round("precision", 6))


_CORR = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "corr_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) + 0.0 AS corr FROM lineitem"
        for i, a in enumerate(_CORR) for b in _CORR[i:]
    ),
)
def corr_matrix(spark, sf_dir):
    return E.correlations(data.table(spark, sf_dir, "lineitem"), _CORR).withColumn("corr", F.round("corr", 6) + 0.0)


def _pca_sql():
    """Roots of the characteristic polynomial of the 4 x 4 correlation matrix: the two
    largest by Newton's method from above, each divided out, then a quadratic."""
    pairs = [(i, j) for i in range(4) for j in range(i + 1, 4)]
    r = {(i, j): f"r{i}{j}" for i, j in pairs} | {(j, i): f"r{i}{j}" for i, j in pairs}
    squares = " + ".join(f"{r[p]} * {r[p]}" for p in pairs)
    triples = [(i, j, k) for i in range(4) for j in range(i + 1, 4) for k in range(j + 1, 4)]
    loops = " + ".join(f"{r[i, j]} * {r[j, k]} * {r[i, k]}" for i, j, k in triples)
    apart = " + ".join(f"({r[0, i]} * {r[j, k]}) ** 2" for i, j, k in ((1, 2, 3), (2, 1, 3), (3, 1, 2)))
    rounds = " + ".join(f"{r[0, i]} * {r[i, j]} * {r[j, k]} * {r[k, 0]}" for i, j, k in ((1, 2, 3), (1, 3, 2), (2, 1, 3)))
    corr = ", ".join(f"corr({_CORR[i]}, {_CORR[j]}) AS {r[i, j]}" for i, j in pairs)
    return f"""WITH RECURSIVE m AS (SELECT {corr} FROM lineitem),
    e AS (SELECT 6 - ({squares}) AS e2, 4 + 2 * ({loops}) - 2 * ({squares}) AS e3,
      1 - ({squares}) + 2 * ({loops}) + {apart} - 2 * ({rounds}) AS e4 FROM m),
    n1 AS (SELECT 0 AS step, 4.0::DOUBLE AS x, e2, e3, e4 FROM e UNION ALL
      SELECT step + 1, x - coalesce(((((x - 4) * x + e2) * x - e3) * x + e4) / nullif(((4 * x - 12) * x + 2 * e2) * x - e3, 0), 0), e2, e3, e4
      FROM n1 WHERE step < 100),
    cubic AS (SELECT x AS one, x - 4 AS b2, (x - 4) * x + e2 AS b1, ((x - 4) * x + e2) * x - e3 AS b0 FROM n1 WHERE step = 100),
    n2 AS (SELECT 0 AS step, one AS x, one, b2, b1, b0 FROM cubic UNION ALL
      SELECT step + 1, x - coalesce((((x + b2) * x + b1) * x + b0) / nullif((3 * x + 2 * b2) * x + b1, 0), 0), one, b2, b1, b0
      FROM n2 WHERE step < 100),
    roots AS (SELECT one, x AS two, -(x + b2) / 2 + sqrt(greatest(((x + b2) / 2) ** 2 - ((x + b2) * x + b1), 0)) AS three FROM n2 WHERE step = 100)
    SELECT 1::BIGINT AS component, round(one / 4, 6) AS share FROM roots UNION ALL SELECT 2, round(two / 4, 6) FROM roots
    UNION ALL SELECT 3, round(three / 4, 6) FROM roots"""


@query("pca_variance", _pca_sql())
def pca_variance(spark, sf_dir):
    out = E.explained_variance(data.table(spark, sf_dir, "lineitem").select(*_CORR), _CORR, 3)
    return out.withColumn("share", F.round("share", 6))


@query(
    "reboot_aware_ip",
    f"""WITH {S.OWL}, {S.IP_DAILY}, {S.RESTART_DAILY}, {DQ._IP_KPI}, {DQ._RESTART_KPI}
    SELECT sn, no_ip_changes, coalesce(total_reboots_count, 0) > 0 AS rebooted,
      CASE WHEN coalesce(total_reboots_count, 0) > 0 THEN
        CASE WHEN no_ip_changes > 16 THEN 'Poor' WHEN no_ip_changes >= 7 THEN 'Fair' WHEN no_ip_changes >= 1 THEN 'Good' ELSE 'Excellent' END
      ELSE ip_change_category END AS ip_change_category
    FROM ip_kpi LEFT JOIN restart_kpi USING (sn)""",
)
def reboot_aware_ip(spark, sf_dir):
    owl = data.owl_history(spark, sf_dir)
    ip = D.ip_change_kpi(D.ip_changes_daily(owl, ["event_id"]), data.SCORE_DAY)
    return E.reboot_aware_ip(ip, D.restart_kpi(D.restarts_daily(owl), data.SCORE_DAY))


@query(
    "code_share",
    f"""WITH {S.OWL} SELECT reason AS code, count(*) AS n,
    round(count(*) / (SELECT count(*) FROM owl2 WHERE reboot), 6) AS share FROM owl2 WHERE reboot GROUP BY reason""",
)
def code_share(spark, sf_dir):
    out = E.code_share(data.owl_history(spark, sf_dir), F.col("Diag_Result_dev_restart.reason"))
    return out.withColumn("share", F.round("share", 6))


@query(
    "records_per_minute",
    "SELECT strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS slot, count(*) AS records FROM events GROUP BY 1",
)
def records_per_minute(spark, sf_dir):
    return E.ingest_profile(_events(spark, sf_dir), F.col("ts"))


@query(
    "uptime_rates",
    f"""WITH {S.OWL}, {S.IP_DAILY}, {S.RESTART_DAILY},
    span AS (SELECT 'HM' || lpad(CAST(user_id AS VARCHAR), 8, '0') AS sn, CAST(ts AS DATE) AS day, event_id,
      CAST(epoch_ms(date_trunc('second', ts)) / 1000 AS BIGINT) AS lo FROM events),
    seen AS (SELECT sn, day, lo, lo + 21600 AS hi, max(lo + 21600) OVER (
      PARTITION BY sn ORDER BY lo, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM span),
    up AS (SELECT sn, CAST(sum(greatest(hi - greatest(lo, coalesce(reached, lo)), 0)) AS BIGINT) AS uptime, count(DISTINCT day) AS active_days
      FROM seen GROUP BY sn),
    re AS (SELECT sn, CAST(sum(coalesce(num_total_reboots, 0)) AS BIGINT) AS reboots FROM restart_daily GROUP BY sn),
    ip AS (SELECT sn, CAST(sum(no_ip_changes) AS BIGINT) AS ip_changes FROM ip_daily GROUP BY sn)
    SELECT up.sn, uptime AS uptime_seconds, coalesce(reboots, 0) AS reboots,
      round(CAST(coalesce(reboots, 0) * 86400 AS DOUBLE) / uptime, 6) AS reboots_per_day_up, coalesce(ip_changes, 0) AS ip_changes, active_days,
      round(coalesce(ip_changes, 0) / active_days, 6) AS ip_changes_per_active_day
    FROM up LEFT JOIN re ON re.sn = up.sn LEFT JOIN ip ON ip.sn = up.sn""",
)
def uptime_rates(spark, sf_dir):
    owl = data.owl_history(spark, sf_dir)
    reports = D.with_router_keys(owl).select("sn", "day", "ts")
    out = E.rates_per_uptime(reports, D.restarts_daily(owl), D.ip_changes_daily(owl, ["event_id"]))
    return out.withColumns({c: F.round(c, 6) for c in ("reboots_per_day_up", "ip_changes_per_active_day")})


_SHARES = {"p10": 0.1, "p50": 0.5, "p90": 0.9}


@query(
    "sketch_percentiles",
    f"""SELECT user_id, count(value) AS n, {", ".join(f"true AS {p}_within" for p in _SHARES)} FROM events
    GROUP BY user_id HAVING count(value) > 0""",
)
def sketch_percentiles(spark, sf_dir):
    """Thirty days of a measure from stored daily sketches, each estimate held against its exact rank."""
    events = _events(spark, sf_dir).withColumn("day", F.to_date("ts"))
    folder = run_dir(spark, "quantile-states")
    K.quantile_states(events, ["user_id"], "day", "value").write.partitionBy("day").parquet(folder)
    found = K.quantiles(spark.read.parquet(folder), ["user_id"], _SHARES)
    ranked = join_back(events.where("value is not null").select("user_id", "value"), found, ["user_id"], size="n")
    exact = ranked.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"),
        *(F.count_if(F.col("value") < F.col(p)).alias(f"_{p}_below") for p in _SHARES),
        *(F.count_if(F.col("value") <= F.col(p)).alias(f"_{p}_upto") for p in _SHARES),
    )
    slack = F.lit(K.RANK_ERROR) + 1 / F.col("n")
    within = [
        ((F.col(f"_{p}_below") / F.col("n") <= share + slack) & (F.col(f"_{p}_upto") / F.col("n") >= share - slack)).alias(f"{p}_within")
        for p, share in _SHARES.items()
    ]
    return exact.select("user_id", "n", *within)


@query(
    "sketch_neighbours",
    f"""WITH {S.LI}, scans AS ({TQ._scan_sql()}) SELECT right(sn, 4) || '-' || sn AS rowkey, band, count(DISTINCT b) AS points,
    true AS within FROM scans GROUP BY ALL""",
)
def sketch_neighbours(spark, sf_dir):
    """Access points of a router from stored hourly states, held against the exact count.

    The scans are read once. A state is the same whether a point comes once or often,
    so states and exact counts are taken from each hour's points without repeats.
    """
    points = X.by_band(materialise(X.heard_once(data.neighbour_scans(spark, sf_dir), "hour"), "hourly-points"))
    folder = run_dir(spark, "distinct-states")
    K.distinct_states(points, ["rowkey", "band"], "hour", "bssid").write.partitionBy("hour").parquet(folder)
    found = K.distinct_counts(spark.read.parquet(folder), ["rowkey", "band"])
    exact = points.where("bssid is not null").distinct().groupBy("rowkey", "band").agg(F.countDistinct("bssid").alias("points"))
    within = F.abs(F.col("distinct") - F.col("points")) <= F.greatest(F.lit(1.0), F.col("points") * K.DISTINCT_ERROR)
    return exact.join(found, ["rowkey", "band"]).select("rowkey", "band", "points", within.alias("within"))
