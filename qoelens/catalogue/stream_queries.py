"""Structured Streaming over the ``events`` file."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import telemetry as data
from ..functions import parsing as P
from ..operators.ordered import CHANGED
from ..session import run_dir, shared_dir
from ..streaming import corrections, keyed, sink, stateful, windows
from . import sql as S
from .base import ORACLES, query


def _stream(spark, sf_dir, glob="events.parquet"):
    schema = data.table(spark, sf_dir, "events").schema
    return windows.read_files(spark, sf_dir, schema, glob)


def _name(path):
    return path.rsplit("/", 1)[-1]


def _values():
    return {
        "reports": F.count(F.lit(1)), "errors": F.count_if(F.col("event_type") == "error"),
        "lowest": F.min("value"), "highest": F.max("value"),
    }


def _arrivals(spark: SparkSession, sf_dir: str, folder: str, late: bool) -> Iterator[tuple[int, DataFrame]]:
    """All events, in three arrivals by thirds of their time; each (number, stream of
    the folder) is given once the arrival is there. With ``late``, every seventh event comes one arrival later."""
    events = data.table(spark, sf_dir, "events")
    at = F.unix_millis(F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min(at), F.max(at)).first()
    third = F.floor((at - F.lit(low)) * 3 / F.lit(high - low + 1))
    if late:
        third = F.least(third + F.when(F.col("event_id") % 7 == 0, 1).otherwise(0), F.lit(2))
    for number in range(3):
        events.where(third == number).write.mode("append").parquet(folder)
        yield number, windows.read_files(spark, folder, events.schema)


_SQL_VALUES = """count(*) AS reports, count(*) FILTER (WHERE event_type = 'error') AS errors,
    min(value) AS lowest, max(value) AS highest"""


@query(
    "stream_tumbling",
    f"""SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
    strftime(date_trunc('hour', ts) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end, user_id, {_SQL_VALUES}
    FROM events GROUP BY ALL""",
)
def stream_tumbling(spark, sf_dir):
    path = run_dir(spark, "tumbling")
    hourly = windows.windowed(windows.in_event_time(_stream(spark, sf_dir), "ts"), "ts", ["user_id"], _values())
    sink.drain(hourly, _name(path), sink.batch_writer(path))
    return sink.latest(spark, path, ["window_start", "window_end", "user_id"])


@query(
    "stream_sliding",
    f"""WITH e AS (SELECT *, time_bucket(INTERVAL 30 MINUTE, ts) AS half FROM events),
    w AS (SELECT *, half AS ws FROM e UNION ALL SELECT *, half - INTERVAL 30 MINUTE FROM e)
    SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start,
      strftime(ws + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end, event_type, {_SQL_VALUES} FROM w GROUP BY ALL""",
)
def stream_sliding(spark, sf_dir):
    path = run_dir(spark, "sliding")
    stream = windows.in_event_time(_stream(spark, sf_dir), "ts")
    sliding = windows.windowed(stream, "ts", ["event_type"], _values(), "1 hour", "30 minutes")
    sink.drain(sliding, _name(path), sink.batch_writer(path))
    return sink.latest(spark, path, ["window_start", "window_end", "event_type"])


@query(
    "stream_session",
    f"""WITH g AS (SELECT *, CASE WHEN prev IS NULL OR ts >= prev + INTERVAL 2 HOUR THEN 1 ELSE 0 END AS opens FROM (
      SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events)),
    s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS no FROM g)
    SELECT strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS window_start,
      strftime(max(ts) + INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end, user_id, {_SQL_VALUES}
    FROM s GROUP BY user_id, no""",
)
def stream_session(spark, sf_dir):
    path = run_dir(spark, "sessions")
    stream = windows.in_event_time(_stream(spark, sf_dir), "ts")
    active = windows.sessions(stream, "ts", ["user_id"], _values(), "2 hours")
    sink.drain(active, _name(path), sink.batch_writer(path), mode="complete")
    return sink.last_batch(spark, path)


def _addresses(events: DataFrame) -> DataFrame:
    """The address each report carries, as ``owl_history`` has it."""
    k = P.json_field(F.col("props"), "k").cast("bigint")
    return events.where("event_type <> 'view'").select(
        F.concat(F.lit("HM"), F.lpad(F.col("user_id").cast("string"), 8, "0")).alias("sn"), "ts",
        F.col("ts").cast("date").alias("day"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"), "event_id",
        F.concat(F.lit("10.0.0."), F.when(k < 70, F.lit(0)).otherwise(k % 9).cast("string")).alias("ip"),
    )


@query("stream_lag", f"WITH {S.OWL}, {S.IP_DAILY} SELECT * FROM ip_daily")
def stream_lag(spark, sf_dir):
    path = run_dir(spark, "lag")
    reports = _addresses(_stream(spark, sf_dir))
    counter = stateful.StepCounter(path, ["sn"], ["ms", "event_id"], "ip", CHANGED, ["day"], "no_ip_changes")
    sink.drain(reports, _name(path), counter, mode="append")
    return counter.totals(spark)


@query("stream_late_repair", ORACLES["stream_tumbling"])
def stream_late_repair(spark, sf_dir):
    """Two of three arrivals bring late rows; their windows are scored again from the stored rows."""
    path = run_dir(spark, "late-repair")
    keys = ["window_start", "window_end", "user_id"]
    hour = F.window("ts", "1 hour")
    log = corrections.CorrectionLog(
        f"{path}/log", "ts", timedelta(minutes=30), keys,
        lambda late: late.withColumn("w", hour).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "user_id", "day"),
        lambda rows: windows.windowed(rows, "ts", ["user_id"], _values()),
    )
    for _, stream in _arrivals(spark, sf_dir, f"{path}/in", late=True):
        timed = windows.in_event_time(stream, "ts")
        sink.drain(windows.windowed(timed, "ts", ["user_id"], _values()), _name(path), sink.batch_writer(f"{path}/out"))
        rows = stream.withColumn("ts", F.col("ts").cast("timestamp"))
        sink.drain(rows, f"{_name(path)}-log", log, mode="append")
        log.repair(spark)
    return log.merged(sink.latest(spark, f"{path}/out", keys))


@query("stream_keyed_steps", ORACLES["stream_lag"])
def stream_keyed_steps(spark, sf_dir):
    """Each arrival is a run of its own, which goes on from the state the last one left."""
    path = run_dir(spark, "keyed")
    for _, stream in _arrivals(spark, sf_dir, f"{path}/in", late=False):
        timed = _addresses(windows.in_event_time(stream, "ts"))
        counts = keyed.count_steps_keyed(timed, ["sn"], ["ms", "event_id"], "ip", CHANGED, ["day"], "no_ip_changes", 60 * 86_400_000)
        sink.drain(counts, _name(path), sink.batch_writer(f"{path}/out"), mode="append")
    stored = spark.read.parquet(f"{path}/out")
    return stored.groupBy("sn", "day").agg(F.sum("no_ip_changes").alias("no_ip_changes"))


@query("stream_session_append", ORACLES["stream_session"])
def stream_session_append(spark, sf_dir):
    """Closed sessions leave the state as they are written; the open ones are read from it."""
    path = run_dir(spark, "sessions-append")
    for _, stream in _arrivals(spark, sf_dir, f"{path}/in", late=False):
        active = windows.sessions(windows.in_event_time(stream, "ts"), "ts", ["user_id"], _values(), "2 hours")
        sink.drain(active, _name(path), sink.batch_writer(f"{path}/out"), mode="append")
    closed = spark.read.parquet(f"{path}/out").drop("batch")
    progress = f"{shared_dir(spark)}/progress/{_name(path)}"
    return closed.unionByName(windows.open_sessions(spark, progress, ["user_id"], list(_values())))


#: How late each kind of report may come; errors lag.
_DELAYS = {"click": "30 minutes", "error": "6 hours", "purchase": "30 minutes", "signup": "45 minutes", "view": "30 minutes"}
_SLOT_SQL = f"""WITH mark AS (SELECT min(t) AS m FROM (VALUES {", ".join(f"('{k}', INTERVAL '{d}')" for k, d in _DELAYS.items())}) d(kind, late)
      JOIN (SELECT event_type AS kind, max(ts) AS newest FROM events GROUP BY event_type) e ON e.kind = d.kind,
      LATERAL (SELECT newest - late AS t))
    SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
      strftime(date_trunc('hour', ts) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end,
      {", ".join(f"count(*) FILTER (WHERE event_type = '{k}') AS n_{k}" for k in _DELAYS)}
    FROM events, mark WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= mark.m GROUP BY ALL"""


@query("common_slots", _SLOT_SQL)
def common_slots(spark, sf_dir):
    events = data.table(spark, sf_dir, "events")
    return windows.passed_slots({kind: events.where(F.col("event_type") == kind) for kind in _DELAYS}, "ts", _DELAYS)


@query("stream_common_slots", _SLOT_SQL)
def stream_common_slots(spark, sf_dir):
    """Five sources in one query; an hour comes out when the slowest of their watermarks has passed it."""
    path = run_dir(spark, "slots")
    for _, stream in _arrivals(spark, sf_dir, f"{path}/in", late=False):
        sources = {kind: stream.where(F.col("event_type") == kind) for kind in _DELAYS}
        sink.drain(windows.common_slots(sources, "ts", _DELAYS), _name(path), sink.batch_writer(f"{path}/out"), mode="append")
    return spark.read.parquet(f"{path}/out").drop("batch")


@query(
    "source_completeness",
    """SELECT strftime(least(c, e, p, s, v), '%Y-%m-%d %H:%M:%S') AS complete_until,
      strftime(c, '%Y-%m-%d %H:%M:%S') AS newest_click, strftime(e, '%Y-%m-%d %H:%M:%S') AS newest_error,
      strftime(p, '%Y-%m-%d %H:%M:%S') AS newest_purchase,
      strftime(s, '%Y-%m-%d %H:%M:%S') AS newest_signup, strftime(v, '%Y-%m-%d %H:%M:%S') AS newest_view
    FROM (SELECT max(ts) FILTER (WHERE event_type = 'click') AS c, max(ts) FILTER (WHERE event_type = 'error') AS e,
      max(ts) FILTER (WHERE event_type = 'purchase') AS p, max(ts) FILTER (WHERE event_type = 'signup') AS s,
      max(ts) FILTER (WHERE event_type = 'view') AS v FROM events)""",
)
def source_completeness(spark, sf_dir):
    events = data.table(spark, sf_dir, "events")
    return windows.complete_until(
        {kind: events.where(F.col("event_type") == kind) for kind in ("click", "error", "purchase", "signup", "view")}, "ts"
    )


@query(
    "trailing_hour",
    f"""SELECT event_type, {_SQL_VALUES} FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 24 HOUR
    GROUP BY event_type""",
)
def trailing_hour(spark, sf_dir):
    recent = windows.trailing(data.table(spark, sf_dir, "events"), "ts", "24 HOURS")
    return recent.groupBy("event_type").agg(*(c.alias(n) for n, c in _values().items()))
