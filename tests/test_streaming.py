"""Streams in several micro-batches give the batch answer."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qoelens.operators.ordered import CHANGED, count_steps
from qoelens.session import shared_dir
from qoelens.streaming import corrections, keyed, sink, stateful, windows

from .conftest import rows_of

SCHEMA = "k string, t long, id long, v string, at timestamp"


def write_files(spark, folder, parts):
    for i, rows in enumerate(parts):
        df = spark.createDataFrame(rows, "k string, t long, id long, v string").withColumn("at", F.timestamp_millis("t"))
        df.coalesce(1).write.parquet(f"{folder}/part{i}")


@pytest.fixture
def reports(spark, tmp_path):
    rng = random.Random(3)
    rows = [(rng.choice(["hot", "hot", "a", "b"]), t * 60_000, i, rng.choice("xxy")) for i, t in enumerate(sorted(rng.choices(range(600), k=400)))]
    folder = str(tmp_path / "in")
    write_files(spark, folder, [rows[:150], rows[150:300], rows[300:]])
    return folder, rows


def stream(spark, folder):
    return windows.read_files(spark, folder + "/*", SCHEMA, files_per_batch=1)


def test_step_counts_carry_over_batches(spark, tmp_path, reports):
    folder, rows = reports
    counter = stateful.StepCounter(str(tmp_path / "out"), ["k"], ["t", "id"], "v", CHANGED, out="n")
    sink.drain(stream(spark, folder), f"steps-{tmp_path.name}", counter, mode="append")
    assert len(sink.batches(spark, str(tmp_path / "out/counts"))) == 3
    whole = spark.createDataFrame(rows, "k string, t long, id long, v string")
    want = rows_of(count_steps(whole, ["k"], ["t", "id"], "v", CHANGED, out="n"))
    assert rows_of(counter.totals(spark)) == want


def test_replayed_batch_changes_nothing_and_late_rows_are_kept_apart(spark, tmp_path):
    counter = stateful.StepCounter(str(tmp_path), ["k"], ["t"], "v", CHANGED)
    make = lambda rows: spark.createDataFrame(rows, "k string, t long, v string")
    counter(make([("a", 1, "x"), ("a", 2, "y")]), 0)
    second = make([("a", 3, "x"), ("a", 1, "late"), ("b", 1, "x")])
    for _ in range(3):
        counter(second, 1)
    assert rows_of(counter.totals(spark)) == [("a", 2), ("b", 0)]
    assert rows_of(spark.read.parquet(f"{tmp_path}/late"), "k", "t", "v") == [("a", 1, "late")]


def test_sliding_windows_equal_batch(spark, tmp_path, reports):
    folder, rows = reports
    values = {"n": F.count(F.lit(1)), "y": F.count_if(F.col("v") == "y")}
    out = str(tmp_path / "w")
    live = windows.windowed(windows.in_event_time(stream(spark, folder), "at", "20 hours"), "at", ["k"], values, "1 hour", "30 minutes")
    sink.drain(live, f"win-{tmp_path.name}", sink.batch_writer(out))
    whole = spark.createDataFrame(rows, "k string, t long, id long, v string").withColumn("at", F.timestamp_millis("t"))
    want = windows.windowed(whole, "at", ["k"], values, "1 hour", "30 minutes")
    assert rows_of(sink.latest(spark, out, ["window_start", "window_end", "k"])) == rows_of(want)
    assert len(sink.batches(spark, out)) >= 3


def test_running_again_processes_nothing_twice(spark, tmp_path, reports):
    folder, _ = reports
    seen = []
    for _ in range(2):
        sink.drain(stream(spark, folder), f"again-{tmp_path.name}", lambda b, n: seen.append(b.count()), mode="append")
    assert sum(seen) == 400


def test_trailing_and_completeness(spark):
    df = spark.createDataFrame([(0,), (50,), (100,)], "m int").select(F.timestamp_seconds(F.col("m") * 60).alias("at"))
    assert windows.trailing(df, "at").count() == 2
    late = df.where("at < timestamp_seconds(3600)")
    row = windows.complete_until({"main": df, "second": late}, "at").first()
    assert row.complete_until == row.newest_second and row.newest_main > row.complete_until


HOUR = ["window_start", "window_end", "k"]
NAMES = ["n", "y"]


def counts_of():
    return {"n": F.count(F.lit(1)), "y": F.count_if(F.col("v") == "y")}


def correction_log(path):
    hour = F.window("at", "1 hour")
    return corrections.CorrectionLog(
        path, "at", timedelta(minutes=10), HOUR,
        lambda late: late.withColumn("w", hour).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "k", "day"),
        lambda rows: windows.windowed(rows, "at", ["k"], counts_of()),
    )


def test_windows_of_late_rows_are_scored_again(spark, tmp_path):
    rng = random.Random(9)
    rows = [(rng.choice("aab"), t * 60_000, i, rng.choice("xy")) for i, t in enumerate(sorted(rng.choices(range(3000), k=600)))]
    late = rows[10::9]
    on_time = [r for r in rows if r not in late]
    folder, name = str(tmp_path / "in"), tmp_path.name
    log = correction_log(str(tmp_path / "log"))
    repaired = []
    # The second and the third arrival bring late rows; each is followed by a repair, and by one with nothing left to do.
    for i, part in enumerate([on_time[:200], on_time[200:400] + late[:20], on_time[400:] + late[20:]]):
        write_files(spark, f"{folder}/{i}", [part])
        live = windows.read_files(spark, folder + "/*/*", SCHEMA)
        sink.drain(windows.windowed(windows.in_event_time(live, "at", "10 minutes"), "at", ["k"], counts_of()), f"late-{name}", sink.batch_writer(str(tmp_path / "out")))
        sink.drain(live, f"late-log-{name}", log, mode="append")
        repaired += [log.repair(spark), log.repair(spark)]
    whole = spark.createDataFrame(rows, "k string, t long, id long, v string").withColumn("at", F.timestamp_millis("t"))
    want = rows_of(windows.windowed(whole, "at", ["k"], counts_of()))
    written = sink.latest(spark, str(tmp_path / "out"), HOUR)
    assert rows_of(written, *HOUR, *NAMES) != want  # the stream alone has lost rows
    assert rows_of(log.merged(written), *HOUR, *NAMES) == want
    assert repaired[0] == 0 and repaired[2] > 0 and repaired[4] > 0 and repaired[1::2] == [0, 0, 0]
    assert repaired[2] + repaired[4] < len(want)  # exactly the touched windows, not all


def test_a_replayed_batch_leaves_the_log_as_it_was(spark, tmp_path):
    log = correction_log(str(tmp_path))
    make = lambda *minutes: spark.createDataFrame([("a", m * 60_000, m, "x") for m in minutes], "k string, t long, id long, v string").withColumn("at", F.timestamp_millis("t"))
    log(make(1, 200), 0)
    for _ in range(2):
        log(make(5, 210), 1)
    assert log.repair(spark) == 1 and log.repair(spark) == 0
    assert spark.read.parquet(f"{tmp_path}/rows").count() == 4


def test_keyed_steps_go_on_from_the_state(spark, tmp_path, reports):
    folder, rows = reports
    out = str(tmp_path / "out")
    for files in (f"{folder}/part0", f"{folder}/part[01]", f"{folder}/part*"):  # three runs: each goes on where the last one ended
        live = windows.in_event_time(windows.read_files(spark, files, SCHEMA, files_per_batch=1), "at", "20 hours")
        counts = keyed.count_steps_keyed(live, ["k"], ["t", "id"], "v", CHANGED, out="n")
        sink.drain(counts, f"keyed-{tmp_path.name}", sink.batch_writer(out), mode="append")
    assert len(sink.batches(spark, out)) >= 3
    whole = spark.createDataFrame(rows, "k string, t long, id long, v string")
    want = rows_of(count_steps(whole, ["k"], ["t", "id"], "v", CHANGED, out="n"))
    assert rows_of(spark.read.parquet(out).groupBy("k").agg(F.sum("n").alias("n"))) == want


def test_closed_sessions_leave_the_state(spark, tmp_path):
    # Sixty sessions of one key, each two hours after the last.
    rows = [("a", s * 7_200_000 + m * 60_000, s * 10 + m, "y") for s in range(60) for m in range(3)]
    folder, name, out = str(tmp_path / "in"), f"sess-{tmp_path.name}", str(tmp_path / "out")
    held = []
    for i in range(3):
        write_files(spark, f"{folder}/{i}", [rows[60 * i:60 * i + 60]])
        live = windows.in_event_time(windows.read_files(spark, folder + "/*/*", SCHEMA), "at", "10 minutes")
        active = windows.sessions(live, "at", ["k"], counts_of(), "30 minutes")
        sink.drain(active, name, sink.batch_writer(out), mode="append")
        opened = windows.open_sessions(spark, f"{shared_dir(spark)}/progress/{name}", ["k"], NAMES)
        held.append(opened.count())
    assert max(held) <= 2
    closed = spark.read.parquet(out).drop("batch")
    whole = spark.createDataFrame(rows, "k string, t long, id long, v string").withColumn("at", F.timestamp_millis("t"))
    assert rows_of(closed.unionByName(opened)) == rows_of(windows.sessions(whole, "at", ["k"], counts_of(), "30 minutes"))


def test_slots_wait_for_the_slowest_source(spark, tmp_path):
    rows = [(s, m * 60_000, m, "x") for m in range(0, 600, 7) for s in ("a", "b") if s == "a" or m < 330]
    folder = str(tmp_path / "in")
    delays = {"a": "5 minutes", "b": "20 minutes"}
    for i in range(3):
        write_files(spark, f"{folder}/{i}", [rows[i * 45:(i + 1) * 45]])
        live = windows.read_files(spark, folder + "/*/*", SCHEMA)
        slots = windows.common_slots({s: live.where(F.col("k") == s) for s in delays}, "at", delays)
        sink.drain(slots, f"slots-{tmp_path.name}", sink.batch_writer(str(tmp_path / "out")), mode="append")
    whole = spark.createDataFrame(rows[:135], "k string, t long, id long, v string").withColumn("at", F.timestamp_millis("t"))
    want = windows.passed_slots({s: whole.where(F.col("k") == s) for s in delays}, "at", delays)
    got = spark.read.parquet(str(tmp_path / "out")).drop("batch")
    assert rows_of(got) == rows_of(want) and got.count() == 5


class FakeHandle:
    """State and timers of one series."""

    def __init__(self):
        self.held, self.timers = None, []

    def getValueState(self, name, schema):
        return self

    def get(self):
        return self.held

    def update(self, value):
        self.held = value

    def clear(self):
        self.held = None

    def registerTimer(self, at):
        self.timers.append(at)

    def getExpiryTimeInMs(self):
        return self.timers.pop(0)


def test_a_series_keeps_one_timer_and_reads_rows_as_they_are():
    handle = FakeHandle()
    processor = keyed.StepProcessor(["k"], ["d"], ["t", "id"], "v", T.StringType(), CHANGED, "n", 100)
    processor.init(handle)
    row = Row("d", "t", "id", "v")
    arrive = lambda *rows: [tuple(r) for r in processor.handleInputRows(("a",), iter([row(*r) for r in rows]), None)]
    assert arrive((1, 20, 2, "y"), (1, 10, 1, "x"), (1, 30, 3, None)) == [("a", 1, 1)]
    assert arrive((2, 90, 4, "x"), (1, 20, 2, "z"), (1, 20, None, "z"), (None, 91, 5, "y")) == [("a", 2, 1)]
    assert arrive((1, 15, 9, "q")) == []
    assert handle.timers == [120] and handle.held == (91, 5, "y")
    for at, held in ((191, (91, 5, "y")), (None, None)):  # the first timer is early for the last row and moves on
        assert list(processor.handleExpiredTimer(("a",), None, handle)) == []
        assert handle.held == held and handle.timers == ([at] if at else [])
