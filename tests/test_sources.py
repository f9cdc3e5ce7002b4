"""Sources, sinks and gap handling on small written tables."""

import os
import time
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from qoelens import telemetry as data
from qoelens.operators.skew import materialise, temporary
from qoelens.plans import jobs
from qoelens.session import build_session, run_dir, shared_dir
from qoelens.sources import gaps, sinks, tables
from qoelens.sources.ledger import LedgerTable

from .conftest import rows_of


@pytest.fixture
def hours(spark, tmp_path):
    df = spark.createDataFrame(
        [(i, d, h) for i, (d, h) in enumerate((d, h) for d in ("20240101", "20240102") for h in ("00", "08", "23"))],
        "v int, date string, hour string",
    )
    sinks.write_partitions(df, str(tmp_path / "t"))
    return str(tmp_path / "t")


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert run_dir(spark, "x") != run_dir(spark, "x")


def test_partition_values_stay_text_and_prune(spark, hours):
    df = tables.read_partitioned(spark, hours, date="20240102", hour="08")
    assert rows_of(df, "v", "date", "hour") == [(4, "20240102", "08")]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_rewriting_replaces_only_its_partitions(spark, hours):
    again = spark.createDataFrame([(99, "20240101", "08")], "v int, date string, hour string")
    for _ in range(2):
        sinks.write_partitions(again, hours)
    df = tables.read_partitioned(spark, hours)
    assert df.count() == 6 and rows_of(df.where("v = 99"), "date", "hour") == [("20240101", "08")]


def test_listing_and_existence(spark, hours):
    assert tables.partitions(spark, hours, "date", "hour")[0] == ("20240101", "00")
    assert tables.partitions(spark, hours + "-none", "date") == []
    assert tables.path_exists(spark, hours) and not tables.path_exists(spark, hours + "-none")
    assert not tables.is_complete(spark, hours + "/date=20240101")


def test_require_names_every_fault(spark):
    df = spark.createDataFrame([(1, "x")], "A int, extra string")
    assert tables.require(df, "a int") is df
    with pytest.raises(ValueError, match="a is int, not string; b is missing"):
        tables.require(df, "a string, b int")


def test_look_back_skips_missing_days(spark, tmp_path):
    template = str(tmp_path) + "/{}/daily"
    for d in ("2024-01-01", "2024-01-03"):
        spark.createDataFrame([(d,)], "d string").write.parquet(template.format(d))
    days = tables.days_back("2024-01-04", 4)
    assert days == ["2024-01-04", "2024-01-03", "2024-01-02", "2024-01-01"]
    assert rows_of(tables.read_days(spark, template, days)) == [("2024-01-01",), ("2024-01-03",)]
    assert tables.newest(spark, template, days) == template.format("2024-01-03")
    with pytest.raises(FileNotFoundError):
        tables.read_days(spark, template, ["2023-01-01"])
    with pytest.raises(FileNotFoundError):
        tables.newest(spark, template, ["2023-01-01"])
    assert rows_of(tables.read_recursive(spark, str(tmp_path), "d")) == [("2024-01-01",), ("2024-01-03",)]
    assert gaps.pending_days(spark, template, "2024-01-04", 4) == ["2024-01-02", "2024-01-04"]


def test_read_through(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.createDataFrame([(1,)], "a int")

    for _ in range(2):
        assert rows_of(tables.read_or_compute(spark, str(tmp_path / "r"), build)) == [(1,)]
    assert len(calls) == 1


def test_create_only(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "a int")
    sinks.create_only(df, str(tmp_path / "c"), "2024-01-01")
    assert rows_of(spark.read.parquet(str(tmp_path / "c"))) == [(1, "2024-01-01")]
    with pytest.raises(AnalysisException):
        sinks.create_only(df, str(tmp_path / "c"), "2024-01-01")


def test_volume_gate(spark, tmp_path):
    base = str(tmp_path / "g")
    assert sinks.publish_if_volume(spark.range(10), base, "20240101", "05", 10) == (False, 10)
    assert not tables.path_exists(spark, f"{base}/date=20240101/hour=05")
    for n in (11, 12):
        assert sinks.publish_if_volume(spark.range(n), base, "20240101", "05", 10) == (True, n)
        assert tables.read_partitioned(spark, base, date="20240101", hour="05").count() == n
    assert sinks.is_ready(spark, base, "20240101", "05", 11)
    assert not sinks.is_ready(spark, base, "20240101", "05", 12)
    assert not sinks.is_ready(spark, base, "20240101", "06", 0)


def test_mapping_csv(spark, tmp_path):
    df = spark.createDataFrame(
        [("m1", "s1", "c1", "INSTALL COMPLETE"), ("m2", "s2", "c2", "PENDING")],
        "mdn_5g string, serialnumber string, cust_id string, status string")
    sinks.export_csv(df, str(tmp_path / "m"))
    assert rows_of(tables.read_mapping(spark, str(tmp_path / "m"))) == [("m1", "s1", "c1")]


def test_export_has_a_header_in_every_part(spark, tmp_path):
    sinks.export_csv(spark.range(60).repartition(4), str(tmp_path / "e"))
    parts = list((tmp_path / "e").glob("part-*.csv"))
    assert len(parts) == 4 and all(p.read_text().startswith("id\n") for p in parts)
    assert spark.read.option("header", True).csv(str(tmp_path / "e")).count() == 60


def test_today_only_past_hours_are_wanted(spark):
    got = gaps.wanted_hours(spark, ["20240101", "20240102", "20240103"], datetime(2024, 1, 2, 3, 30))
    assert got.where("date = '20240101'").count() == 24
    assert rows_of(got.where("date = '20240102'"), "hour") == [("00",), ("01",), ("02",)]
    assert got.where("date = '20240103'").isEmpty()


def test_gaps_are_found_and_filled_once(spark, tmp_path, hours):
    other = str(tmp_path / "other")
    outputs = {"station": hours, "home": other}
    now = datetime(2024, 1, 2, 0, 0)
    missing = gaps.missing_partitions(spark, outputs, ["20240101"], now)
    by_hour = {r.hour: r.missing for r in missing.collect()}
    assert len(by_hour) == 24 and by_hour["08"] == ["home"] and by_hour["09"] == ["station", "home"]

    def job(base):
        def run(source, date, hour):
            sinks.write_partitions(source.withColumns({"date": F.lit(date), "hour": F.lit(hour)}), base)
        return run

    few = missing.where("hour in ('08', '09')")
    done = gaps.backfill(few, lambda d, h: spark.createDataFrame([(int(h),)], "v int"), {n: job(b) for n, b in outputs.items()})
    assert done == 3
    left = gaps.missing_partitions(spark, outputs, ["20240101"], now)
    assert left.where("hour in ('08', '09')").isEmpty()


def test_build_session_sets_utc(spark):
    assert build_session("again").conf.get("spark.sql.session.timeZone") == "UTC"


def test_a_failed_run_leaves_the_version_before(spark, tmp_path):
    table = LedgerTable(spark, str(tmp_path / "scores"), ("date", "hour"))
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.current().isEmpty() and table.rows_of("20240101", "08") is None
    rows = spark.range(5).withColumn("hour", F.lit("99"))
    assert table.publish(rows, "20240101", "08").published
    assert table.publish(spark.range(2), "20240101", "09").rows == 2
    broken = spark.range(3).select(F.raise_error(F.lit("lost")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        table.publish(broken, "20240101", "08")
    assert rows_of(table.read(F.col("hour") == "08")) == [(i, "20240101", "08") for i in range(5)]
    assert table.publish(spark.range(7, 9), "20240101", "08").published
    assert rows_of(table.read(F.col("hour") == "08"), "id") == [(7,), (8,)]
    assert table.superseded().count() == 1 and table.rows_of("20240101", "08") == 2


def test_a_refused_run_is_entered_and_not_read(spark, tmp_path):
    table = LedgerTable(spark, str(tmp_path / "scores"), ("date",))
    table.publish(spark.range(10), "20240101", minimum=3)
    refused = table.publish(spark.range(3), "20240101", minimum=3)
    assert (refused.rows, refused.published) == (3, False)
    assert table.publish(spark.range(0), "20240102").published is False
    assert table.read().count() == 10 and rows_of(table.refused(), "date", "rows") == [("20240101", 3), ("20240102", 0)]
    assert rows_of(table.current(), "date", "rows") == [("20240101", 10)]


def _shuffle_files(spark):
    """Name and bytes of the shuffle files on disk."""
    held = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    files = (held.apply(k) for k in range(held.size()))
    return {name: f.length() for f in files if (name := f.getName()).startswith("shuffle_")}


def _odd_slots(spark):
    """Rows of 8 tasks, each with a share of all partitions; one has no day, another one a name to be escaped."""
    day = F.when(F.col("id") % 3 == 0, "2024-01-01 08:00").when(F.col("id") % 3 == 1, "20240102")
    return spark.range(0, 3000, 1, 8).withColumns({"day": day, "hour": F.lpad((F.col("id") % 2).cast("string"), 2, "0")})


def test_partitions_are_written_without_a_shuffle(spark, tmp_path):
    rows, base = _odd_slots(spark), str(tmp_path / "t")
    before = set(_shuffle_files(spark))
    sinks.write_partitions(rows, base, ["day", "hour"])
    assert not set(_shuffle_files(spark)) - before
    assert rows_of(spark.read.schema(rows.schema).parquet(base)) == rows_of(rows)
    assert not [name for name in os.listdir(base) if name.startswith("_staging")] and tables.is_complete(spark, base)


def test_small_files_of_a_partition_are_joined_and_large_ones_stay(spark, tmp_path, monkeypatch):
    rows, base = _odd_slots(spark), str(tmp_path / "t")

    def files():
        return [sum(f.endswith(".parquet") for f in names) for _, _, names in os.walk(base) if any(f.endswith(".parquet") for f in names)]

    sinks.write_partitions(rows, base, ["day", "hour"])
    assert files() == [1] * 6
    monkeypatch.setattr(sinks, "FILE_BYTES", 1)
    sinks.write_partitions(rows.where("id < 6 OR id > 11"), base, ["day", "hour"])
    assert files() == [8] * 6
    assert rows_of(spark.read.schema(rows.schema).parquet(base)) == rows_of(rows.where("id < 6 OR id > 11"))


def test_a_failed_write_leaves_the_partitions_before(spark, hours):
    broken = spark.createDataFrame([(1, "20240101", "08")], "v int, date string, hour string").withColumn("v", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        sinks.write_partitions(broken, hours)
    assert rows_of(tables.read_partitioned(spark, hours), "v") == [(i,) for i in range(6)]


def test_temporary_tables_go_with_their_block(spark):
    kept = materialise(spark.range(3), "kept")
    with pytest.raises(RuntimeError), temporary(spark):
        path = materialise(spark.range(5), "between").inputFiles()[0].removeprefix("file://")
        assert os.path.exists(path)
        raise RuntimeError
    assert not os.path.exists(path) and kept.count() == 3


def _tables(spark, tmp_path):
    """A few homes' ``lineitem`` and ``events``, made into the inputs of both jobs."""
    spark.range(0, 3000, 1, 2).selectExpr(
        "id as l_orderkey", "id % 40 as l_partkey", "id % 3 as l_suppkey", "cast(1 + id % 7 as int) as l_linenumber",
        "cast(id % 50 as double) as l_quantity", "1000 + id * 7D as l_extendedprice", "id % 10 / 100D as l_discount",
        "id % 9 / 100D as l_tax", "case id div 40 % 3 when 0 then 'A' when 1 then 'N' else 'R' end as l_returnflag",
    ).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.range(300).selectExpr(
        "id as event_id", "timestamp_ntz '2024-01-02 00:00:00' + make_dt_interval(cast(id % 28 as int)) as ts", "id % 3 as user_id",
        "case when id % 2 = 0 then 'click' else 'purchase' end as event_type", "concat('{\"k\": ', id % 99, '}') as props",
    ).write.parquet(str(tmp_path / "events.parquet"))
    base, history, groups = str(tmp_path), data.station_history(spark, str(tmp_path)), data.device_groups(spark, str(tmp_path))
    sinks.write_partitions(data.day_earlier(history).unionByName(history), f"{base}/history")
    sinks.write_partitions(groups, f"{base}/groups")
    events = data.owl_history(spark, base).withColumn("date", F.date_format(F.timestamp_millis("ts"), "yyyyMMdd"))
    sinks.write_partitions(events, f"{base}/events", ["date"])
    return base


def test_a_days_job_leaves_only_its_outputs(spark, tmp_path):
    base = _tables(spark, tmp_path)
    paths = jobs.DailyPaths(*(f"{base}/{t}" for t in ("history", "groups", "events", "mobility", "stations", "homes")))
    before = set(os.listdir(shared_dir(spark)))
    done = jobs.score_day(spark, paths, data.SCORE_DATE, tiebreak=["event_id"])
    assert [o.published and o.rows > 0 for o in done] == [True] * 3
    assert set(os.listdir(shared_dir(spark))) == before
    assert jobs.by_date(spark, paths.homes).read().count() == done[2].rows


def test_an_hours_job_and_its_back_fill_leave_only_their_outputs(spark, tmp_path):
    base = _tables(spark, tmp_path)
    paths = jobs.HourlyPaths(*(f"{base}/{t}" for t in ("history", "groups", "mobility", "stations", "homes")))
    before = set(os.listdir(shared_dir(spark)))
    jobs.store_mobility(spark, paths, data.DATE_BEFORE)
    done = jobs.score_hour(spark, paths, data.SCORE_DATE, "08")
    done += jobs.backfill_hours(spark, paths, [data.SCORE_DATE], datetime(2024, 1, 31))
    assert [o.published and o.rows > 0 for o in done] == [True] * 6
    assert set(os.listdir(shared_dir(spark))) == before
    assert jobs.by_hour(spark, paths.homes).read().count() == sum(o.rows for o in done[1::2])


def test_a_published_runs_shuffles_leave_the_disk(spark, tmp_path):
    before, grouped = set(_shuffle_files(spark)), spark.range(50_000).groupBy("id").count()
    LedgerTable(spark, str(tmp_path / "scores"), ("date",)).publish(grouped, "20240101")

    def left():  # the look at the ledger leaves a few bytes
        return sum(size for name, size in _shuffle_files(spark).items() if name not in before)

    until = time.monotonic() + 15
    while left() > 5000 and time.monotonic() < until:
        time.sleep(0.2)
    assert left() <= 5000
