"""Scorers on hand-made records, and the shape of their plans."""

import pytest
from pyspark.sql import functions as F

from qoelens import telemetry as data
from qoelens.operators.stationarity import mobility
from qoelens.plans import daily as D
from qoelens.plans import extensions as E
from qoelens.plans import features as X
from qoelens.plans import hourly as H
from qoelens.plans import legacy as L
from qoelens.plans import reports as R

from .conftest import rows_of

TINY = "/root/testdata/sf0.001"
RECORD = ("sn string, rowkey string, station_mac string, station_name string, band string, rssi int, snr int, phy_rate int, "
          "tx_phy_rate int, mode int, model string, hour string, date string, p50_rssi int, p90_rssi int, son long, mobility_status string")


def records(spark, *specs):
    """Each spec: (count, overrides)."""
    base = dict(sn="S1", rowkey="k", station_mac="m", station_name="tv", band="5GH", rssi=-60, snr=30, phy_rate=700,
                tx_phy_rate=300, mode=9, model="M", hour="08", date="20240101", p50_rssi=-61, p90_rssi=-60, son=None,
                mobility_status="Stationary")
    rows = [tuple({**base, **o}.values()) for n, o in specs for _ in range(n)]
    return spark.createDataFrame(rows, RECORD)


def only(df, *columns):
    assert df.count() == 1
    return tuple(df.select(*columns).first())


def test_station_score_of_a_good_station(spark):
    got = only(H.station_score(records(spark, (9, {}))), "station_score", "base_score", "final_phy_rate_score", "p90_rssi_6g_base")
    assert got == ("Excellent", 4, 4, None)


def test_station_needs_nine_records(spark):
    assert H.station_score(records(spark, (8, {}))).isEmpty()


def test_least_band_decides_and_penalty_subtracts(spark):
    mixed = records(spark, (9, {}), (3, {"band": "2.4GH", "phy_rate": 50}), (1, {"snr": 10}))
    assert only(H.station_score(mixed), "base_score", "variation_score", "station_score") == (2, 1, "Poor")


def test_legacy_mode_cap_counts_as_excellent(spark):
    slow = records(spark, (9, {"phy_rate": 6}))
    assert only(H.station_score(slow), "phy_rate_score_5g_base") == (4,)
    assert only(H.station_score(slow, profile="station_hour_deployed"), "phy_rate_score_5g_base") == (1,)
    assert only(H.station_score(records(spark, (9, {"phy_rate": 6, "mode": None}))), "phy_rate_score_5g_base") == (1,)


def test_sentinels_wired_and_empty_records_do_not_count(spark):
    junk = [(9, {}), (5, {"band": "ETH"}), (5, {"band": None}), (5, {"p90_rssi": None, "phy_rate": None, "snr": None, "rssi": None}),
            (5, {"phy_rate": 0, "rssi": 0, "p90_rssi": -100}), (5, {"phy_rate": 0, "rssi": 0, "p90_rssi": None})]
    assert H.scorable(records(spark, *junk)).count() == 9


def test_silent_and_stalled_station_is_dropped(spark):
    assert H.station_score(records(spark, (9, {"p90_rssi": -100, "phy_rate": 0}))).isEmpty()


def test_six_ghz_only_station_has_no_coverage_by_default(spark):
    rows = records(spark, (8, {"band": "6GH"}))
    features = H.pillar_features(rows)
    assert only(H.with_station_pillars(features), "station_coverage", "station_speed") == (None, 4.0)
    assert only(H.with_station_pillars(features, include_6g=True), "station_coverage") == (3.0,)


def test_control_rates_and_bad_snr_do_not_count(spark):
    rows = records(spark, (8, {"tx_phy_rate": 24, "snr": 96}))
    assert only(H.pillar_features(rows), "records", "usable_rates", "snr_range_variation") == (8, 0, None)


def test_pillar_mean(spark):
    df = spark.createDataFrame([(3.0, 4.0, None), (3.0, 4.0, 2), (None, 4.0, 2)], "s double, c double, r int")
    got = [r[0] for r in df.select(H.combine_pillars(F.col("s"), F.col("c"), F.col("r"))).collect()]
    assert got == [3.5, 3.0, None]


def owl(spark, *rows):
    return spark.createDataFrame(
        [(f"0001-S1_O", ts, d, c, (r,) if r else None) for ts, d, c, r in rows],
        "rowkey string, ts long, Owl_Data_fwa_cpe_data string, owl_data_modem_event string, Diag_Result_dev_restart struct<reason:string>")


def test_ip_changes_count_against_previous_report(spark):
    day = 86_400_000
    ips = [(1, "1.1"), (2, "1.1"), (3, "2.2"), (4, None), (day, "2.2"), (day + 1, "3.3")]
    df = owl(spark, *((t, None if ip is None else f'{{"ipv4_ip": "{ip}"}}', None, None) for t, ip in ips))
    assert rows_of(D.ip_changes_daily(df), "sn", "no_ip_changes") == [("S1", 1), ("S1", 1)]


def test_restart_reasons(spark):
    df = owl(spark, (1, None, None, "BTN"), (2, None, None, "GUI"), (3, None, None, "APP"), (4, None, None, "SYS"), (5, None, "x", None))
    assert only(D.restarts_daily(df), "num_mdm_crashes", "num_user_reboots", "num_total_reboots") == (1, 3, 4)


def test_steering_starts(spark):
    df = spark.createDataFrame(
        [("0001-S1_A", ("2", a), None, None) for a in "212323"] + [("0001-S1_B", None, ("2", "2"), None), ("0001-S2_C", None, None, None)],
        "rowkey string, Diag_Result_band_steer struct<sta_type:string,action:string>, "
        "Diag_Result_ap_steer struct<sta_type:string,action:string>, Station_Data_connect_data "
        "struct<connect_type:string,signal_strength:int,tx_link_rate:string,diff_bs:bigint,diff_br:bigint>")
    assert only(D.steering_kpi(D.station_day(df)), "sn", "band_success_count", "ap_success_count", "steer_start_perHome_count") == ("S1", 3, 1, 2.0)


def test_look_back_ends(spark):
    daily = spark.createDataFrame([("S", f"2024-01-{d:02d}", 1) for d in range(1, 31)], "sn string, day string, n int")
    daily = daily.withColumn("day", F.to_date("day"))
    assert only(D.lookback(daily, "2024-01-30", 10, {"n": "t"}, ends_before=1), "t") == (10,)
    assert only(D.lookback(daily, "2024-01-05", 10, {"n": "t"}), "t") == (5,)


def test_missing_kpis_fill_up_but_signal_does_not(spark):
    frames = [
        spark.createDataFrame([("S1", 7, "Poor")], "sn string, no_ip_changes long, ip_change_category string"),
        spark.createDataFrame([("S2", 3.2, "Good")], "sn string, rssi_numeric double, RSSI_category string"),
        spark.createDataFrame([], "sn string, phyrate_numeric double, phyrate_category string, steer_start_category string, "
                              "steer_start_perHome_category string, customer_reboot_category string, reboot_category string, "
                              "modem_reset_category string, sudden_drop_category string, Airtime_Utilization_Category string, "
                              "steer_start_count long, steer_start_perHome_count double, user_reboot_count long, "
                              "total_reboots_count long, mdm_resets_count long, no_sudden_drop long, no_poor_airtime long"),
    ]
    scored = {r.sn: r for r in D.score_homes(D.home_kpis(frames, "2024-01-30")).collect()}
    assert scored["S1"].numerical_reliabilityScore == 3.57 and scored["S1"].coverageScore is None
    assert (scored["S1"].speedScore, scored["S1"].wifi_score) == ("Excellent", "Excellent")
    assert (scored["S2"].coverageScore, scored["S2"].wifi_score, scored["S2"].day) == ("Good", "Good", "01-30-2024")


def test_requests_are_normalised(spark):
    df = spark.createDataFrame([(" ab1 ", " why? ", None), ("", "q", None), ("x", " ", None), ("c", "q", "2024-02-02")],
                               "sn string, question string, target_date string")
    assert rows_of(R.requests(df, "2024-01-30")) == [("AB1", "why?", "2024-01-30"), ("C", "q", "2024-02-02")]


def test_novelty_needs_a_baseline(spark):
    df = spark.createDataFrame([("a", d, v) for d, v in enumerate([5.0, 5.2, 5.1, 5.1, 50.0])], "k string, day_no int, value double")
    assert [r.novel for r in E.novelty(df, ["k"]).orderBy("day_no").collect()] == [False, False, False, False, True]


# ------------------------------------------------------------------ plan shape


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_needed_columns_and_filters_reach_the_scan(spark):
    plan = plan_of(data.table(spark, TINY, "lineitem").where("l_linenumber = 7").groupBy("l_suppkey").agg(F.sum("l_tax")))
    assert "PushedFilters: [IsNotNull(l_linenumber), EqualTo(l_linenumber,7)]" in plan
    assert "ReadSchema: struct<l_suppkey:bigint,l_linenumber:int,l_tax:double>" in plan


def test_station_score_aggregates_once(spark, tmp_path):
    records(spark, (9, {})).write.parquet(str(tmp_path / "r"))
    plan = plan_of(H.station_score(spark.read.parquet(str(tmp_path / "r"))))
    assert plan.count("Exchange hashpartitioning") == 1 and "Window" not in plan and "Join" not in plan


def test_nested_history_reads_only_used_fields(spark, tmp_path):
    data.station_history(spark, TINY).write.parquet(str(tmp_path / "h"))
    plan = plan_of(H.consumption(spark.read.parquet(str(tmp_path / "h"))))
    assert "Station_Data_connect_data:struct<station_mac:string,bs:string,br:s" in plan


@pytest.mark.parametrize("build", [
    lambda s: D.rssi_kpi(D.rssi_stations(data.station_history(s, TINY))),
    lambda s: D.steering_kpi(D.station_day(data.station_history(s, TINY))),
    lambda s: D.restarts_daily(data.owl_history(s, TINY)),
    lambda s: H.reliability(data.device_groups(s, TINY)),
])
def test_core_stays_in_the_jvm_without_windows(spark, build):
    plan = plan_of(build(spark))
    for node in ("Python", "InPandas", "Window", "CartesianProduct", "NestedLoop"):
        assert node not in plan


def test_a_station_leaves_a_task_as_one_row(spark):
    c = "struct<connect_type: string, signal_strength: int, tx_link_rate: string, diff_bs: bigint, diff_br: bigint>"
    steer = "struct<sta_type: string, action: string>"
    rows = [
        ("1-S1_m", ("5GI", -40, "900Mbps", 10, 1), ("2", "2"), None), ("1-S1_m", ("5GI", -90, None, None, 2), ("2", "1"), ("2", "2")),
        ("1-S1_m", ("ETH", None, "1Mbps", 99, 99), ("1", "2"), None), ("1-S1_m", ("2.4GI", None, "5Mbps", 4, 4), None, None),
        (None, ("ETH", -50, None, 3, None), None, None), (None, None, None, None),
    ]
    df = spark.createDataFrame(
        rows, f"rowkey string, Station_Data_connect_data {c}, Diag_Result_band_steer {steer}, Diag_Result_ap_steer {steer}"
    )
    day = D.station_day(df)
    assert plan_of(day).count("Exchange hashpartitioning") == 1
    names = [x for kind in ("rssi", "phyrate") for x in (f"{kind}_total_count", f"{kind}_byte_send", f"{kind}_byte_received")]
    steered = ("band_seen", "band_start", "ap_seen", "ap_start")
    assert rows_of(day, "sn", "rowkey", *names, *steered) == rows_of(spark.createDataFrame(
        [("S1", "1-S1_m", 2, 10, 3, 3, 14, 7, 2, 1, 1, 1), (None, None, 1, 3, None, 0, None, None, 0, 0, 0, 0)],
        "a string, b string, " + ", ".join(f"c{i} bigint" for i in range(10)),
    ))
    levels = {n: day.where("sn = 'S1'").agg(F.sum(n)).first()[0] for n in day.columns if "_count_" in n}
    assert {k: v for k, v in levels.items() if v and "total" not in k} == {
        "rssi_excellent_count_5GHz": 1, "rssi_poor_count_5GHz": 1, "phyrate_excellent_count_5GHz": 1, "phyrate_poor_count_2_4GHz": 1,
    }


def _byte_reports(spark, rows):
    return spark.createDataFrame(
        [(k, 1706572800000, (mac, bs, br)) for k, mac, bs, br in rows],
        "rowkey string, ts bigint, Station_Data_connect_data struct<station_mac: string, bs: string, br: string>",
    )


def test_consumption_counts_huge_counters(spark):
    from qoelens.plans.hourly import consumption

    huge = "9999999999999999999999"
    history = _byte_reports(spark, [
        ("R1-SN1_M1", "m1", huge, "0"), ("R1-SN1_M1", "m1", "100", "5"), ("R1-SN1_M2", "m2", "100", "5"),
        ("R1-SN1_M2", "m2", "n/a", "7"), ("R1-SN1_M3", "m3", "9" * 38, "9" * 38),
    ])
    found = {r["station_mac"]: int(r["total_bytes"]) for r in consumption(history).collect()}
    assert found == {"m2": 105}


def test_consumption_takes_the_last_part_of_the_key(spark):
    from qoelens.plans.hourly import consumption

    found = consumption(_byte_reports(spark, [("AB-12-SN2_M", "m", "1", "2")])).collect()
    assert [(r["sn"], int(r["total_bytes"])) for r in found] == [("SN2", 3)]


def test_days_without_events_are_active(spark):
    from qoelens.plans.extensions import rate_per_active_day

    daily = spark.createDataFrame([("a", 1, 3), ("a", 4, 1)], "sn string, day int, resets int")
    reports = spark.createDataFrame([("a", d) for d in (1, 2, 3, 4, 4)] + [("b", 1)], "sn string, day int")
    found = {r["sn"]: (r["events"], r["active_days"], r["rate"]) for r in rate_per_active_day(daily, reports, ["sn"], "resets").collect()}
    assert found == {"a": (4, 4, 1.0), "b": (0, 1, 0.0)}


def test_golden_votes_and_labels(spark):
    """Cases with known answers: the vote of twelve, worst of three, number to label."""
    from qoelens.functions.profiles import score_to_label
    from qoelens.functions.scoring import vote, worst_label

    counts = spark.createDataFrame([(7, 11, 13, 0, 0, 1, 1, 0)], "p5 int, f5 int, g5 int, e5 int, p2 int, f2 int, g2 int, e2 int")
    picked = counts.select(vote({k: [f"{k[0].lower()}5", f"{k[0].lower()}2"] for k in ("Poor", "Fair", "Good", "Excellent")}, 12).alias("v")).first()["v"]
    assert picked == "Good"
    labels = spark.createDataFrame([("Good", "Fair", "Poor")], "a string, b string, c string")
    assert labels.select(worst_label("a", "b", "c").alias("w")).first()["w"] == "Poor"
    scores = spark.createDataFrame([(1,), (2,), (3,), (4,)], "s int").select(score_to_label("s").alias("l"))
    assert [r["l"] for r in scores.collect()] == ["Poor", "Fair", "Good", "Excellent"]


def test_variance_shares_of_correlated_and_constant_columns(spark):
    rows = [(float(i), 2.0 * i, float(i % 2), 7.0) for i in range(10)] + [(None, 1.0, 1.0, 7.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, same double")
    got = E.explained_variance(df, ["a", "b"], 2).collect()
    assert [r.component for r in got] == [1, 2] and [round(r.share, 9) for r in got] == [1.0, 0.0]
    with_constant = E.explained_variance(df, ["a", "b", "c", "same"], 4).collect()
    assert round(sum(r.share for r in with_constant), 9) == 1.0 and abs(with_constant[-1].share) < 1e-9
    assert E.explained_variance(df.limit(0), ["a", "b"], 2).isEmpty()
    assert E.explained_variance(df.where("a = 3"), ["a", "b"], 2).isEmpty()


def test_consumption_by_class_counts_known_stations_of_rated_homes(spark):
    used = spark.createDataFrame(
        [("H1", "r1", "5G", 10, 1), ("H1", "r2", "5G", 20, 2), ("H1", "r1", "6G", 99, 9), ("H2", "r3", "2_4G", 5, 5),
         ("H3", "r4", "5G", 7, 7), ("H1", "r5", "5G", 1000, 0), ("H1", None, "5G", 1, 1)],
        "sn string, rowkey string, connect_type string, byte_send long, byte_received long",
    )
    classes = spark.createDataFrame(
        [("r1", "Phone"), ("r1", "Phone"), ("r2", "Phone"), ("r2", "Tablet"), ("r3", "Phone"), ("r4", "Phone")],
        "rowkey string, device_class string",
    )
    scores = spark.createDataFrame(
        [("H1", "M1", "Good"), ("H2", "M1", None), ("H3", "M2", "Poor")], "sn string, model_name string, wifi_score string"
    )
    got = L.consumption_by_class(used, classes, scores, ["M1"])
    assert rows_of(got, "score", "device_class", "connect_type", "data_volume") == sorted(
        [("Good", "Phone", "5G", 33), ("Good", "Tablet", "5G", 22), (None, "Phone", "2_4G", 10)], key=repr
    )


def test_enrichment_meets_stations_instead_of_records(spark):
    station = "struct<station_mac: string, station_name: string, connect_type: string, signal_strength: int, snr: int, link_rate: string, tx_link_rate: string, mode: int>"
    schema = f"rowkey string, ts long, Tplg_Data_model_name string, Station_Data_connect_data {station}, Diag_Result_band_steer struct<sta_type: string, action: string>, Diag_Result_ap_steer struct<sta_type: string, action: string>"
    rows = [
        (f"0001-HM0001_{mac}", 1706600000000 + i, "M", (mac, "st", "5GI", -50 - i % spread, 30, "90Mbps", rate, 1), None, None)
        for mac, spread, rate in (("A", 2, "90Mbps"), ("B", 30, "90Mbps"), ("C", 2, "12Mbps")) for i in range(20)
    ]
    history = spark.createDataFrame(rows, schema)
    counts = H.signal_counts(history)
    known = mobility(counts, ["sn", "station_mac"], "rssi", counted="n")
    assert rows_of(known) == rows_of(mobility(H.connection_records(history), ["sn", "station_mac"], "rssi"))
    enrichment = H.station_enrichment(history, known, counts)
    late = H.pillar_features(H.connection_records(history), enrichment=enrichment)
    early = H.pillar_features(H.enrich(history, known, counts))
    assert rows_of(late) == rows_of(early, *late.columns)
    assert {r["station_mac"]: r["mobility_status"] for r in late.collect()} == {"A": "Stationary", "B": "Non-stationary", "C": None}


def counted(df):
    """``df`` and how many of its rows have been read since."""
    read = df.sparkSession.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    return df.mapInArrow(count, df.schema), read


def _device_records(spark):
    rows = [
        ("0001-HM1_AC01", "0001-HM1", "HM1", mac, parent, -50 - i % 20, 100.0 + i, "5G", 1000 + i, 2000)
        for mac, parents in (("AC01", ("RTR1", "EXT1")), ("AC02", ("RTR1",))) for i in range(40) for parent in (parents[i % len(parents)],)
    ]
    return spark.createDataFrame(
        rows, "rowkey string, rk_row_sn string, serial_num string, station_mac string, parent_id string, signal long, "
        "rate double, band string, byte_send long, byte_received long",
    )


def test_device_table_and_home_score_read_their_records_once(spark):
    boxes = [("0001-HM1", [("RTR1", "M1", None, f"fw{i}"), ("EXT1", "M2", "RTR1", "ex1")]) for i in range(3)]
    groups = spark.createDataFrame(
        boxes, "rowkey string, Group_Data_sys_info array<struct<mac: string, model: string, parent_mac: string, fw: string>>"
    )
    mapping = spark.createDataFrame([("HM1", "m", "c")], "serial_num string, mdn string, cust_id string")
    records, read = counted(_device_records(spark))
    group_rows, groups_read = counted(groups)
    table = {r.station_mac: r for r in L.device_table(records, group_rows, mapping, "d").collect()}
    assert (read.value, groups_read.value) == (80, 3)
    first, second = table["AC01"], table["AC02"]
    assert sorted(first.RouExt_mac) == ["EXT1", "RTR1"] and sorted(first.Rou_Ext) == [0, 1] and sorted(first.firmware) == ["ex1", "fw2"]
    assert second.parent_id == ["RTR1"] and second.poor_rssi == 0.0 and second.avg_phyrate == 119.5
    assert first.weights + second.weights == pytest.approx(1.0) and first.avg_sig_strength_cat2 == -59.5
    records, read = counted(_device_records(spark))
    assert {r.num_station for r in L.home_percentages(records, groups, mapping, "d").collect()} == {2}
    assert read.value == 80


def _scan_rows(spark):
    point = "array<struct<data: array<struct<bssid: string>>>>"
    bands = ", ".join(f"wifi_scan_wifi_ap_data_{b} {point}" for b in X.NEIGHBOUR_BANDS)
    scans = [
        ("r1", "08", [([("a",), ("b",)],), ([("a",), (None,)],)], [([("a",)],)], None),
        ("r1", "12", [([("a",)],)], [([("c",)],)], None),
        ("r2", "08", None, [([(None,)],)], None),
        (None, "08", [([("a",)],)], None, None),
    ]
    return spark.createDataFrame(scans, f"rowkey string, hour string, {bands}")


def test_access_points_are_held_once_for_all_bands(spark):
    scans = _scan_rows(spark)
    assert rows_of(X.heard_once(scans)) == sorted([("r1", "a", 3), ("r1", "b", 1), ("r1", "c", 2), ("r1", None, 1), ("r2", None, 2), (None, "a", 1)], key=repr)
    assert rows_of(X.neighbours(scans)) == sorted([("r1", 2, 2, None), ("r2", None, 0, None), (None, 1, None, None)], key=repr)


def test_each_band_of_an_hour_gets_its_points_back(spark):
    again = X.by_band(X.heard_once(_scan_rows(spark), "hour"))
    assert rows_of(again, "rowkey", "hour", "band", "bssid") == rows_of(X.heard(_scan_rows(spark), "hour").distinct())


def test_neighbour_sketches_read_the_scans_once(spark, monkeypatch):
    from qoelens.catalogue import extension_queries as EQ

    scans, read = counted(_scan_rows(spark))
    monkeypatch.setattr(EQ.data, "neighbour_scans", lambda *_: scans)
    found = rows_of(EQ.sketch_neighbours(spark, ""))
    assert found == [("r1", "2_4g", 2, True), ("r1", "5g", 2, True)] and read.value == 4
