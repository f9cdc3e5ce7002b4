"""Operators against brute force, with hot keys, ties, NULLs and tiny batches."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from qoelens.operators import shape
from qoelens.operators.histogram import percentiles_of_counts, value_counts
from qoelens.operators.ordered import CHANGED, count_steps, dropped_by_more_than, last_rows
from qoelens.operators.ranking import heavy_hitter_blend, top_rows, top_ties
from qoelens.operators.skew import join_back, keep_members, share_of_total
from qoelens.operators.stationarity import drop_low_outliers, stationarity

from .conftest import rows_of

WAYS = {
    "default": {},
    "joined": {"hot_share": 1.0},
    "split": {"hot_share": 0.2},
    "counted": {"hot_share": 0.2, "size": None},
}


def skewed(spark, n=3000, seed=1):
    """One key holds over a third of the rows; one key is NULL."""
    rng = random.Random(seed)
    keys = ["hot"] * 4 + ["a", "b", "c", "d", None, "e"]
    return spark.createDataFrame([(rng.choice(keys), i, rng.randint(0, 30)) for i in range(n)], "k string, i int, v int")


@pytest.mark.parametrize("way", WAYS)
def test_join_back_equals_window(spark, way):
    rows = skewed(spark)
    stats = rows.groupBy("k").agg(F.max("v").alias("top"), F.count(F.lit(1)).alias("n"))
    got = join_back(rows, stats, ["k"], **{"size": "n", **WAYS[way]})
    top = defaultdict(int)
    for r in rows.collect():
        top[r.k] = max(top[r.k], r.v)
    assert rows_of(got, "k", "i", "top") == sorted(((r.k, r.i, top[r.k]) for r in rows.collect()), key=repr)


@pytest.mark.parametrize("way", WAYS)
def test_left_join_back_keeps_unknown_keys(spark, way):
    rows = skewed(spark)
    stats = rows.where("k in ('hot', 'a')").groupBy("k").agg(F.max("v").alias("top"), F.count(F.lit(1)).alias("n"))
    got = join_back(rows, stats, ["k"], how="left", **WAYS[way])
    assert got.count() == rows.count()
    assert got.where("top is not null").count() == rows.where("k in ('hot', 'a')").count()


@pytest.mark.parametrize("way", WAYS)
def test_keep_members(spark, way):
    rows = skewed(spark)
    members = rows.where("k in ('hot', 'b')").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    options = {k: v for k, v in WAYS[way].items() if k != "size"}
    assert rows_of(keep_members(rows, members, ["k"], **options)) == rows_of(rows.where("k in ('hot', 'b')"))


def test_hot_rows_are_not_shuffled_by_their_key(spark):
    rows = skewed(spark).repartition(3)
    stats = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    plan = join_back(rows, stats, ["k"], size="n", hot_share=0.2)._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan and "BroadcastHashJoin" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_hot_keys_outside_the_table_are_split_too(spark):
    rows = skewed(spark).repartition(3)
    members = rows.where("k = 'a'").select("k").distinct()
    plan = keep_members(rows, members, ["k"], hot_share=0.2)._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan
    left = join_back(rows, members.withColumn("x", F.lit(1)), ["k"], how="left", hot_share=0.2)
    assert left.count() == rows.count() and left.where("x = 1").count() == rows.where("k = 'a'").count()


def test_shares_sum_to_one(spark):
    got = share_of_total(skewed(spark), ["k"], "v", "share").groupBy("k").agg(F.sum("share").alias("s")).collect()
    assert all(r.s == pytest.approx(1.0) for r in got)


def brute_steps(rows, test):
    """(key, group) -> passing neighbouring pairs, for rows (key, group, order, value)."""
    counts, last = defaultdict(int), {}
    for k, g, o, v in sorted(rows, key=lambda r: (r[0], r[2], r[3])):
        counts[k, g] += int(k in last and test(last[k], v))
        last[k] = v
    return dict(counts)


@pytest.mark.parametrize("batch", ["3", "10000"])
@pytest.mark.parametrize("partitions", ["1", "7"])
def test_steps_match_lag(spark, batch, partitions):
    rng = random.Random(5)
    data = []
    for i in range(2500):
        t = rng.randint(0, 900)
        data.append((rng.choice(["hot", "hot", "hot", "a", "b"]), t // 300, t, rng.choice("xxxyz")))
    df = spark.createDataFrame(data, "k string, g int, t int, v string")
    before = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(r.k, r.g): r.steps for r in count_steps(df, ["k"], ["t"], "v", CHANGED, ["g"]).collect()}
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == brute_steps(data, lambda a, b: a != b)


def test_a_series_leaves_one_segment_per_task(spark):
    from qoelens.operators import ordered

    df = spark.createDataFrame([("hot", t, "x" if t % 3 else "y") for t in range(2000)], "k string, t int, v string")
    df = df.withColumn("_counted", F.lit(True)).coalesce(1).sortWithinPartitions("t")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        schema = ordered._segment_schema(df, ["k"], [], ["t"], "v")
        got = df.mapInPandas(ordered._summarise(["k"], [], ["t"], "v", CHANGED), schema).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    assert len(got) == 1 and (got[0]["_at_t"], got[0]["_to_t"], got[0]["_inner"]) == (0, 1999, 1333)


def test_copies_add_nothing(spark):
    df = spark.createDataFrame([("h", 1, "x")] * 500 + [("h", 2, "y")] * 500, "k string, t int, v string").repartition(6)
    assert rows_of(count_steps(df, ["k"], ["t"], "v", CHANGED)) == [("h", 1)]


def test_drops_and_single_rows(spark):
    df = spark.createDataFrame([("h", 1, 9), ("h", 2, 5), ("h", 3, 1), ("h", 4, 0), ("i", 1, 9)], "k string, t int, v int")
    got = rows_of(count_steps(df, ["k"], ["t"], "v", dropped_by_more_than(3)))
    assert got == [("h", 2), ("i", 0)]


def test_carried_row_is_a_neighbour_but_not_counted(spark):
    old = spark.createDataFrame([("h", 0, "x"), ("z", 0, "x")], "k string, t int, v string")
    new = spark.createDataFrame([("h", 1, "y"), ("h", 2, "y"), ("n", 1, "q")], "k string, t int, v string")
    assert rows_of(count_steps(new, ["k"], ["t"], "v", CHANGED, carry=old)) == [("h", 1), ("n", 0)]
    assert rows_of(last_rows(new.unionByName(old), ["k"], ["t"], "v")) == [("h", 2, "y"), ("n", 1, "q"), ("z", 0, "x")]


def test_percentiles_of_counts(spark):
    rows = skewed(spark)
    points = {"p3": 0.03, "p50": 0.5, "p90": 0.9, "all": 1.0}
    got = {r.k: r for r in percentiles_of_counts(value_counts(rows, ["k"], "v"), ["k"], "v", points).collect()}
    groups = defaultdict(list)
    for r in rows.collect():
        groups[r.k].append(r.v)
    assert set(got) == set(groups)
    for k, values in groups.items():
        values.sort()
        assert got[k].n == len(values) and got[k].top == values[-1]
        for name, p in points.items():
            assert got[k][name] == values[max(0, -(-int(p * 100) * len(values) // 100) - 1)]


def brute_blend(stations, renormalise=False):
    """stations: [(score, volume)] of one home."""
    ranked = []
    for s, v in stations:
        rank = 1 + sum(1 for _, w in stations if w is not None and (v is None or w > v))
        ranked.append((rank, s))
    top = [s for rank, s in ranked if rank <= 5 and s is not None]
    rest = [s for rank, s in ranked if rank > 5 and s is not None]
    parts = [sum(x) / len(x) if x else None for x in (top, rest)]
    if renormalise and None in parts:
        kept = [p for p in parts if p is not None]
        return round(kept[0] + 1e-9, 2) if kept else None
    return round(0.8 * (parts[0] or 0) + 0.2 * (parts[1] or 0) + 1e-9, 2)


@pytest.mark.parametrize("renormalise", [False, True])
def test_blend_matches_rank(spark, renormalise):
    rng = random.Random(9)
    homes = {
        "few": [(4.0, i) for i in range(3)],
        "nulls": [(rng.choice([1.0, 2.5, 4.0]), None) for _ in range(9)],
        "ties": [(rng.choice([1.0, 1.5, 4.0]), rng.choice([1, 2, 3])) for _ in range(12)],
        "unscored": [(None, 5), (None, 4), (2.0, 3)],
        "hot": [(rng.choice([1.0, 4 / 3, 2.5, 3.0]), rng.choice([None, *range(400)])) for _ in range(900)],
    }
    data = [(h, s, v) for h, stations in homes.items() for s, v in stations]
    df = spark.createDataFrame(data, "sn string, s double, v long").repartition(5)
    got = {r.sn: r for r in heavy_hitter_blend(df, ["sn"], "s", "v", "blend", renormalise=renormalise).collect()}
    for h, stations in homes.items():
        assert got[h].blend == pytest.approx(brute_blend(stations, renormalise)), h
        assert got[h].n == len(stations) and 0 <= got[h].blend <= 4
    if not renormalise:
        assert got["few"].blend <= 3.2


def test_top_of_group_prunes_before_the_shuffle(spark):
    df = skewed(spark)
    plan = top_rows(df, ["k"], [F.desc("v"), "i"], 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    ties = spark.createDataFrame([("a", 3), ("a", 3), ("a", 1)], "k string, n int")
    assert rows_of(top_ties(ties, ["k"], [F.desc("n")])) == [("a", 3), ("a", 3)]


def test_constant_signal_is_not_stationary(spark):
    rows = [("flat", -50)] * 20 + [("calm", -50 - i % 4) for i in range(40)] + [("wild", -40 - 2 * (i % 25)) for i in range(50)]
    df = spark.createDataFrame(rows, "k string, s int")
    assert rows_of(stationarity(df, ["k"], "s"), "k", "stationarity") == [("calm", "1"), ("wild", "0")]
    assert ("flat", "1") in rows_of(stationarity(df, ["k"], "s", keep_constant=True), "k", "stationarity")
    assert rows_of(stationarity(df, ["k"], "s", method="sketch"), "k", "stationarity") == [("calm", "1"), ("wild", "0")]


def test_low_outliers_are_dropped(spark):
    df = spark.createDataFrame([("k", -50 - i % 3) for i in range(99)] + [("k", -100), ("k", None)], "k string, s int")
    kept = drop_low_outliers(df, ["k"], "s")
    assert kept.count() == 99 and kept.where("s = -100").isEmpty()


def test_flatten(spark):
    df = spark.createDataFrame(
        [Row(id=1, s=Row(a=1, t=Row(b="x")), xs=[Row(p=1), Row(p=2)], ys=[7, 8]), Row(id=2, s=Row(a=2, t=Row(b="y")), xs=[], ys=[9])])
    flat = shape.flatten(df)
    assert set(flat.columns) == {"id", "s_b_a", "s_b_t_b_b", "xs_b_p", "ys"} and flat.count() == 4
    assert shape.flatten(df, arrays="explode_outer").count() == 5
    assert shape.flatten(df, arrays="keep").count() == 2


def test_replace_rows_keeps_null_keys_and_duplicates(spark):
    base = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "sn string, v int")
    update = spark.createDataFrame([(10, "b"), (11, "b"), (12, "c")], "v int, sn string")
    assert rows_of(shape.replace_rows(base, update)) == sorted([("a", 1), (None, 3), ("b", 10), ("b", 11), ("c", 12)], key=repr)
    assert shape.with_fallback(base, None) is base


def test_merge_features_is_a_full_outer_join_with_one_shuffle(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "k string, a int")
    b = spark.createDataFrame([("y", "p"), ("z", "q")], "k string, b string")
    merged = shape.merge_features([a, b], "k")
    assert rows_of(merged) == sorted([("x", 1, None), ("y", 2, "p"), ("z", None, "q")], key=repr)
    assert merged._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    with pytest.raises(ValueError):
        shape.merge_features([a, a], "k")


def test_covered_time(spark):
    from qoelens.operators.intervals import covered

    rng = random.Random(12)
    rows = [("hot", t, t + rng.choice([0, 1, 5, 400])) for t in rng.choices(range(20_000), k=3000)]
    rows += [("hot", 10, 9_000), (None, 1, 4), (None, 3, 9), ("b", 5, None), ("c", 7, 7), ("d", 1, 3), ("d", 3, 5), ("d", 1, 3)]
    rows += [(f"k{i}", s, s + 10) for i in range(40) for s in (0, 5, 30)]
    df = spark.createDataFrame(rows, "k string, a long, b long").repartition(5)
    seen = {}
    for k, a, b in rows:
        if b is not None and b > a:
            seen.setdefault(k, set()).update(range(a, b))
    got = {r.k: r.covered for r in covered(df, ["k"], "a", "b").collect()}
    assert got == {k: len(v) for k, v in seen.items()}


def test_sketches_merge_over_slots(spark):
    from qoelens.plans import sketches as K

    rng = random.Random(3)
    rows = [("a", d, rng.gauss(0, 1)) for d in range(30) for _ in range(700)] + [("b", 0, 5.0), ("b", 1, None), ("c", 2, None)]
    df = spark.createDataFrame(rows, "k string, day int, v double").repartition(4)
    states = K.quantile_states(df, ["k"], "day", "v")
    assert states.count() == 31
    got = {r.k: r for r in K.quantiles(states, ["k"], {"p10": 0.1, "p50": 0.5, "p90": 0.9}).collect()}
    values = sorted(v for k, _, v in rows if k == "a")
    assert set(got) == {"a", "b"} and got["a"].n == 21_000 and got["b"].p50 == 5.0
    for name, share in (("p10", 0.1), ("p50", 0.5), ("p90", 0.9)):
        rank = sum(v <= got["a"][name] for v in values) / len(values)
        assert abs(rank - share) <= K.RANK_ERROR
    counts = K.distinct_counts(K.distinct_states(df.withColumn("v", F.round("v", 3).cast("string")), ["k"], "day", "v"), ["k"])
    exact = len({round(v, 3) for v in values})
    assert abs({r.k: r.distinct for r in counts.collect()}["a"] - exact) <= exact * K.DISTINCT_ERROR
