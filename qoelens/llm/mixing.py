"""Mixing sources to target weights by the cube method.

A source's target is its weighted share of all words, at most ``MOST_COPIES``
times what it has. If the target is r times a source's words, every document
of it is taken floor(r) times, and once more with probability p = r - floor(r).
Those draws are balanced: the cube method moves the probabilities of a few
documents at a time along the null space of the balancing constraints - number
of documents and number of words - until each is 0 or 1. The totals never
change on the way; in the end at most two documents of a source are left
undecided. In the landing these go to the nearer side, and documents of the
last flight make up for the words that this adds or takes.

The flight runs in buckets of a source; what a bucket leaves undecided, two
documents at most, flies again with what other buckets left, until one bucket
per source holds the rest. A hot source is many buckets. All "random" choices are
hashes of the row (doc_id, source, text, and its number among equal rows), so
reruns agree.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..operators.skew import materialise
from . import textbytes as B

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
#: Documents that fly together.
BUCKET = 4096
SEED = 20240607
_EPSILON = 1e-9

_UNIT = "source string, key bigint, number bigint, size bigint, p double"
_ROW = ["key", "number"]


def _row_key() -> Column:
    """A number that rows of equal doc_id, source and text share."""
    parts = [x for c in ("doc_id", "source", "text") for x in (F.col(c).isNull(), F.col(c))]
    return F.xxhash64(*parts)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their part of the table and their number among its rows of the same key."""
    part, seen = TaskContext.get().partitionId(), Counter()
    for batch in batches:
        numbers = []
        for key in batch.column("key").to_pylist():
            numbers.append(seen[key])
            seen[key] += 1
        batch = batch.append_column("part", pa.array([part] * len(numbers), pa.int32()))
        yield batch.append_column("place", pa.array(numbers, pa.int64()))


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _numbered(_sizes(batches))


def _with_numbers(rows: DataFrame, fields: list[T.StructField] | None = None, run=_numbered) -> DataFrame:
    """``rows`` with ``number``: 0, 1, ... among all rows of the same ``key``.

    Numbers are given per part of the written table, so a key that holds most
    rows is spread; a key has at most one row of counts per part. ``run`` makes
    columns ``fields`` of the rows first, in the same Python workers.
    """
    schema = [*(fields or rows.schema.fields), T.StructField("part", T.IntegerType()), T.StructField("place", T.LongType())]
    held = materialise(rows.mapInArrow(run, T.StructType(schema)), "numbered")
    counted = held.groupBy("key", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counted.select("key", "part", F.sum("n").over(earlier).alias("before")).where("before > 0")
    numbered = held.join(materialise(before, "before"), _ROW[:1] + ["part"], "left")
    return numbered.withColumn("number", F.col("place") + F.coalesce("before", F.lit(0))).drop("part", "place", "before")


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in B.slices(batches):
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        begin = ~B.IS_SPACE[data]
        begin[1:] &= ~begin[:-1] | edge[1:-1]
        yield pa.record_batch(
            [*(batch.column(c) for c in ("doc_id", "source", "key")), pa.array(B.per_document(begin, offsets))],
            names=["doc_id", "source", "key", "size"],
        )


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, key, size, number) per row; size is the number of words, 0 for NULL text."""
    rows = docs.select("doc_id", "source", "text", _row_key().alias("key"))
    fields = [f for f in rows.schema.fields if f.name != "text"] + [T.StructField("size", T.LongType())]
    return _with_numbers(rows, fields, _measured)


def targets(totals: dict[str | None, int]) -> dict[str | None, float]:
    """Words each source is to contribute.

    Sources in code point order, NULL last, weigh 5, 2, 1 and so on. A share
    above three times the source's words stops there, and the excess goes to
    the others by weight until none is above. A source without words has
    target 0.
    """
    order = sorted(totals, key=lambda s: (s is None, s or ""))
    weight = {s: WEIGHTS[i % len(WEIGHTS)] for i, s in enumerate(order)}
    target, open_, left = {s: 0.0 for s in order}, list(order), float(sum(totals.values()))
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if unit * weight[s] > MOST_COPIES * totals[s]]
        if not full:
            target.update({s: unit * weight[s] for s in open_})
            break
        for s in full:
            target[s] = float(MOST_COPIES * totals[s])
            left -= target[s]
            open_.remove(s)
    return target


def fly(size: np.ndarray, p: np.ndarray) -> np.ndarray:
    """One flight: probabilities moved to 0 or 1 until at most two are left.

    Three undecided documents have one direction that keeps both totals
    constant: the cross product of the constraints' rows (1, 1, 1) and their
    sizes. One step along it, in the direction that a hash of the step picks
    with the odds that keep every probability's expectation, decides at least
    one of them.
    """
    p = p.astype(float).tolist()
    s = [float(x) for x in size.tolist()]
    draw = np.random.Generator(np.random.PCG64([SEED, len(p)])).random(len(p) + 3).tolist()
    held: list[int] = []
    for k in range(len(p)):
        if _EPSILON < p[k] < 1 - _EPSILON:
            held.append(k)
        else:
            p[k] = round(p[k])
        if len(held) < 3:
            continue
        a, b, c = held
        move = (s[c] - s[b], s[a] - s[c], s[b] - s[a])
        if move == (0.0, 0.0, 0.0):  # equal sizes: the rows say the same, move any two against each other
            move = (1.0, -1.0, 0.0)
        up = down = math.inf
        for i, m in zip(held, move):
            if m > 0:
                up, down = min(up, (1 - p[i]) / m), min(down, p[i] / m)
            elif m < 0:
                up, down = min(up, -p[i] / m), min(down, (p[i] - 1) / m)
        go = up if draw[k] * (up + down) < down else -down
        held = []
        for i, m in zip((a, b, c), move):
            p[i] = min(1.0, max(0.0, p[i] + go * m))
            if _EPSILON < p[i] < 1 - _EPSILON:
                held.append(i)
            else:
                p[i] = round(p[i])
    return np.array(p, dtype=float)


def _fly_bucket(table: pa.Table) -> pa.Table:
    table = table.sort_by([("order", "ascending"), ("key", "ascending"), ("number", "ascending")])
    p = fly(table.column("size").to_numpy(), table.column("p").to_numpy())
    return table.select(["source", "key", "number", "size"]).append_column("p", pa.array(p))


def land(size: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Decide the last few: each goes to the nearer side, and the words by which
    that moves the total are made up by decided documents, largest fit first.
    What remains is less than the smallest document that could be turned."""
    out = np.round(p)
    off = float(((out - p) * size).sum())
    turn = 1.0 if off > 0 else 0.0
    for k in np.argsort(-size, kind="stable").tolist():
        if size[k] and out[k] == turn and size[k] <= abs(off) + size[k] / 2:
            out[k] = 1.0 - turn
            off -= size[k] if turn else -size[k]
            if abs(off) < 1 or (off > 0) != bool(turn):
                break
    return out


def _land_source(table: pa.Table) -> pa.Table:
    table = _fly_bucket(table)
    p = land(table.column("size").to_numpy().astype(float), table.column("p").to_numpy())
    return table.select(["source", "key", "number", "size"]).append_column("p", pa.array(p))


def _undecided() -> Column:
    return (F.col("p") > _EPSILON) & (F.col("p") < 1 - _EPSILON)


def _balanced(units: DataFrame) -> DataFrame:
    """Units (source, key, size, p) with every p moved to 0 or 1."""
    decided, rest, level = units.where(~_undecided()), units.where(_undecided()), 0
    while True:
        most = rest.groupBy("source").count().agg(F.max("count")).first()[0] or 0
        order = F.xxhash64("key", "number", F.lit(SEED + level))
        if most <= BUCKET:
            last = rest.withColumn("order", order).groupBy("source").applyInArrow(_land_source, _UNIT)
            return decided.unionByName(last)
        buckets = math.ceil(most / BUCKET)
        flown = rest.withColumn("order", order).withColumn("bucket", F.pmod(F.xxhash64("order"), F.lit(buckets)))
        flown = materialise(flown.groupBy("source", "bucket").applyInArrow(_fly_bucket, _UNIT), "flight")
        decided, rest, level = decided.unionByName(flown.where(~_undecided())), flown.where(_undecided()), level + 1


def _known_sources(measured: DataFrame) -> DataFrame:
    """(source, source_size, target, copies, p): one row per source."""
    spark = measured.sparkSession
    totals = measured.groupBy("source").agg(F.sum("size").alias("source_size"))
    total = {r["source"]: r["source_size"] for r in totals.collect()}  # one number per source
    rows = []
    for source, target in targets(total).items():
        ratio = target / total[source] if total[source] else 0.0
        copies = min(int(ratio + _EPSILON), MOST_COPIES)
        p = min(max(ratio - copies, 0.0), 1.0)
        rows.append((source, total[source], target, copies, p if p > _EPSILON else 0.0))
    return spark.createDataFrame(rows, "source string, source_size bigint, target double, copies bigint, p double")


def shares(measured: DataFrame) -> DataFrame:
    """``measured`` (doc_id, source, key, number, size) with source_size, target, taken and times.

    ``taken`` is the number of words the mix takes of the row: its size times
    how often it is taken, at most three times. Every row is drawn for itself,
    also among rows that are equal in all columns. A document without words is
    taken as often as its source's whole copies say, and contributes none. An
    empty table gives no rows.
    """
    known = F.broadcast(_known_sources(measured))
    units = measured.select("source", *_ROW, "size").join(known, measured["source"].eqNullSafe(known["source"]))
    units = units.select(measured["source"], *_ROW, "size", "p")
    drawn = materialise(_balanced(units).select(*_ROW, F.round("p").cast("bigint").alias("extra")), "draws")
    held = measured.join(known, measured["source"].eqNullSafe(known["source"])).drop(known["source"])
    times = F.col("copies") + F.col("extra")
    return held.join(drawn, _ROW).select(
        "doc_id", "source", *_ROW, "size", "source_size", "target", (F.col("size") * times).alias("taken"), times.alias("times")
    )


def mix(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, times) per row of ``docs`` (doc_id, source, text)."""
    return shares(materialise(sizes(docs), "sizes")).drop(*_ROW)


def take(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it.

    Rows of equal doc_id, source and text are interchangeable: each takes one of
    their draws. They are numbered in a table of their own; all others meet their
    draw by key.
    """
    drawn = materialise(shares(materialise(sizes(docs), "sizes")).select(*_ROW, "times"), "times")
    rows = docs.select(F.struct("*").alias("row"), _row_key().alias("key"))
    repeated = materialise(drawn.where("number = 1").select("key"), "repeated")
    if repeated.isEmpty():
        taken = rows.join(drawn.hint("merge"), "key")
    else:
        alone = rows.join(repeated, "key", "left_anti").join(drawn.where("number = 0").select("key", "times").hint("merge"), "key")
        among = _with_numbers(rows.join(repeated, "key", "left_semi")).join(drawn, _ROW)
        taken = alone.select("row", "times").unionByName(among.select("row", "times"))
    return taken.select("row", F.explode(F.array_repeat(F.lit(0), F.col("times").cast("int")))).select("row.*")
