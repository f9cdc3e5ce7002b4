"""Quality grades by ordinal cumulative-link regression.

Documents have grades 0 < 1 < ... < top. One weight per hashed feature and one
threshold per step between grades give

    P(grade > k) = sigmoid(score - threshold[k]),   thresholds ascending,

so all steps share the weights. The expected grade is the sum of these tail
probabilities; the last one, P(top grade), selects.

Features of a text, hashed into a fixed number of buckets: its distinct words
(runs of letters and digits, A-Z folded); the shares of its word shapes
(letters, capitals, digits and punctuation, repeats taken once); the share of
words that repeat the word before; the share of characters beyond ASCII.

The model is fitted on at most ``SAMPLE`` labelled documents, those with the
smallest hash of their id, in one task. Every document is then graded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import materialise
from . import textbytes as B

#: Most labelled documents the model is fitted on.
SAMPLE = 20_000
BUCKETS = 1 << 16
ROUNDS = 200
PENALTY = 2e-4
TOP = 2
FOLDS, HELD_OUT = 5, 0
SHAPE_SCALE = 3.0

_NOT_ALNUM = np.ones(256, dtype=bool)
_NOT_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[0x61:0x7B] = ord("a")
_SHAPE[0x80:] = ord("a")
_SHAPE[0x41:0x5B] = ord("A")
_SHAPE[0x30:0x3A] = ord("0")
_WORD_TABLE = B.hash_table(_NOT_ALNUM, True)
_SHAPE_TABLE = B.hash_table(B.IS_SPACE, False)


def _features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bounds, buckets, values): document i has the features bounds[i]:bounds[i + 1]."""
    s, _, words = B.runs(data, offsets, _NOT_ALNUM, _WORD_TABLE)
    word_bounds = np.searchsorted(s, offsets)
    shape = _SHAPE[data]
    first = np.ones(len(shape), dtype=bool)
    first[1:] = shape[1:] != shape[:-1]
    first[offsets[:-1][offsets[:-1] < len(shape)]] = True
    kept = np.append(0, np.cumsum(first))
    shape_offsets = kept[offsets]
    t, _, shapes = B.runs(shape[first], shape_offsets, B.IS_SPACE, _SHAPE_TABLE)
    shape_bounds = np.searchsorted(t, shape_offsets)
    buckets, values, sizes = [], [], []
    for i in range(len(offsets) - 1):
        own = words[word_bounds[i]:word_bounds[i + 1]]
        distinct = np.unique(own % np.uint64(BUCKETS - 2)) + np.uint64(2)
        kinds, often = np.unique(shapes[shape_bounds[i]:shape_bounds[i + 1]] % np.uint64(BUCKETS - 2), return_counts=True)
        again = float((own[1:] == own[:-1]).mean()) if len(own) > 1 else 0.0
        wide = float((data[offsets[i]:offsets[i + 1]] >= 0x80).mean()) if offsets[i + 1] > offsets[i] else 0.0
        buckets += [distinct.astype(np.int32), (kinds + np.uint64(2)).astype(np.int32), np.array([0, 1], np.int32)]
        shares = SHAPE_SCALE * np.sqrt(often / max(1, often.sum()))
        values += [np.ones(len(distinct), np.float32), shares.astype(np.float32), np.array([SHAPE_SCALE * again, wide], np.float32)]
        sizes.append(len(distinct) + len(kinds) + 2)
    bounds = np.append(0, np.cumsum(sizes)).astype(np.int64)
    return bounds, np.concatenate(buckets), np.concatenate(values)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in B.slices(batches):
        bounds, buckets, values = _features(data, offsets)
        at = pa.array(bounds.astype(np.int32))
        yield pa.record_batch(
            [batch.column("grade"), pa.ListArray.from_arrays(at, pa.array(buckets)), pa.ListArray.from_arrays(at, pa.array(values))],
            names=["grade", "buckets", "values"],
        )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def train(grade: np.ndarray, bounds: np.ndarray, buckets: np.ndarray, values: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """(weights, ascending thresholds) by full-batch Adam on the penalised log likelihood.

    P(grade = k) = P(grade > k - 1) - P(grade > k). Thresholds are a first one
    and positive steps, so they stay in order.
    """
    n = len(grade)
    owner = np.repeat(np.arange(n), np.diff(bounds))
    # A document's score is scaled by its number of features, so long ones don't outweigh.
    scale = (1 / np.sqrt(np.maximum(np.bincount(owner, weights=values * values, minlength=n), 1))).astype(np.float32)
    values = values * scale[owner] * 4
    share = np.array([(np.count_nonzero(grade > k) + 1) / (n + 2) for k in range(top)])
    start = -np.log(share / (1 - share))
    theta = np.concatenate([np.zeros(BUCKETS), start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    mean, spread = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, ROUNDS + 1):
        weights, first, gaps = theta[:BUCKETS], theta[BUCKETS], np.exp(theta[BUCKETS + 1:])
        cuts = first + np.append(0, np.cumsum(gaps))
        score = np.bincount(owner, weights=weights[buckets] * values, minlength=n)
        tail = np.concatenate([np.ones((n, 1)), _sigmoid(score[:, None] - cuts), np.zeros((n, 1))], axis=1)
        rows = np.arange(n)
        upper, lower = tail[rows, grade], tail[rows, grade + 1]
        likely = np.maximum(upper - lower, 1e-12)
        slope_up, slope_low = upper * (1 - upper) / likely, lower * (1 - lower) / likely
        by_score = slope_up - slope_low
        by_cut = np.zeros(top + 2)
        np.add.at(by_cut, grade, -slope_up)
        np.add.at(by_cut, grade + 1, slope_low)
        by_cut = by_cut[1:top + 1]
        gradient = np.concatenate([
            np.bincount(buckets, weights=by_score[owner] * values, minlength=BUCKETS) / n - PENALTY * weights,
            [by_cut.sum() / n], np.cumsum(by_cut[::-1])[::-1][1:] * gaps / n,
        ])
        mean = 0.9 * mean + 0.1 * gradient
        spread = 0.99 * spread + 0.01 * gradient * gradient
        theta = theta + 0.1 * (mean / (1 - 0.9 ** step)) / (np.sqrt(spread / (1 - 0.99 ** step)) + 1e-8)
    return theta[:BUCKETS], theta[BUCKETS] + np.append(0, np.cumsum(np.exp(theta[BUCKETS + 1:])))


def _fit(top: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("order")
        grade = table.column("grade").to_numpy().astype(np.int64)
        parts = [table.column(c).combine_chunks() for c in ("buckets", "values")]
        bounds = np.append(0, np.cumsum([len(x) for x in parts[0]]))
        weights, cuts = train(grade, bounds, parts[0].flatten().to_numpy(), parts[1].flatten().to_numpy(), top)
        return pa.table({"weights": pa.array([weights.tolist()]), "cuts": pa.array([cuts.tolist()])})

    return run


def fit(labelled: DataFrame, top: int = TOP, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray] | None:
    """The model of ``labelled`` (doc_id, text, grade from 0 to ``top``; others are left out); None without rows."""
    known = labelled.where(F.col("grade").between(0, top)).withColumn("order", F.xxhash64("doc_id"))
    last = known.select("order").orderBy("order").limit(sample).agg(F.max("order")).first()[0]
    chosen = known.where(F.col("order") <= (0 if last is None else last))
    features = chosen.select("text", F.struct("grade", "order").alias("grade")).mapInArrow(
        _extract, "grade struct<grade:int,order:bigint>, buckets array<int>, values array<float>"
    )
    flat = features.select("grade.grade", "grade.order", "buckets", "values", F.lit(0).alias("all"))
    rows = flat.groupBy("all").applyInArrow(_without_key(_fit(top)), "weights array<double>, cuts array<double>").collect()
    return (np.array(rows[0]["weights"]), np.array(rows[0]["cuts"])) if rows else None


def _without_key(function):
    def run(table: pa.Table) -> pa.Table:
        return function(table.drop_columns(["all"]))

    return run


def _grade(model: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, cuts = model.value
        for batch, data, offsets in B.slices(batches):
            bounds, buckets, values = _features(data, offsets)
            size = np.add.reduceat(values.astype(np.float64) ** 2, bounds[:-1])
            score = 4 * np.add.reduceat(weights[buckets] * values, bounds[:-1]) / np.sqrt(np.maximum(size, 1))
            tail = _sigmoid(score[:, None] - cuts)
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(tail.sum(axis=1)), pa.array(tail[:, -1])],
                names=["doc_id", "expected_grade", "p_top"],
            )

    return run


def grade(docs: DataFrame, model: tuple[np.ndarray, np.ndarray] | None, least: float = 0.5) -> DataFrame:
    """``doc_id, expected_grade, p_top, kept`` per row of ``docs`` (doc_id, text).

    ``kept`` when the top grade has probability ``least`` or more. NULL text is
    graded as empty. Without a model nothing is known: NULL grades, all kept.
    """
    if model is None:
        return docs.select("doc_id", F.lit(None).cast("double").alias("expected_grade"), F.lit(None).cast("double").alias("p_top"), F.lit(True).alias("kept"))
    held = docs.sparkSession.sparkContext.broadcast(model)
    out = docs.select("doc_id", "text").mapInArrow(_grade(held), "doc_id bigint, expected_grade double, p_top double")
    return out.withColumn("kept", F.col("p_top") >= least)


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_OUT


def rating(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): 0 toxic, 1 poor, 2 good; one row per document, the lowest of its ratings."""
    value = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    return labels.groupBy("doc_id").agg(F.min(value).cast("int").alias("grade")).where("doc_id is not null and grade is not null")


def learn_and_grade(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on rated documents that are not held out and grade all, with ``held_out``."""
    rated = materialise(rating(labels).where(~held_out()).withColumn("order", F.xxhash64("doc_id")).orderBy("order").limit(SAMPLE).drop("order"), "ratings")
    return grade(docs, fit(docs.select("doc_id", "text").join(F.broadcast(rated), "doc_id"))).withColumn("held_out", held_out())
