"""Packing documents into sequences whose windows keep target proportions of their sources.

Every source is a queue of its documents' ids. Deficit round-robin fills window
after window (a window is one sequence): each source's deficit grows by its
share of the window, the sources are served by descending deficit, each with
what its deficit holds but at least ``LEAST`` ids, until the window is full.
What a source got too much or too little is carried to the next window. A
document is cut wherever a window, or its source's part of it, ends.

Windows come in spans. How many ids of each source stand before a span follows
from the totals alone (shares of all ids before it, rounded to whole ids, with
the rounding carried on), and a span serves exactly that many. So any task can
work out any span without the ones before it, and knows from the place of a
document in its queue where its pieces go: neither texts nor ids are shuffled,
and a source with most documents is spread like all others.

Targets are the shares of all ids unless weights are given. With weights, a
source that runs dry leaves its share to the others. The last ids, fewer than a
window, fill sequences of descending powers of two, so nothing is padded.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.skew import materialise
from . import textbytes as B
from .encoding import encoder

END_ID = 0
SIZE = 1024
#: Fewest ids that a source puts into a window, where it has them.
LEAST = 128
#: Windows of a span.
SPAN = 256
#: Numbers of a table of windows that are worked out at once.
_TABLE = 1 << 21

STORED = "doc_id bigint, source string, part int, before bigint, n bigint, ids binary"
PIECES = (
    "doc_id bigint, source string, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint, ids binary"
)
_STORED = pa.schema([
    ("doc_id", pa.int64()), ("source", pa.string()), ("part", pa.int32()), ("before", pa.int64()), ("n", pa.int64()),
    ("ids", pa.binary()),
])
_PIECES = pa.schema([
    ("doc_id", pa.int64()), ("source", pa.string()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary()),
])


def _tokens(path: str, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, counted = TaskContext.get().partitionId(), {}
        encode = encoder(path).encode
        for batch, _, _ in B.slices(batches):
            ids = [found + end for found in encode(batch.column("text").to_pylist())]
            before, sizes = [], [len(found) // 4 for found in ids]
            sources = batch.column("source").to_pylist()
            for source, n in zip(sources, sizes):
                before.append(counted.get(source, 0))
                counted[source] = before[-1] + n
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"), "source": batch.column("source"), "part": [part] * len(ids),
                    "before": before, "n": sizes, "ids": ids,
                },
                schema=_STORED,
            )

    return run


@dataclass(frozen=True)
class Phase:
    """``n_windows`` windows of ``size`` ids that share ``quota[s]`` ids of source s; ``before[s]`` stand before them."""

    window: int
    n_windows: int
    size: int
    before: tuple[int, ...]
    quota: tuple[int, ...]


def _whole(shares: list[Fraction], total: int, most: list[int]) -> list[int]:
    """Whole numbers near ``shares`` that add up to ``total``, none above ``most``; the largest remainders go up."""
    out = [min(int(x), m) for x, m in zip(shares, most)]
    while sum(out) < total:
        left = total - sum(out)
        order = sorted((s for s in range(len(out)) if out[s] < most[s]), key=lambda s: (out[s] - shares[s], s))
        for s in order[:left]:
            out[s] += 1
    return out


def phases(totals: list[int], weights: list[float] | None = None, size: int = SIZE) -> list[Phase]:
    """Windows for queues of ``totals`` ids. Without weights one phase of full
    windows empties all queues together; with weights a phase ends where the
    next source would run dry. The rest fills powers of two."""
    left, window, out = list(totals), 0, []
    share = [Fraction(w) for w in (weights or totals)]

    def serve(n_windows: int, of: int, quota: list[int]) -> None:
        nonlocal left, window
        out.append(Phase(window, n_windows, of, tuple(t - x for t, x in zip(totals, left)), tuple(quota)))
        left = [x - q for x, q in zip(left, quota)]
        window += n_windows

    while sum(left):
        n_full = sum(left) // size
        if not n_full:
            of = 1 << (sum(left).bit_length() - 1)
            serve(1, of, _whole([Fraction(of * x, sum(left)) for x in left], of, left))
            continue
        open_ = [w if x else Fraction(0) for w, x in zip(share, left)]
        if not sum(open_):  # only sources of weight 0 are left
            open_ = [Fraction(x) for x in left]
        unit = size / sum(open_)
        n = min([n_full, *(int(x / (w * unit)) for w, x in zip(open_, left) if w)])
        if n:
            serve(n, size, _whole([n * w * unit for w in open_], n * size, left))
            continue
        # One window in which the sources that run dry give all they have, and the others the rest by weight.
        dry = [s for s, w in enumerate(open_) if w and left[s] < w * unit]
        given = [Fraction(left[s] if s in dry else 0) for s in range(len(left))]
        others = [Fraction(0) if s in dry else w for s, w in enumerate(open_)]
        rest = size - sum(given)
        if not sum(others):
            others = [Fraction(0 if s in dry else x) for s, x in enumerate(left)]
        serve(1, size, _whole([g + rest * w / sum(others) if sum(others) else g for g, w in zip(given, others)], size, left))
    return out


class Layout:
    """Where the ids of every queue go."""

    def __init__(self, plan: list[Phase], least: int = LEAST, span: int = SPAN):
        self.plan, self.least = plan, least
        n_sources = len(plan[0].quota)
        # So long that the largest source makes up for the rounding of all others within a span.
        self.span = [max(span, -(-n_sources * n_sources // phase.size)) for phase in plan]
        self.starts = [[phase.before[s] for phase in plan] for s in range(n_sources)]
        self.largest = [max(range(n_sources), key=phase.quota.__getitem__) for phase in plan]
        self._served: dict[tuple[int, int], list[int]] = {}

    def served(self, p: int, span: int) -> list[int]:
        """Ids of every source in phase ``p`` before its span ``span``."""
        known = self._served.get((p, span))
        if known is not None:
            return known
        if len(self._served) > 10_000:
            self._served.clear()
        phase = self.plan[p]
        windows = min(span * self.span[p], phase.n_windows)
        out = [q * windows // phase.n_windows for q in phase.quota]
        out[self.largest[p]] += windows * phase.size - sum(out)
        self._served[p, span] = out
        return out

    def find(self, source: int, at: int) -> tuple[int, int]:
        """Phase and span of the id at place ``at`` in a queue."""
        p = bisect_right(self.starts[source], at) - 1
        phase = self.plan[p]
        at -= phase.before[source]
        span = at * phase.n_windows // (phase.quota[source] * self.span[p])
        while self.served(p, span)[source] > at:
            span -= 1
        while self.served(p, span + 1)[source] <= at:
            span += 1
        return p, span

    def windows(self, p: int, spans: list[int]) -> np.ndarray:
        """Deficit round-robin over spans of one phase: ``out[i, k, s]`` is what
        source s puts into window k of span ``spans[i]``. The last span of a phase
        may be shorter; its further windows are empty."""
        phase, length = self.plan[p], self.span[p]
        first = np.array([self.served(p, j) for j in spans], dtype=np.int64)
        left = np.array([self.served(p, j + 1) for j in spans], dtype=np.int64) - first
        n_windows = np.array([min(length, phase.n_windows - j * length) for j in spans], dtype=np.int64)[:, None]
        share = left.copy()  # of a window, in ids per n_windows
        deficit = np.zeros_like(left)
        out = np.zeros((len(spans), int(n_windows.max()), left.shape[1]), dtype=np.int64)
        for k in range(out.shape[1]):
            deficit += share
            order = np.argsort(np.where(left > 0, -deficit, np.iinfo(np.int64).max), axis=1, kind="stable")
            room = np.where(n_windows[:, 0] > k, phase.size, 0)[:, None]
            have = np.take_along_axis(left, order, 1)
            want = np.minimum(np.maximum(np.take_along_axis(deficit, order, 1) // n_windows, self.least), have)
            given = np.clip(room - (np.cumsum(want, axis=1) - want), 0, want)
            more = have - given  # what deficits leave free goes to whoever has ids, in the same order
            given += np.clip(room - given.sum(axis=1, keepdims=True) - (np.cumsum(more, axis=1) - more), 0, more)
            np.put_along_axis(out[:, k], order, given, 1)
            left -= out[:, k]
            deficit -= out[:, k] * n_windows
        return out


def _pieces(layout: Layout, index: dict[str | None, int], with_ids: bool):
    """Cut the documents of each batch where their windows end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            firsts, sizes = (batch.column(c).to_numpy() for c in ("first", "n"))
            queue = [index[s] for s in batch.column("source").to_pylist()]
            # The spans that each document reaches into.
            reach: dict[tuple[int, int], list[int]] = {}
            for row, (s, at, n) in enumerate(zip(queue, firsts.tolist(), sizes.tolist())):
                key = layout.find(s, at)
                while True:
                    reach.setdefault(key, []).append(row)
                    p, span = key
                    if layout.plan[p].before[s] + layout.served(p, span + 1)[s] >= at + n:
                        break
                    done = (span + 1) * layout.span[p] >= layout.plan[p].n_windows
                    key = (p + 1, 0) if done else (p, span + 1)
            at_once = max(1, _TABLE // (max(layout.span) * len(layout.starts)))
            keys = sorted(reach)
            while keys:
                p = keys[0][0]
                mine = [k for k in keys[:at_once] if k[0] == p]
                keys = keys[len(mine):]
                yield from _cut(batch, np.array(queue), layout, mine, [np.array(reach[k]) for k in mine], with_ids)

    return run


def _cut(batch: pa.RecordBatch, queue: np.ndarray, layout: Layout, keys: list[tuple[int, int]], members: list[np.ndarray], with_ids: bool):
    """The pieces of documents in some spans of one phase."""
    p = keys[0][0]
    phase = layout.plan[p]
    firsts, sizes = (batch.column(c).to_numpy() for c in ("first", "n"))
    rows, starts, lengths, numbers, places = ([] for _ in range(5))
    for (_, span), grid, docs in zip(keys, layout.windows(p, [span for _, span in keys]), members):
        # Ids of each source before each window in its queue, and its place within the window.
        before = np.zeros((len(grid) + 1, grid.shape[1]), dtype=np.int64)
        np.cumsum(grid, axis=0, out=before[1:])
        before += np.array(layout.served(p, span)) + np.array(phase.before)
        inside = np.cumsum(grid, axis=1) - grid
        number = phase.window + span * layout.span[p]
        for s in np.unique(queue[docs]).tolist():
            mine, bounds = docs[queue[docs] == s], before[:, s]
            first = np.maximum(firsts[mine], bounds[0])
            last = np.minimum(firsts[mine] + sizes[mine], bounds[-1])
            low = np.searchsorted(bounds, first, side="right") - 1
            n = np.maximum(np.searchsorted(bounds, last, side="left") - low, 0)
            # One candidate per document and window between its ends; windows without ids of the source fall out.
            k = np.arange(n.sum()) + np.repeat(low - (np.cumsum(n) - n), n)
            row, start = np.repeat(mine, n), np.maximum(np.repeat(first, n), bounds[k])
            length = np.minimum(np.repeat(last, n), bounds[k + 1]) - start
            real = length > 0
            k, row, start, length = k[real], row[real], start[real], length[real]
            rows.append(row)
            starts.append(start - firsts[row])
            lengths.append(length)
            numbers.append(number + k)
            places.append(inside[k, s] + start - bounds[k])
    row, start, length, number, place = map(np.concatenate, (rows, starts, lengths, numbers, places))
    ids = batch.column("ids")
    _, offsets, data = ids.buffers()
    at = np.frombuffer(offsets, np.int32)[ids.offset:][row] + 4 * start
    raw = memoryview(data)
    told = [raw[a:b] for a, b in zip(at.tolist(), (at + 4 * length).tolist())]
    yield pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id").take(pa.array(row)), batch.column("source").take(pa.array(row)), pa.array(start), pa.array(length),
            pa.array(list(map(zlib.crc32, told)), pa.int64()), pa.array(sizes[row]), pa.array(number), pa.array(place),
            pa.array([bytes(x) for x in told] if with_ids else [None] * len(told), pa.binary()),
        ],
        schema=_PIECES,
    )


def pack(
    docs: DataFrame, tokenizer: str, weights: dict[str | None, float] | None = None, size: int = SIZE,
    least: int = LEAST, end_id: int = END_ID, with_ids: bool = True,
) -> DataFrame:
    """Pieces of all ``docs`` (doc_id, text, source): doc_id, source, start
    (ids of the document before the piece), length, ids_crc32, doc_tokens,
    sequence_id, offset (in the sequence, from 0 without gaps) and ids
    (little-endian unsigned 32-bit; NULL unless ``with_ids``).

    A document is its ids by the tokenizer file at ``tokenizer`` (a path every
    executor has) and ``end_id``; NULL text counts as empty. Every row is packed
    for itself, whatever its doc_id. NULL is a source like any other. ``weights``
    gives target proportions per source, 0 where one is missing: such a source
    comes last. Only one number per source and the number of ids per source and
    task are gathered. An empty table gives no rows.
    """
    spark = docs.sparkSession
    stored = materialise(docs.select("doc_id", "text", "source").mapInArrow(_tokens(tokenizer, end_id), STORED), "ids")
    counted = materialise(stored.groupBy("part", "source").agg(F.sum("n").alias("n")), "ids-per-task")
    totals = {r["source"]: r["n"] for r in counted.groupBy("source").agg(F.sum("n").alias("n")).collect()}
    if not totals:
        return spark.createDataFrame([], PIECES)
    sources = sorted(totals, key=lambda s: (s is None, s or ""))
    wanted = [weights.get(s, 0.0) for s in sources] if weights is not None else None
    layout = Layout(phases([totals[s] for s in sources], wanted, size), least)
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counted.select(
        F.col("part").alias("b_part"), F.col("source").alias("b_source"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")
    )
    placed = stored.join(base, (F.col("part") == F.col("b_part")) & F.col("source").eqNullSafe(F.col("b_source")))
    placed = placed.select("doc_id", "source", "n", "ids", (F.col("base") + F.col("before")).alias("first"))
    return placed.mapInArrow(_pieces(layout, {s: i for i, s in enumerate(sources)}, with_ids), PIECES)


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids, doc_ids, lengths): every packed sequence with its documents in place."""
    place = F.struct("offset", "doc_id", "length", "ids")
    held = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(place)).alias("held"))
    return held.select(
        "sequence_id", F.aggregate("held", F.lit(0).cast("bigint"), lambda n, x: n + x["length"]).alias("n_tokens"),
        F.aggregate("held", F.lit(b""), lambda out, x: F.concat(out, x["ids"])).alias("ids"),
        F.col("held.doc_id").alias("doc_ids"), F.col("held.length").alias("lengths"),
    )
