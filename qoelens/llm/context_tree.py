"""Language-model scoring by context-tree weighting over bytes.

A byte is eight binary decisions, first bit first. Every decision has its own
context tree: the contexts are the last 0 to ``CONTEXT_BYTES`` bytes as they
are, and their number grows with the corpus.

The contexts, in the order of their last byte, the one before it and so on, are
cut into fragments of a few MB of text each, so that all contexts that end alike
are neighbours. Each fragment counts its contexts and weights them bottom up; a
context that a cut goes through, at most eight for each cut, belongs to several
fragments, which hand in what they have of it. The counts are a written table.
For scoring, the contexts of the texts go to their fragments, and what these
find is added up for each text.

Each node has a Krichevsky-Trofimov estimate of its two counts, and the weighted
probability of a node is half its own estimate and half the product of its
children's. What a context predicts is the mixture over all depths with the
weights that follow from that. After learning the model is fixed: a text's
probability is that of its bytes, A-Z lower-cased, and of its end, each given
what precedes it; before the first byte everything is a line end.

The plain base is a unigram model of words with add-one smoothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import materialise
from . import textbytes as B
from .store import drop_finished

# The small tree of three folded bytes: no query uses it, a test works it out by hand.
DEPTH = 3
CLASSES = 40
CONTEXTS = CLASSES ** DEPTH
#: Coded where a text ends; no UTF-8 text has this byte.
END = 0xFF
FOLDS, HELD_OUT = 7, 2
#: Words whose counts every task has at hand; the counts of others are joined.
COMMON_WORDS = 1 << 18
#: Distinct words a task holds before it hands their counts on.
HELD_WORDS = 1 << 21

_CLASS = np.full(256, 29, dtype=np.uint32)
_CLASS[0x41:0x5B] = np.arange(26)
_CLASS[0x61:0x7B] = np.arange(26)
_CLASS[[0x20, 0x09, 0x0B, 0x0C]] = 26
_CLASS[[0x0A, 0x0D]] = 27
_CLASS[0x30:0x3A] = 28
_CLASS[0x80:] = 30 + np.arange(128) % 10


def _codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """context * 256 + byte for every byte and end of the texts, and where each text starts."""
    n = len(offsets) - 1
    starts = offsets + np.arange(n + 1)
    coded = np.full(len(data) + n, END, dtype=np.uint32)
    body = np.ones(len(coded), dtype=bool)
    body[starts[1:] - 1] = False
    coded[body] = B.LOWER[data]
    symbol = _CLASS[coded]
    symbol[~body] = 27
    context = np.zeros(len(coded), dtype=np.uint32)
    for back in range(DEPTH, 0, -1):
        # The end of the text before stands for a line end; so do the places before it.
        before = np.full(len(coded), 27, dtype=np.uint32)
        before[back:] = symbol[:-back]
        for k in range(back - 1):
            late = starts[:-1] + k
            before[late[late < starts[1:]]] = 27
        context = context * CLASSES + before
    return context * np.uint32(256) + coded, starts


def _sum_by(keys: np.ndarray, values: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys ascending, sum of the values or number)."""
    if values is None:
        ordered = np.sort(keys)
        first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(keys) else np.empty(0, np.int64)
        return ordered[first], np.diff(np.append(first, len(ordered)))
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(keys) else np.empty(0, np.int64)
    return ordered[first], np.add.reduceat(values[order], first) if len(first) else np.empty(0, np.int64)


class _Tally:
    """Counts of keys, summed up now and then so that only distinct keys are held."""

    def __init__(self, most: int):
        self.most, self.keys, self.counts, self.held = most, [], [], 0

    def add(self, keys: np.ndarray) -> None:
        keys, counts = _sum_by(keys)
        self.keys.append(keys)
        self.counts.append(counts)
        self.held += len(keys)

    def full(self) -> bool:
        """Whether there are ``most`` distinct keys; sums up when it looks like it."""
        if self.held >= self.most:
            self._sum_up()
        return self.held >= self.most

    def _sum_up(self) -> None:
        if len(self.keys) > 1:
            keys, counts = _sum_by(np.concatenate(self.keys), np.concatenate(self.counts))
            self.keys, self.counts, self.held = [keys], [counts], len(keys)

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        self._sum_up()
        keys, counts = (self.keys[0], self.counts[0]) if self.keys else (np.empty(0, np.uint64), np.empty(0, np.int64))
        self.keys, self.counts, self.held = [], [], 0
        return keys, counts


def _rows(kind: int, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys.astype(np.uint64).view(np.int64)), pa.array(counts.astype(np.int64))],
        names=["kind", "key", "n"],
    )


#: Kinds of counts: words, ends (all texts).
WORD, TEXT = 1, 2


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words, texts = _Tally(HELD_WORDS), 0
    for batch, data, offsets in B.slices(batches):
        words.add(B.words(data, offsets, lower=True)[2])
        texts += batch.num_rows
        if words.full():
            yield _rows(WORD, *words.take())
    yield _rows(WORD, *words.take())
    yield _rows(TEXT, np.zeros(1, np.uint64), np.array([texts]))


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_OUT


def tally(docs: DataFrame) -> DataFrame:
    """(kind, key, n): the counts over all texts of ``docs``, written once."""
    counts = docs.select("text").mapInArrow(_tally, "kind int, key bigint, n bigint")
    return materialise(counts.groupBy("kind", "key").agg(F.sum("n").alias("n")), "tally")


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, exact to about 1e-12 for x >= 0.5."""
    shift = np.zeros_like(x)
    y = x.astype(float).copy()
    for _ in range(8):
        small = y < 8
        shift[small] += np.log(y[small])
        y[small] += 1
    inverse = 1 / (y * y)
    series = (1 / 12 - inverse * (1 / 360 - inverse * (1 / 1260 - inverse / 1680))) / y
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - shift


def _log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of the counts."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0) - np.log(np.pi)


def _decisions(counts: np.ndarray, bit: int) -> tuple[np.ndarray, np.ndarray]:
    """How often 0 and 1 followed each prefix of ``bit`` bits; ``counts`` has 256 columns."""
    halves = counts.reshape(len(counts), 1 << bit, 2, 256 >> (bit + 1)).sum(axis=3)
    return halves[:, :, 0].astype(float), halves[:, :, 1].astype(float)


def _levels(codes: np.ndarray, counts: np.ndarray):
    """Per depth d the contexts of the last d bytes (the last byte is the lowest
    digit) with their byte counts, and for all but the deepest the parents of
    the contexts one deeper."""
    seen, row = np.unique(codes // 256, return_inverse=True)
    table = np.zeros((len(seen), 256), dtype=np.int64)
    np.add.at(table, (row, codes % 256), counts)
    levels, above = [(seen, table)], []
    for depth in range(DEPTH - 1, -1, -1):
        below, below_counts = levels[0]
        known, parent = np.unique(below % CLASSES ** depth, return_inverse=True)
        summed = np.zeros((len(known), 256), dtype=np.int64)
        np.add.at(summed, parent, below_counts)
        levels.insert(0, (known, summed))
        above.insert(0, parent)
    return levels, above


def model(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """log10 of the probability of every byte in every context, ``CONTEXTS * 256``
    of them. The trees of the eight bits are worked out one after another."""
    levels, above = _levels(codes, counts)
    every, rows = np.arange(CONTEXTS), []
    for depth, (known, _) in enumerate(levels):
        wanted = every % CLASSES ** depth
        place = np.minimum(np.searchsorted(known, wanted), max(len(known) - 1, 0))
        rows.append(np.where(known[place] == wanted, place, -1) if len(known) else np.full(CONTEXTS, -1))
    out = np.zeros((CONTEXTS, 256), dtype=np.float32)
    for bit in range(8 if len(codes) else 0):
        # Bottom up: weighted probabilities, and how far a node outweighs its children.
        one, outweigh, weighted = [], [], None
        for depth in range(DEPTH, -1, -1):
            zeros, ones = _decisions(levels[depth][1], bit)
            one.insert(0, (ones + 0.5) / (zeros + ones + 1.0))
            own = _log_kt(zeros, ones)
            if weighted is None:
                weighted = own
                continue
            product = np.zeros_like(own)
            np.add.at(product, above[depth], weighted)
            outweigh.insert(0, own - product)
            weighted = np.logaddexp(own, product) - np.log(2)
        # Top down in the order of contexts: below its last seen ancestor an unseen context predicts 1/2.
        for first in range(0, CONTEXTS, 2000):
            part = slice(first, first + 2000)
            mixed = np.full((len(every[part]), 1 << bit), 0.5)
            for depth in range(DEPTH, -1, -1):
                node = rows[depth][part]
                if depth == DEPTH:
                    new = one[depth][node]
                else:
                    lead = 1 / (1 + np.exp(-np.clip(outweigh[depth][node], -700, 700)))
                    new = lead * one[depth][node] + (1 - lead) * mixed
                mixed = np.where((node >= 0)[:, None], new, mixed)
            mixed = np.clip(mixed, 1e-12, 1 - 1e-12)
            both = np.stack([np.log10(1 - mixed), np.log10(mixed)], axis=2).reshape(len(mixed), -1)
            out[part] += np.repeat(both, 256 >> (bit + 1), axis=1)
    if not len(codes):
        out += 8 * np.log10(0.5)
    return out.ravel()


#: Bytes of context, unfolded: with the coded byte they fill a 64-bit key.
CONTEXT_BYTES = 7
#: Bytes of text between two sampled contexts, and sampled contexts a fragment of the model has.
SAMPLE_STEP, FRAGMENT_SAMPLES = 1 << 18, 24
BILLION = 10 ** 9
#: Bytes of text whose postings are made together: the more, the fewer keys in all.
POSTINGS_SLICE = 9 << 20
#: Distinct keys a task holds before it hands their counts on.
HELD_KEYS = 1 << 21
#: Coded bytes of a slice, about, whose postings are put in order together.
POSTINGS_PART = 1 << 20
_LINE_ENDS = 0x0A0A0A0A0A0A0A00


def _keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last seven bytes, the last one highest, and the byte itself as one
    64-bit key, for every byte and end of the texts; and where each text starts."""
    n = len(offsets) - 1
    starts = offsets + np.arange(n + 1)
    coded = np.full(len(data) + n, END, dtype=np.uint8)
    body = np.ones(len(coded), dtype=bool)
    body[starts[1:] - 1] = False
    coded[body] = B.LOWER[data]
    # The eight symbols before a byte, read as one number, and the byte in place of the first of them.
    symbol = np.full(8 + len(coded), 0x0A, dtype=np.uint8)
    symbol[8:][body] = coded[body]
    keys = np.ndarray(len(coded), "<u8", symbol, strides=(1,)) & ~np.uint64(0xFF)
    keys |= coded
    for k in range(CONTEXT_BYTES):
        late = starts[:-1] + k
        late = late[late < starts[1:]]
        own = ((1 << 8 * k) - 1) << 64 - 8 * k | 0xFF
        keys[late] = keys[late] & np.uint64(own) | np.uint64(_LINE_ENDS & ~own)
    return keys, starts


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers, compressed: their lowest bytes, the next ones and so on, as many as the largest needs."""
    width = (int(values.max()).bit_length() + 7) // 8 if len(values) else 0
    held = values.astype(np.uint64).view(np.uint8).reshape(-1, 8)
    planes = b"".join(held[:, k].tobytes() for k in range(width))
    return len(values).to_bytes(7, "little") + bytes([width]) + pa.Codec("zstd", 1).compress(planes, asbytes=True)


def _unpacked(raw: bytes) -> np.ndarray:
    n, width = int.from_bytes(raw[:7], "little"), raw[7]
    planes = np.frombuffer(pa.Codec("zstd", 1).decompress(raw[8:], width * n, asbytes=True), np.uint8).reshape(width, n)
    out = np.zeros((n, 8), np.uint8)
    for k in range(width):
        out[:, k] = planes[k]
    return out.view(np.uint64).ravel()


def _packed_keys(keys: np.ndarray) -> bytes:
    """Ascending keys, compressed."""
    return _packed(np.diff(keys, prepend=np.uint64(0)))


def _unpacked_keys(raw: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(raw), dtype=np.uint64)


def _sampled(step: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = step // 2
        for _, data, _ in B.slices(batches):
            places = np.arange(at, len(data), step)
            at += len(places) * step - len(data)
            found = np.zeros(len(places), np.uint64)
            for back in range(1, CONTEXT_BYTES + 1) if len(places) else ():
                found |= B.LOWER[data[np.maximum(places - back, 0)]].astype(np.uint64) << np.uint64(64 - 8 * back)
            yield pa.record_batch([pa.array(found.view(np.int64))], names=["key"])

    return run


def fragment_splits(docs: DataFrame) -> np.ndarray:
    """The first keys of all fragments of the model but the first one. There is
    one for every few MB of text, and each gets about as many bytes to score."""
    rows = docs.select("text").mapInArrow(_sampled(SAMPLE_STEP), "key bigint").toArrow()  # one for every 256 KB of text
    found = np.sort(rows.column("key").to_numpy().view(np.uint64))
    return np.unique(found[FRAGMENT_SAMPLES::FRAGMENT_SAMPLES])


def _fragment_bounds(splits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Where the keys of each fragment start among ascending keys, and where the last one's end."""
    return np.concatenate([[0], np.searchsorted(keys, splits), [len(keys)]]).astype(np.int64)


_COUNTED = "fragment bigint, keys binary, counts binary"


def _count_contexts(splits: np.ndarray):
    def rows(tally: _Tally) -> pa.RecordBatch:
        keys, counts = tally.take()
        bounds = _fragment_bounds(splits, keys)
        some = np.flatnonzero(np.diff(bounds))
        cut = [(bounds[f], bounds[f + 1]) for f in some]
        return pa.record_batch(
            [
                pa.array(some), pa.array([_packed_keys(keys[a:b]) for a, b in cut], pa.binary()),
                pa.array([_packed(counts[a:b]) for a, b in cut], pa.binary()),
            ],
            names=["fragment", "keys", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coded = _Tally(HELD_KEYS)
        for _, data, offsets in B.slices(batches):
            coded.add(_keys(data, offsets)[0])
            if coded.full():
                yield rows(coded)
        yield rows(coded)

    return run


def _at_depth(keys: np.ndarray, depth: int) -> np.ndarray:
    """Keys with the last ``depth`` bytes of context only."""
    byte = keys & np.uint64(0xFF)
    return keys >> np.uint64(64 - 8 * depth) << np.uint64(8) | byte if depth else byte


class _Tree:
    """One fragment of the model, or what several fragments share.

    ``levels[d]`` has the distinct keys of depth ``d`` and their counts. A
    context that a split stands in belongs to several fragments: its counts are
    the whole ones, and ``known[d, bit]`` has its nodes, how they lead over
    their children and what they estimate.
    """

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray]], shared: list[np.ndarray], known=None, below=None):
        self.levels, self.shared, self.known, self.below = levels, shared, known, below
        self.up = []
        for depth in range(CONTEXT_BYTES):
            low = levels[depth + 1][0]
            above = low >> np.uint64(16) << np.uint64(8) | low & np.uint64(0xFF)
            self.up.append(np.searchsorted(levels[depth][0], above))
        self.held = [np.isin(codes >> np.uint64(8), shared[depth]) for depth, (codes, _) in enumerate(levels)]

    def nodes(self, bit: int):
        """Per depth the nodes of the decision, bottom up worked out: (codes,
        first entry, node of each entry, estimate, lead, products of shared nodes)."""
        out, weighted, under = [], None, None
        for depth in range(CONTEXT_BYTES, -1, -1):
            codes, counts = self.levels[depth]
            group = codes >> np.uint64(8 - bit)
            new = np.append(True, group[1:] != group[:-1]) if len(group) else np.empty(0, bool)
            first, node = np.flatnonzero(new), np.cumsum(new) - 1
            total = np.bincount(node, counts, len(first))
            ones = np.bincount(node, counts * (codes >> np.uint64(7 - bit) & np.uint64(1)).astype(np.int64), len(first))
            estimate, own = (ones + 0.5) / (total + 1.0), _log_kt_of(total - ones, ones)
            held = self.held[depth][first]
            product = np.zeros(len(first))
            if weighted is not None:
                parent = node[self.up[depth][under[0]]]
                # What the driver adds up may not be counted in by every fragment that shares it.
                mine = ~under[1] if self.below is None else np.ones(len(parent), bool)
                product += np.bincount(parent[mine], weighted[mine], len(first))
            if self.below is not None and (depth, bit) in self.below:
                at, value = self.below[depth, bit]
                product[np.searchsorted(group[first], at)] += value
            lead = 1 / (1 + np.exp(-np.clip(own - product, -700, 700))) if depth < CONTEXT_BYTES else np.ones(len(first))
            if self.known is not None and held.any():
                at, leads = self.known[depth, bit]
                lead[held] = leads[np.searchsorted(at, group[first][held])]
            weighted = np.logaddexp(own, product) - np.log(2) if depth < CONTEXT_BYTES else own
            under = (first, held)
            out.insert(0, (group[first], first, node, estimate, lead, product))
        return out

    def log_p(self, queries: np.ndarray) -> np.ndarray:
        """log10 of the probability of the byte of each of the ascending keys."""
        codes = self.levels[CONTEXT_BYTES][0]
        place = np.minimum(np.searchsorted(codes, queries), max(len(codes) - 1, 0))
        seen = codes[place] == queries if len(codes) else np.zeros(len(queries), bool)
        other = queries[~seen]
        of_seen, of_other = np.zeros(len(codes)), np.zeros(len(other))
        for bit in range(8):
            p, a, b = np.full(len(other), 0.5), np.zeros(0), np.ones(0)
            nodes = self.nodes(bit)
            for depth, (group, first, node, estimate, lead, _) in enumerate(nodes):
                # What a text's byte gets is a + b * what the deeper contexts predict; an unseen one predicts 1/2.
                if depth:
                    parent = nodes[depth - 1][2][self.up[depth - 1][first]]
                    a, b = a[parent], b[parent]
                else:
                    a, b = np.zeros(len(group)), np.ones(len(group))
                a, b = a + b * lead * estimate, b * (1 - lead)
                if len(other) and len(group):
                    wanted = _at_depth(other, depth) >> np.uint64(8 - bit)
                    at = np.minimum(np.searchsorted(group, wanted), len(group) - 1)
                    p = np.where(group[at] == wanted, a[at] + b[at] / 2, p)
            for total, chance, keys in ((of_seen, a[node], codes), (of_other, p, other)):
                chance = np.clip(chance, 1e-12, 1 - 1e-12)
                one = (keys >> np.uint64(7 - bit) & np.uint64(1)).astype(bool)
                total += np.log10(np.where(one, chance, 1 - chance))
        out = np.empty(len(queries))
        out[seen], out[~seen] = of_seen[place[seen]], of_other
        return out


#: Log-gamma of halves and wholes up to here is looked up.
_SMALL = 1 << 16
_GAMMA_HALF, _GAMMA_WHOLE = _log_gamma(np.arange(_SMALL) + 0.5), _log_gamma(np.arange(_SMALL) + 1.0)


def _log_kt_of(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """``_log_kt`` with small counts looked up."""
    total = zeros + ones
    small = total < _SMALL
    z, o = np.where(small, zeros, 0).astype(np.int64), np.where(small, ones, 0).astype(np.int64)
    out = _GAMMA_HALF[z] + _GAMMA_HALF[o] - _GAMMA_WHOLE[z + o] - np.log(np.pi)
    if not small.all():
        out[~small] = _log_kt(zeros[~small], ones[~small])
    return out


def _shared_contexts(splits: np.ndarray) -> list[np.ndarray]:
    """Per depth the contexts that a split stands in."""
    return [np.unique(_at_depth(splits, depth) >> np.uint64(8)) for depth in range(CONTEXT_BYTES + 1)]


def _levels_of(keys: np.ndarray, counts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    levels = [(keys, counts)]
    for _ in range(CONTEXT_BYTES):
        low = levels[0][0]
        levels.insert(0, _sum_by(low >> np.uint64(16) << np.uint64(8) | low & np.uint64(0xFF), levels[0][1]))
    return levels


def _merged(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of a fragment, from all rows of them."""
    keys, counts = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for k, n in zip(table.column("keys"), table.column("counts")):
        keys.append(_unpacked_keys(k.as_py()))
        counts.append(_unpacked(n.as_py()).astype(np.int64))
        if sum(map(len, keys[1:])) > HELD_KEYS:
            keys, counts = ([x] for x in _sum_by(np.concatenate(keys), np.concatenate(counts)))
    return _sum_by(np.concatenate(keys), np.concatenate(counts))


#: Rows of the written model. ``bit`` is -1 for the counts of a shared context's
#: keys and 0 to 7 for what its nodes have below; NULL for a fragment's own counts.
_MODEL = "fragment bigint, keys binary, counts binary, depth int, bit int, code bigint, value double"


def _fold(splits: np.ndarray):
    """A fragment's counts, and what the contexts it shares have in it."""

    def run(table: pa.Table) -> pa.Table:
        fragment = table.column("fragment")[0].as_py()
        keys, counts = _merged(table)
        tree = _Tree(_levels_of(keys, counts), _shared_contexts(splits[max(fragment - 1, 0):fragment + 1]))
        found = []
        for depth, (codes, n) in enumerate(tree.levels):
            mine = tree.held[depth]
            found.append((depth, -1, codes[mine], n[mine].astype(float)))
        for bit in range(8 if len(splits) else 0):
            for depth, (group, first, *_, product) in enumerate(tree.nodes(bit)):
                mine = tree.held[depth][first] & (depth < CONTEXT_BYTES)
                found.append((depth, bit, group[mine], product[mine]))
        n = sum(len(x[2]) for x in found)
        return pa.table(
            [
                pa.array([fragment] + [None] * n, pa.int64()), pa.array([_packed_keys(keys)] + [None] * n, pa.binary()),
                pa.array([_packed(counts)] + [None] * n, pa.binary()),
                pa.array([None] + [d for d, _, c, _ in found for _ in range(len(c))], pa.int32()),
                pa.array([None] + [b for _, b, c, _ in found for _ in range(len(c))], pa.int32()),
                pa.array([None] + np.concatenate([c for _, _, c, _ in found]).view(np.int64).tolist(), pa.int64()),
                pa.array([None] + np.concatenate([v for *_, v in found]).tolist(), pa.float64()),
            ],
            names=["fragment", "keys", "counts", "depth", "bit", "code", "value"],
        )

    return run


def _shared_model(model_rows: DataFrame, splits: np.ndarray):
    """Levels and nodes of the contexts that fragments share: at most eight for each split."""
    rows = model_rows.where("depth is not null").groupBy("depth", "bit", "code").agg(F.sum("value").alias("value")).toArrow()
    depth, bit, code, value = (rows.column(c).to_numpy() for c in ("depth", "bit", "code", "value"))
    code = code.view(np.uint64)
    order = np.argsort(code)
    depth, bit, code, value = depth[order], bit[order], code[order], value[order]

    def part(d, b):
        mine = (depth == d) & (bit == b)
        return code[mine], value[mine]

    levels = [(c, v.astype(np.int64)) for c, v in (part(d, -1) for d in range(CONTEXT_BYTES + 1))]
    below = {(d, b): part(d, b) for d in range(CONTEXT_BYTES) for b in range(8)}
    tree, known = _Tree(levels, _shared_contexts(splits), below=below), {}
    for b in range(8):
        for d, (group, _, _, _, lead, _) in enumerate(tree.nodes(b)):
            known[d, b] = group, lead
    return levels, known


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches, several as one as long as they have less than a slice of text together."""
    held, size = [], 0

    def one() -> pa.RecordBatch:
        return held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        if held and size + batch.nbytes > POSTINGS_SLICE:
            yield one()
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield one()


def _by_key(keys: np.ndarray, owners: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys ascending, where the owners of each start, and all
    owners (below ``most``), ascending for each key."""
    n = len(keys)
    width, room = max(n - 1, 1).bit_length(), max(most - 1, 1).bit_length()
    low = np.uint64((1 << width) - 1)
    # Numbers sort faster than places: the high bits of a key with its place first, then their rank with the low bits and the owner.
    high = keys & ~low
    high |= np.arange(n, dtype=np.uint64)
    high.sort()
    order = (high & low).astype(np.int64)
    high >>= np.uint64(width)
    new = np.append(True, high[1:] != high[:-1])
    high = high[new]
    if len(high).bit_length() + width + room > 64:
        order = np.lexsort((owners, keys))
        ordered = keys[order]
        first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        return ordered[first], first, owners[order]
    held = np.cumsum(new, dtype=np.uint64)
    held -= np.uint64(1)
    held <<= np.uint64(width)
    held |= keys[order] & low
    held <<= np.uint64(room)
    held |= owners[order]
    del order, new
    held.sort()
    owners = (held & np.uint64((1 << room) - 1)).astype(np.uint32)
    held >>= np.uint64(room)
    first = np.flatnonzero(np.append(True, held[1:] != held[:-1]))
    distinct = held[first]
    return high[(distinct >> np.uint64(width)).astype(np.int64)] << np.uint64(width) | distinct & low, first, owners


def _postings(splits: np.ndarray, common: Broadcast):
    """Per slice and fragment a row: distinct keys, how often each, and whose
    they are. One more row has what is known of the texts otherwise; it belongs
    to no fragment and so has a negative number of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch, data, offsets in B.slices(_joined(batches), size=POSTINGS_SLICE):
            number += 1
            # The longest texts get the smallest numbers, and most keys: small numbers take less room.
            by_length = np.argsort(-np.diff(offsets), kind="stable")
            yield _posting(-number, number, _of_texts(batch, data, offsets, by_length, *common.value), None, None)
            keys, starts = _keys(data, offsets)
            text = np.empty(batch.num_rows, dtype=np.uint32)
            text[by_length] = np.arange(batch.num_rows, dtype=np.uint32)
            owner = np.repeat(text, np.diff(starts))
            # A few fragments at a time, so that only the keys themselves are held for the whole slice.
            some = max(1, (len(splits) + 1) * POSTINGS_PART // max(len(keys), 1))
            for at in range(0, len(splits) + 1, some):
                inside = keys >= splits[at - 1] if at else np.ones(len(keys), bool)
                if at + some <= len(splits):
                    inside &= keys < splits[at + some - 1]
                part, whose = keys[inside], owner[inside]
                del inside
                if not len(part):
                    continue
                # Whose a key is, ascending for each key: first the text, then steps from text to text.
                distinct, first, whose = _by_key(part, whose, batch.num_rows)
                steps = np.diff(whose, prepend=np.uint32(0))
                steps[first] = whose[first]
                first = np.append(first, len(part))
                bounds = _fragment_bounds(splits[at:at + some - 1], distinct)
                for f in np.flatnonzero(np.diff(bounds)).tolist():
                    a, b = bounds[f], bounds[f + 1]
                    often = np.diff(first[a:b + 1])
                    yield _posting(at + f, number, _packed_keys(distinct[a:b]), _packed(often), _packed(steps[first[a]:first[b]]))

    return run


_POSTINGS = "fragment bigint, slice bigint, keys binary, often binary, owners binary"


def _posting(fragment: int, number: int, keys: bytes, often: bytes | None, owners: bytes | None) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    return pa.record_batch(
        [pa.array([x], kind) for x, kind in zip((fragment, number, keys, often, owners), kinds)],
        names=["fragment", "slice", "keys", "often", "owners"],
    )


def _score_fragment(parameters: Broadcast):
    def run(postings: pa.Table, counts: pa.Table) -> pa.Table:
        splits, shared_levels, known = parameters.value
        if not postings.num_rows:
            return _PARTIAL_ARROW.empty_table()
        fragment = postings.column("fragment")[0].as_py()
        if fragment < 0:
            return pa.table([postings.column("slice"), postings.column("owners"), postings.column("keys")], schema=_PARTIAL_ARROW)
        shared = _shared_contexts(splits[max(fragment - 1, 0):fragment + 1])
        levels = _levels_of(*_merged(counts))
        for depth in range(CONTEXT_BYTES + 1 if len(splits) else 0):
            codes, n = levels[depth]
            own = ~np.isin(codes >> np.uint64(8), shared[depth])
            whole, whole_n = shared_levels[depth]
            mine = np.isin(whole >> np.uint64(8), shared[depth])
            codes, n = np.append(codes[own], whole[mine]), np.append(n[own], whole_n[mine])
            order = np.argsort(codes)
            levels[depth] = codes[order], n[order]
        every = [_unpacked_keys(k) for k in postings.column("keys").to_pylist()]
        distinct = np.unique(np.concatenate(every))
        log_p = _Tree(levels, shared, known).log_p(distinct)
        owners, sums = [], []
        for keys, often, owner in zip(every, postings.column("often").to_pylist(), postings.column("owners").to_pylist()):
            often = _unpacked(often).astype(np.int64)
            each = np.repeat(log_p[np.searchsorted(distinct, keys)], often)
            steps = np.cumsum(_unpacked(owner).astype(np.int64))
            first = np.cumsum(often) - often
            owner = steps - np.repeat(np.append(0, steps)[first], often)
            total = np.bincount(owner, each)
            some = np.flatnonzero(np.bincount(owner))
            owners.append(_packed(some))
            # Whole billionths: whatever the order they are added up in, the sum is the same.
            sums.append(_packed(np.rint(total[some] * -BILLION).astype(np.int64)))
        return pa.table([postings.column("slice"), pa.array(owners, pa.binary()), pa.array(sums, pa.binary())], schema=_PARTIAL_ARROW)

    return run


_PARTIAL_ARROW = pa.schema([("slice", pa.int64()), ("owners", pa.binary()), ("sums", pa.binary())])


def _sum_slice(table: pa.Table) -> pa.Table:
    """The texts of a slice with their scores."""
    texts, total = None, None
    rows = sorted(zip(table.column("owners").to_pylist(), table.column("sums").to_pylist()), key=lambda row: (row[0] is not None, row))
    for owners, sums in rows:
        if owners is None:
            texts = pa.ipc.open_stream(sums).read_all()
            total = np.zeros(texts.num_rows, np.int64)
        else:
            total[_unpacked(owners).astype(np.int64)] += _unpacked(sums).astype(np.int64)
    return texts.append_column("score", pa.array(total / -BILLION))


def _of_texts(
    batch: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, order: np.ndarray, common: np.ndarray, often: np.ndarray
) -> bytes:
    """Per text, in this order, the number of coded bytes and words, and of its words what is
    known at hand; the rest to be joined. As an Arrow stream."""
    _, _, words, bounds = B.words(data, offsets, lower=True)
    place = np.minimum(np.searchsorted(common, words), max(len(common) - 1, 0))
    at_hand = common[place] == words if len(common) else np.zeros(len(words), bool)
    logs = np.append(0.0, np.cumsum(np.where(at_hand, np.log10(often[place] + 1.0) if len(common) else 0.0, 0.0)))
    met = np.append(0, np.cumsum(at_hand))
    rest = words[~at_hand].view(np.int64)
    left = bounds - met[bounds]
    found = pa.record_batch(
        [
            batch.column("doc_id"), pa.array(np.diff(offsets) + 1), pa.array(np.diff(bounds).astype(np.int64)),
            pa.array(logs[bounds[1:]] - logs[bounds[:-1]]), pa.array((met[bounds[1:]] - met[bounds[:-1]]).astype(np.int64)),
            pa.ListArray.from_arrays(pa.array(left.astype(np.int32)), pa.array(rest)),
        ],
        names=["doc_id", "n_coded", "n_words", "logs", "known", "rest"],
    )
    found = found.take(pa.array(order))
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, found.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(found)
    return out.getvalue().to_pybytes()


_SCORED = "doc_id bigint, n_coded bigint, n_words bigint, logs double, known bigint, rest array<bigint>, score double"


def _scored(docs: DataFrame, training: DataFrame, keys: np.ndarray, often: np.ndarray) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with the score that the context trees
    of ``training`` (text) give it, and its counts of words."""
    broadcast = docs.sparkSession.sparkContext.broadcast
    splits = fragment_splits(docs)
    counted = training.select("text").mapInArrow(_count_contexts(splits), _COUNTED)
    model_rows = materialise(counted.groupBy("fragment").applyInArrow(_fold(splits), _MODEL), "contexts")
    parameters = broadcast((splits, *_shared_model(model_rows, splits)))
    del counted
    drop_finished(docs.sparkSession)  # the counts' files; the postings take most of the disk
    own = model_rows.where("fragment is not null").select("fragment", "keys", "counts")
    postings = docs.select("doc_id", "text").mapInArrow(_postings(splits, broadcast((keys, often))), _POSTINGS)
    partial = postings.groupBy("fragment").cogroup(own.groupBy("fragment")).applyInArrow(
        _score_fragment(parameters), "slice bigint, owners binary, sums binary"
    )
    return partial.groupBy("slice").applyInArrow(_sum_slice, _SCORED)


def _columns(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """key and n of a bounded table, on the driver."""
    table = rows.select("key", "n").toArrow()
    return tuple(table.column(c).to_numpy().copy() for c in ("key", "n"))


def _common_from(words: DataFrame) -> int:
    """The smallest count such that at most ``COMMON_WORDS`` words have it or more."""
    step = F.floor(F.log2(F.col("n")) * 16)
    ladder = words.groupBy(step.alias("step")).agg(F.min("n").alias("n"), F.count(F.lit(1)).alias("words")).orderBy(F.desc("step"))
    have, least = 0, 1 << 62
    for row in ladder.collect():  # sixteen steps per doubling, a thousand at most
        have += row["words"]
        if have > COMMON_WORDS:
            break
        least = row["n"]
    return least


def score(docs: DataFrame, training: DataFrame) -> DataFrame:
    """Score every row of ``docs`` (doc_id, text) by what ``training`` (text) teaches.

    Returns ``doc_id, n_tokens, n_known, train_tokens, base_score, score,
    bits_per_byte``. Tokens are the words and one end per text. NULL text is
    empty: its end alone. ``score`` is the log10 probability of the text's bytes
    and end; ``bits_per_byte`` its code length per byte, the end counted as a
    byte. Without training texts every word is unknown and every bit has
    probability one half. Rows that repeat are scored alike.
    """
    counts = tally(training)
    words = counts.where(F.col("kind") == WORD).select("key", "n")
    n_words, vocabulary = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    texts = counts.where(F.col("kind") == TEXT).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    tokens, types = n_words + texts, vocabulary + (texts > 0)
    keys, often = _columns(words.where(F.col("n") >= _common_from(words)))
    order = np.argsort(keys.view(np.uint64))
    keys, often = keys.view(np.uint64)[order], often[order].astype(np.float64)
    scored = materialise(_scored(docs, training, keys, often).withColumn("row", F.monotonically_increasing_id()), "scores")
    rare = (
        scored.select("row", F.explode("rest").alias("key"))
        .groupBy("row", "key").agg(F.count(F.lit(1)).alias("tf"))
        .join(words, "key")
        .groupBy("row").agg(F.sum(F.col("tf") * F.log10(F.col("n") + 1.0)).alias("more_logs"), F.sum("tf").alias("more_known"))
    )
    smoothing = F.log10(F.lit(float(tokens) + float(types + 1)))
    n_tokens = F.col("n_words") + 1
    end_log = F.log10(F.lit(float(texts) + 1.0))
    return scored.join(rare, "row", "left").select(
        "doc_id", n_tokens.alias("n_tokens"),
        (F.col("known") + F.coalesce("more_known", F.lit(0)) + int(texts > 0)).alias("n_known"),
        F.lit(int(tokens)).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) + end_log - n_tokens * smoothing).alias("base_score"),
        "score", (-F.col("score") / F.log10(F.lit(2.0)) / F.col("n_coded")).alias("bits_per_byte"),
    )


def learn_and_score(docs: DataFrame) -> DataFrame:
    """Learn from the documents that are not held out and score all, with ``held_out``."""
    found = score(docs, docs.where(~held_out()))
    return found.withColumn("held_out", held_out())
