"""Quality rules by weak supervision.

Each rule reads a few counts of a document and votes *good*, *bad* or abstains.
No rule decides alone: expectation-maximisation over the whole corpus estimates
how often each rule is right on good and on bad documents, and a document is
kept when the posterior probability of *good*, given all its votes, is at least
one half. The votes of a document are one of at most 3^12 patterns, so pattern
counts over all documents are all that the estimation needs.

Two base tests come before the votes and are final: fewer than ``MIN_WORDS``
words, or too many words in repeated five-word windows.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.skew import materialise
from . import textbytes as B

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

#: name: (good when, bad when); neither: the rule abstains. In Spark SQL over the counts.
RULES: dict[str, tuple[str, str]] = {
    "word_length": ("word_chars between 3 * n_words and 10 * n_words", "word_chars < 2 * n_words or word_chars > 16 * n_words"),
    "symbols": ("50 * n_symbols <= n_words", "10 * n_symbols >= n_words"),
    "tails": ("20 * n_tails <= n_words", "5 * n_tails >= n_words"),
    "bare": ("20 * n_bare <= n_words", "5 * n_bare >= n_words"),
    "doubled": ("50 * n_doubled <= n_words", "5 * n_doubled >= n_words"),
    "repeated_words": ("20 * n_repeat_words <= n_words", "100 * n_repeat_words > 20 * n_words"),
    "repeated_lines": ("n_lines > 1 and 10 * n_dup_lines <= n_lines", "10 * n_dup_lines > 3 * n_lines"),
    "capitals": ("5 * n_upper <= n_letters", "2 * n_upper >= n_letters and n_letters > 0"),
    "letters": ("10 * (n_letters + n_wide) >= 8 * word_chars", "10 * (n_letters + n_wide) < 6 * word_chars"),
    "shouting": ("20 * n_exclaim <= n_words", "5 * n_exclaim >= n_words"),
    "stops": ("200 * n_stops >= n_words and 2 * n_stops <= n_words", "n_words >= 50 and (n_stops = 0 or n_stops > n_words)"),
    "variety": ("5 * n_distinct >= n_words", "12 * n_distinct < n_words"),
}

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_lines", "n_distinct", "n_upper", "n_letters", "n_wide", "n_exclaim", "n_stops", "n_tails", "n_bare", "n_doubled")

_SYMBOLS, _UPPER, _LETTERS, _WIDE, _EXCLAIM, _STOPS, _CHARS = range(7)


def _byte_classes() -> np.ndarray:
    table = np.zeros((256, 7), dtype=np.int64)
    table[[ord(c) for c in "#*$%&|<>"], _SYMBOLS] = 1
    table[0x41:0x5B, _UPPER] = 1
    table[0x41:0x5B, _LETTERS] = 1
    table[0x61:0x7B, _LETTERS] = 1
    table[0xC0:, _WIDE] = 1  # one leading byte per character beyond ASCII
    table[ord("!"), _EXCLAIM] = 1
    table[[ord(c) for c in ".,;:?"], _STOPS] = 1
    table[:0x80, _CHARS] = ~B.IS_SPACE[:0x80]
    table[0xC0:, _CHARS] = 1
    return table


_CLASSES = _byte_classes()
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: A word may well end in one of these.
_ENDS = _ALNUM.copy()
_ENDS[[ord(c) for c in ".,;:!?\"')]}"]] = True


def _histograms(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of the byte classes per document."""
    out = np.empty((len(offsets) - 1, 256), dtype=np.int64)
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        out[i] = np.bincount(data[a:b], minlength=256)
    return out @ _CLASSES


def _repeated_words(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Words in five-word windows that occur twice or more in their document."""
    grams = B.windows(hashes)
    out = np.zeros(len(bounds) - 1, dtype=np.int64)
    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        if b - a <= B.SHINGLE:
            continue
        own = grams[a:b - B.SHINGLE + 1]
        ordered = np.sort(own)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        if len(twice):
            start = np.flatnonzero(np.isin(own, twice))
            cover = np.zeros(b - a + 1, dtype=np.int64)
            cover[start] += 1
            cover[start + B.SHINGLE] -= 1
            out[i] = np.count_nonzero(np.cumsum(cover[:-1]))
    return out


def _distinct(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    out = np.zeros(len(bounds) - 1, dtype=np.int64)
    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        if b > a:
            own = np.sort(hashes[a:b])
            out[i] = 1 + np.count_nonzero(own[1:] != own[:-1])
    return out


def counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """All counts the rules read, per document."""
    starts, ends, hashes, bounds = B.words(data, offsets, lower=False)
    alnum = _ALNUM[data]
    known = np.append(0, np.cumsum(alnum))
    same = np.zeros(len(data), dtype=bool)
    same[1:] = (data[1:] == data[:-1]) & ~alnum[1:] & ~B.IS_SPACE[data[1:]]
    same[offsets[:-1][offsets[:-1] < len(data)]] = False  # what precedes a document is not its own
    tails = np.append(0, np.cumsum(~_ENDS[data[ends - 1]]))
    bare = np.append(0, np.cumsum(known[ends] == known[starts]))
    line_starts, line_ends, line_hashes, line_bounds = B.lines(data, offsets)
    filled = np.searchsorted(starts, line_starts) < np.searchsorted(starts, line_ends)
    filled_bounds = np.append(0, np.cumsum(filled))[line_bounds]
    n_lines = np.diff(filled_bounds)
    classes = _histograms(data, offsets)
    return {
        "n_words": np.diff(bounds),
        "word_chars": classes[:, _CHARS],
        "n_symbols": classes[:, _SYMBOLS],
        "n_dup_lines": n_lines - _distinct(line_hashes[filled], filled_bounds),
        "n_repeat_words": _repeated_words(hashes, bounds),
        "n_lines": n_lines,
        "n_distinct": _distinct(hashes, bounds),
        "n_upper": classes[:, _UPPER],
        "n_letters": classes[:, _LETTERS],
        "n_wide": classes[:, _WIDE],
        "n_exclaim": classes[:, _EXCLAIM],
        "n_stops": classes[:, _STOPS],
        "n_tails": np.diff(tails[bounds]),
        "n_bare": np.diff(bare[bounds]),
        "n_doubled": B.per_document(same, offsets),
    }


def _add_counts(batches: Iterator[pa.RecordBatch], inside: str | None = None) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in B.slices(batches, inside, B.SMALL_SLICE):
        found = counts(data, offsets)
        yield pa.record_batch(
            [batch.column("row"), *(pa.array(found[c].astype(np.int64)) for c in BASE + MORE)],
            names=["row", *BASE, *MORE],
        )


def _add_counts_to_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _add_counts(batches, "row")


def with_counts(docs: DataFrame, *columns: str) -> DataFrame:
    """Rows as a struct ``row`` (of all or the given columns, so that no name can clash) and their counts."""
    rows = docs.select(F.struct(*(columns or ["*"])).alias("row"), *(["text"] if columns else []))
    schema = T.StructType([rows.schema["row"], *(T.StructField(c, T.LongType()) for c in BASE + MORE)])
    return rows.mapInArrow(_add_counts if columns else _add_counts_to_rows, schema)


def votes() -> dict[str, Column]:
    """1 good, -1 bad, 0 abstains."""
    return {name: F.when(F.expr(bad), -1).when(F.expr(good), 1).otherwise(0) for name, (good, bad) in RULES.items()}


def _pattern() -> Column:
    """The votes as one whole number below 3^12, a digit each."""
    code = F.lit(0)
    for vote in votes().values():
        code = code * 3 + vote + 1
    return code.cast("long")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


@dataclass(frozen=True)
class Model:
    """Share of good documents and, per rule, how often its vote is right on
    good and on bad documents when it votes."""

    prior: float
    right_on_good: Mapping[str, float]
    right_on_bad: Mapping[str, float]

    def logit(self) -> Column:
        """Log odds of *good* given the votes."""
        total = F.lit(float(np.log(self.prior / (1 - self.prior))))
        for name, vote in votes().items():
            good, bad = self.right_on_good[name], self.right_on_bad[name]
            total = total + F.when(vote == 1, float(np.log(good / (1 - bad)))).when(
                vote == -1, float(np.log((1 - good) / bad))
            ).otherwise(0.0)
        return total

    def probability(self) -> Column:
        return 1 / (1 + F.exp(-self.logit()))


def estimate(patterns: Mapping[int, int], rounds: int = 200, tolerance: float = 1e-10) -> Model:
    """Expectation-maximisation over counts of vote patterns.

    Rules start out 95 % right on good and 50 % right on bad documents, of which
    a tenth is bad. A bad document may please most rules, so accuracy on bad ones
    can be low, but never so low that a rule would mean the opposite of what it
    says. The share of good documents stays within 0.5 and 0.99. Without
    documents the starting values remain.
    """
    names = list(RULES)
    codes = np.array(sorted(patterns), dtype=np.int64)
    weight = np.array([patterns[c] for c in codes.tolist()], dtype=float)
    digits = np.stack([codes // 3 ** (len(names) - 1 - j) % 3 - 1 for j in range(len(names))], axis=1) if len(codes) else None
    prior, good, bad = 0.9, np.full(len(names), 0.95), np.full(len(names), 0.5)
    for _ in range(rounds if len(codes) else 0):
        up, down = digits == 1, digits == -1
        odds = np.log(prior / (1 - prior)) + up @ np.log(good / (1 - bad)) + down @ np.log((1 - good) / bad)
        posterior = 1 / (1 + np.exp(-odds))
        is_good, is_bad = weight * posterior, weight * (1 - posterior)
        new_prior = np.clip(is_good.sum() / weight.sum(), 0.5, 0.99)
        new_good = np.clip((is_good @ up + 0.95) / (is_good @ (up | down) + 1), 0.55, 0.999)
        new_bad = np.clip((is_bad @ down + 0.5) / (is_bad @ (up | down) + 1), 1 - new_good, 0.999)
        change = max(abs(new_prior - prior), np.abs(new_good - good).max(), np.abs(new_bad - bad).max())
        prior, good, bad = float(new_prior), new_good, new_bad
        if change < tolerance:
            break
    return Model(prior, dict(zip(names, good.tolist())), dict(zip(names, bad.tolist())))


def fit(counted: DataFrame) -> Model:
    """The model of a counted corpus. Documents that fail a base test are decided already and left out."""
    rows = counted.where(~base_failed()).groupBy(_pattern().alias("pattern")).count().collect()  # at most 3^12 rows
    return estimate({r["pattern"]: r["count"] for r in rows})


def verdicts(docs: DataFrame) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed``, ``p_good`` and ``kept`` per row of ``docs``.

    NULL and empty texts have no words and fail the base test; rows that
    repeat are judged alike; an empty table gives no rows.
    """
    counted = materialise(with_counts(docs, "doc_id"), "counts")
    model = fit(counted)
    return counted.select(
        "row.doc_id", *BASE, base_failed().alias("base_failed"), F.round(model.probability(), 9).alias("p_good"),
        (~base_failed() & (model.logit() >= 0)).alias("kept"),
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that :func:`verdicts` keeps, with their columns. The
    text is counted again rather than shuffled to its verdict."""
    patterns = with_counts(docs, "doc_id")
    model = fit(patterns)
    return with_counts(docs).where(~base_failed() & (model.logit() >= 0)).select("row.*")
