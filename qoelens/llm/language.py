"""Language identification by rank-order profiles.

A language's profile is its ``PROFILE`` most frequent n-grams in order, a
document's the same of its own text. The out-of-place distance sums, over the
document's n-grams, how far apart the two ranks are; an n-gram that a language
does not list counts the most. The nearest language wins.

N-grams are one to three bytes of UTF-8, folded to 64 symbols: a blank for
every ASCII character that is no letter, the 26 letters in either case, and 37
symbols for the bytes of other characters. So there are at most 64 + 64^2 + 64^3
n-grams, whatever the languages.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import textbytes as B

#: Ranks of a profile.
PROFILE = 400
UNKNOWN = "und"
#: Every how manieth document is held out of learning, by crc32 of its id.
FOLDS, HELD_OUT = 5, 0

_SYMBOL = np.zeros(256, dtype=np.uint32)
_SYMBOL[0x41:0x5B] = np.arange(1, 27)
_SYMBOL[0x61:0x7B] = np.arange(1, 27)
_SYMBOL[0x80:] = 27 + np.arange(128) % 37
#: Codes of one, two and three symbols start here.
_START = (0, 64, 64 + 4096)
CODES = 64 + 4096 + 262144


def _ngrams(data: np.ndarray) -> np.ndarray:
    """Codes of all n-grams of one text, blanks at both ends; blanks alone are none."""
    symbols = np.zeros(len(data) + 2, dtype=np.uint32)
    symbols[1:-1] = _SYMBOL[data]
    # A run of blanks is one blank.
    symbols = symbols[np.append(True, (symbols[1:] != 0) | (symbols[:-1] != 0))]
    pairs = symbols[:-1] << np.uint32(6) | symbols[1:]
    triples = pairs[:-1] << np.uint32(6) | symbols[2:]
    return np.concatenate([symbols[symbols != 0], _START[1] + pairs, _START[2] + triples])


def _counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct codes ascending, how often)."""
    ordered = np.sort(codes)
    first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])[:len(codes)])
    return ordered[first], np.diff(np.append(first, len(ordered)))


def _ranked(codes: np.ndarray, often: np.ndarray, most: int) -> np.ndarray:
    """The most frequent codes, ties by code."""
    return codes[np.argsort(-often, kind="stable")[:most]]


def _has_letter(data: np.ndarray) -> bool:
    letters = _SYMBOL[data]
    if ((letters > 0) & (letters < 27)).any():
        return True
    return bool((data >= 0x80).any()) and any(c.isalpha() for c in data.tobytes().decode())


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task and language, how often each n-gram occurs."""
    totals: dict[str, np.ndarray] = {}
    for batch, data, offsets in B.slices(batches):
        for lang, a, b in zip(batch.column("lang").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
            if b > a:
                if lang not in totals:
                    totals[lang] = np.zeros(CODES, dtype=np.int64)
                codes, often = _counted(_ngrams(data[a:b]))
                totals[lang][codes] += often
    for lang, often in totals.items():
        codes = np.flatnonzero(often)
        yield pa.record_batch(
            [pa.array([lang] * len(codes), pa.string()), pa.array(codes.astype(np.int32)), pa.array(often[codes])],
            names=["lang", "code", "n"],
        )


def held_out() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_OUT


def learn(labelled: DataFrame, profile: int = PROFILE) -> dict[str, list[int]]:
    """The profile of every language in ``labelled`` (text, lang), counted over
    all of it. What comes to the driver is ``profile`` codes per language."""
    counts = labelled.where("lang is not null and text is not null").select("text", "lang").mapInArrow(
        _count_batches, "lang string, code int, n bigint"
    )
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    ranked = counts.groupBy("lang", "code").agg(F.sum("n").alias("n")).withColumn("rank", F.row_number().over(best))
    out: dict[str, list[int]] = {}
    for row in ranked.where(F.col("rank") <= profile).orderBy("lang", "rank").collect():
        out.setdefault(row["lang"], []).append(row["code"])
    return out


def _predict(profiles: Mapping[str, list[int]], most: int):
    names = sorted(profiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # place[l, code]: the code's rank in language l; ``most`` where it has none.
        place = np.full((len(names), CODES), most, dtype=np.int32)
        for i, name in enumerate(names):
            place[i, profiles[name]] = np.arange(len(profiles[name]))
        for batch, data, offsets in B.slices(batches):
            found, scores = [], []
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                text = data[a:b]
                if b == a or not names or not _has_letter(text):
                    found.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                own = _ranked(*_counted(_ngrams(text)), most)
                theirs = place[:, own]
                off = np.where(theirs == most, most, np.abs(theirs - np.arange(len(own))))
                distance = off.sum(axis=1)
                best = int(np.argmin(distance))
                found.append(names[best])
                scores.append(1.0 - float(distance[best]) / (most * len(own)))
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(found, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return run


def identify(docs: DataFrame, profiles: Mapping[str, list[int]], profile: int = PROFILE) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` per row of ``docs`` (doc_id, text).

    ``lang_pred`` is the nearest language (of equally near ones the first by
    name), ``und`` for NULL text, text without any letter, or when no language
    was learned. ``score`` is one less the distance as a share of the largest
    possible, 0 for ``und``. ``held_out`` is by crc32 of the doc_id; NULL
    doc_id gives NULL.
    """
    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(
        _predict(profiles, profile), "doc_id bigint, held_out boolean, lang_pred string, score double"
    )


def learn_and_identify(docs: DataFrame) -> DataFrame:
    """Learn from the documents that are not held out and name every document's language."""
    return identify(docs, learn(docs.where(~held_out())))
