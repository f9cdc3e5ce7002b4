"""Words, lines and their 64-bit hashes straight from the bytes of an Arrow text column.

Every function takes the concatenated UTF-8 bytes of some documents (``data``)
and their ``offsets`` and works on all of them at once. A word is a run of
bytes other than space and 0x09-0x0D, as in ``[^\\x20\\x09-\\x0D]+``; UTF-8
keeps those bytes out of longer characters.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from . import affine

#: Bytes of text handled at once; a longer document is a slice of its own.
SLICE = 4 << 20
#: The same where every byte of a slice has a dozen numbers at work and other operators' workers live on beside it.
SMALL_SLICE = 1 << 20
#: Bytes hashed at once, cut between words.
PIECE = 1 << 17
#: Bytes of a run up to which sums of digits (below 2^9) times halves of powers (below 2^31) stay below 2^64.
LONGEST = 1 << 23
SHINGLE = 5

_rng = np.random.Generator(np.random.PCG64(20240607))
#: Words are polynomials of their bytes modulo a prime; modulo a power of two some long words would collide for any base.
_BASE = int(_rng.integers(1 << 40, affine.PRIME))
_LOW, _HIGH = np.uint64((1 << 31) - 1), np.uint64(31)
_SPREAD = _rng.integers(1, 1 << 63, SHINGLE + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole word (in place)."""
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(data, offsets) of a string array; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, wide, len(column) + 1 + column.offset)[column.offset:].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(
    batches: Iterator[pa.RecordBatch], inside: str | None = None, size: int = SLICE
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Pieces of the batches with about ``size`` bytes of ``text`` each, so that
    memory is bounded by that and the longest document. ``inside`` names the
    struct column that holds ``text``, if one does."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offsets = text_bytes(pc.struct_field(batch.column(inside), "text") if inside else batch.column("text"))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first), data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
            first = last
    give_back()


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return freed memory to the system: workers live on after their task, also
    beside those of later stages, and would keep what their largest slice took."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(1, dtype=np.uint64)
    while len(out) < n:
        out = np.append(out, affine.times(out, np.full(len(out), pow(base, len(out), affine.PRIME), np.uint64)))
    return out[:n]


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Powers, in two halves, and inverse powers for ``n`` positions; only a word
    longer than a piece needs more than the stored ones."""
    if n <= PIECE:
        low, high, down = _POWERS
        return low[:n], high[:n], down[:n]
    up = _powers(_BASE, n)
    return up & _LOW, up >> _HIGH, _powers(pow(_BASE, -1, affine.PRIME), n)


_UP = _powers(_BASE, PIECE)
_POWERS = (_UP & _LOW, _UP >> _HIGH, _powers(pow(_BASE, -1, affine.PRIME), PIECE))


def _polynomials(digits: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each run: digits times powers, the two halves of a power added up apart so that no sum wraps."""
    low, high, down = _power_table(len(digits))
    low_sum = np.add.reduceat(digits * low, starts) % np.uint64(affine.PRIME)
    high_sum = np.add.reduceat(digits * high, starts) % np.uint64(affine.PRIME)
    raised = affine.times(high_sum, np.full(len(starts), 1 << 31, np.uint64))
    out = affine.times((low_sum + raised) % np.uint64(affine.PRIME), down[starts])
    for k in np.flatnonzero(ends - starts > LONGEST).tolist():  # here a sum could wrap
        raw = digits[starts[k]:ends[k]].astype("<u2").tobytes()
        out[k] = int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little") % affine.PRIME
    return out


def runs(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray, table: np.ndarray):
    """Starts, ends and hashes of the maximal runs without separators; a run
    never crosses a document."""
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    starts, ends, hashes = [], [], []
    lo = 0
    while lo < len(data):
        hi = min(lo + PIECE, len(data))
        while hi < len(data):
            cut = np.flatnonzero(separator[data[lo:hi]] | edge[lo + 1:hi + 1])
            if len(cut):
                hi = lo + int(cut[-1]) + 1
                break
            hi = min(lo + 2 * (hi - lo), len(data))
        piece = data[lo:hi]
        inside = ~separator[piece]
        begin = inside.copy()
        begin[1:] &= ~inside[:-1] | edge[lo + 1:hi]
        finish = inside.copy()
        finish[:-1] &= ~inside[1:] | edge[lo + 1:hi]
        s = np.flatnonzero(begin)
        if len(s):
            e = np.flatnonzero(finish) + 1
            hashes.append(_polynomials(table[piece], s, e))
            starts.append(s + lo)
            ends.append(e + lo)
        lo = hi
    if not starts:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(starts), np.concatenate(ends), mix(np.concatenate(hashes))


def hash_table(separator: np.ndarray, lower: bool) -> np.ndarray:
    """The digit of every byte; separators have none."""
    table = np.arange(1, 257, dtype=np.uint64)
    table = table[LOWER] if lower else table
    table[separator] = 0
    return table


_IS_NEWLINE = np.zeros(256, dtype=bool)
_IS_NEWLINE[0x0A] = True
_WORD_TABLES = {lower: hash_table(IS_SPACE, lower) for lower in (False, True)}
_LINE_TABLE = hash_table(_IS_NEWLINE, False)


def words(data: np.ndarray, offsets: np.ndarray, lower: bool):
    """(starts, ends, hashes) of all words and ``bounds``: document i has the
    words ``bounds[i]:bounds[i + 1]``. ``lower`` folds A-Z."""
    s, e, h = runs(data, offsets, IS_SPACE, _WORD_TABLES[lower])
    return s, e, h, np.searchsorted(s, offsets)


def lines(data: np.ndarray, offsets: np.ndarray):
    """The same for non-empty ``\\n``-split lines."""
    s, e, h = runs(data, offsets, _IS_NEWLINE, _LINE_TABLE)
    return s, e, h, np.searchsorted(s, offsets)


def windows(hashes: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hash of every run of ``size`` neighbouring word hashes, also across documents."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        out += hashes[k:k + n] * _SPREAD[k]
    return mix(out)


def shingle_sets(hashes: np.ndarray, bounds: np.ndarray, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingles of every document; a document with fewer than
    ``size`` words has one, its whole sequence, and one without words none."""
    grams = windows(hashes, size)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= size:
            have = np.sort(grams[a:b - size + 1])
            keep = np.empty(len(have), dtype=bool)
            keep[0] = True
            np.not_equal(have[1:], have[:-1], out=keep[1:])
            out.append(have if keep.all() else have[keep])
        elif b > a:
            parts = np.append(hashes[a:b] * _SPREAD[:b - a], np.array([b - a], np.uint64) * _SPREAD[size])
            out.append(mix(parts.sum(dtype=np.uint64, keepdims=True)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def per_document(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of a per-byte flag or number within each document."""
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]
