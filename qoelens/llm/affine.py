"""The monoid of maps x -> m x + a modulo the prime 2^61 - 1.

A sequence of items, each hashed to such a map, has their product as its
fingerprint. Products are associative, so the fingerprint of a sequence follows
from those of its parts, and as every map with m > 0 has an inverse, that of a
part follows from those of two prefixes.
"""

from __future__ import annotations

import hashlib

import numpy as np

PRIME = (1 << 61) - 1
_P, _LOW30, _LOW31 = np.uint64(PRIME), np.uint64((1 << 30) - 1), np.uint64((1 << 31) - 1)

Map = tuple[int, int]
ONE: Map = (1, 0)


def item(seed: int, *parts: str) -> Map:
    """The map of one item; its parts are kept apart by their lengths."""
    raw = [p.encode("utf-8", "surrogatepass") for p in parts]
    told = b"".join(len(r).to_bytes(8, "little") + r for r in raw)
    digest = hashlib.blake2b(told, digest_size=32, key=seed.to_bytes(8, "little")).digest()
    return 1 + int.from_bytes(digest[:16], "little") % (PRIME - 1), int.from_bytes(digest[16:], "little") % PRIME


def then(first: Map, second: Map) -> Map:
    """The product of two neighbouring parts."""
    return first[0] * second[0] % PRIME, (first[1] * second[0] + second[1]) % PRIME


def inverse(of: Map) -> Map:
    m = pow(of[0], -1, PRIME)
    return m, -of[1] * m % PRIME


def times(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Elementwise product modulo the prime; both below it."""
    x_high, x_low = x >> np.uint64(31), x & _LOW31
    y_high, y_low = y >> np.uint64(31), y & _LOW31
    middle = x_high * y_low + x_low * y_high
    # 2^61 is 1, so 2^62 is 2, and the middle part's upper bits wrap round.
    return (
        np.uint64(2) * (x_high * y_high) + x_low * y_low + (middle >> np.uint64(30)) + ((middle & _LOW30) << np.uint64(31))
    ) % _P


def each_then(first: tuple[np.ndarray, np.ndarray], second: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """``then`` for columns of maps."""
    return times(first[0], second[0]), (times(first[1], second[0]) + second[1]) % _P
