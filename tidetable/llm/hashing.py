"""Vectorised polynomial hashes over bytes, modulo 2^64.

The hash of bytes ``a`` to ``b`` is ``sum(c[i] * BASE**(i-a))``: a difference of prefix sums times an inverse power, so
any stretch of any text costs one subtraction and one product once the prefix sums are there.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1


@lru_cache(maxsize=1)
def _grown(bits: int) -> tuple[np.ndarray, np.ndarray]:
    both = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        steps = np.full(1 << bits, base, np.uint64)
        steps[0] = 1
        both.append(np.multiply.accumulate(steps))
    return both[0], both[1]


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, up to ``size`` of each at least."""
    return _grown(max(16, int(size).bit_length()))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Prefix sums of ``(byte + 1) * BASE**place``; one more entry than bytes."""
    up, _ = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return sums


def stretch(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the bytes from ``begin`` to ``end``."""
    _, down = powers(len(sums))
    return (sums[end] - sums[begin]) * down[begin]


def mixed(values: np.ndarray, round_key: int = 0) -> np.ndarray:
    """Every bit of the result depends on every bit of a value; a bijection for each key."""
    x = values + np.uint64(round_key)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))
