"""Word shingles of texts as sorted sets of 64-bit fingerprints, computed over Arrow buffers with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SHINGLE_WORDS = 5
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_CODE = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 2**64)
#: Powers kept for texts of usual length; those for longer ones go with the call.
KEPT_POWERS = (2 << 20) + 2
_powers: list[list[np.ndarray]] = []


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> list[np.ndarray]:
    if n <= KEPT_POWERS and _powers and len(_powers[0][0]) >= n:
        return _powers[0]
    found = []
    for base in (_BASE, _BACK):
        steps = np.full(max(1, n), base, np.uint64)
        steps[0] = 1
        found.append(np.cumprod(steps, dtype=np.uint64))
    if n <= KEPT_POWERS:
        _powers[:] = [found]
    return found


def word_bounds(data: np.ndarray, off: np.ndarray, space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes that are not `space`; no run crosses a text's end."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~space[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cut = off[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    first[cut] = inside[cut]
    last[cut - 1] = inside[cut - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def word_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of words, equal for equal bytes wherever they stand."""
    up, down = _power(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_CODE[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_sets(data: np.ndarray, off: np.ndarray, words: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """For each text, its distinct shingles in ascending order; a text of fewer words, but not none, is one shingle."""
    data = _LOWER[data]
    starts, ends = word_bounds(data, off, _SPACE)
    codes = word_codes(data, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    at = np.searchsorted(starts, off)
    n = max(0, len(codes) - words + 1)
    rolled = np.zeros(n, np.uint64)
    for j in range(words):
        rolled = rolled * np.uint64(0xD6E8FEB86659FD93) + codes[j : j + n]
    rolled = mix(rolled + np.uint64(words))
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= words:
            found = np.sort(rolled[a : b - words + 1])
            keep = np.empty(len(found), bool)
            keep[0] = True
            np.not_equal(found[1:], found[:-1], out=keep[1:])
            yield found[keep]
        elif b > a:
            one = np.zeros(1, np.uint64)
            for c in codes[a:b]:
                one = one * np.uint64(0xD6E8FEB86659FD93) + c
            yield mix(one + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)
