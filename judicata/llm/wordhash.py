"""Word and gram hashes of many texts at once, in numpy.

Hashes only steer candidate search and sharding; every user compares words or
exact sets afterwards, or states the width it relies on."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS["up"]) < n:
        size = max(n + (n >> 2), 1 << 18)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"], _POWERS["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Words:
    """Words of a list of UTF-8 texts: 64-bit hash, first byte, end and document of each."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        self.data = b"\n".join(texts) + b"\n"
        raw = np.frombuffer(self.data, dtype=np.uint8)
        if lower:
            raw = _LOWER[raw]
        space = np.concatenate(([True], _SPACE[raw]))
        edge = space[1:] != space[:-1]
        at = np.flatnonzero(edge)
        self.start, self.end = at[0::2], at[1::2]
        up, down = _powers(len(raw))
        total = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum(raw.astype(np.uint64) * up[:len(raw)], out=total[1:])
        poly = (total[self.end] - total[self.start]) * down[self.start]
        self.hash = mix(poly + (self.end - self.start).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        ends = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, dtype=np.int64)
        self.doc = np.searchsorted(ends, self.start, side="right")
        #: index of the first word of every text, and the number of words at the end
        self.first = np.searchsorted(self.doc, np.arange(len(texts) + 1))

    def grams(self, k: int) -> np.ndarray:
        """Hash of the k words from each word on (also across texts; callers mask those)."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        g = np.zeros(n, dtype=np.uint64)
        for j in range(k):
            g = g * np.uint64(_BASE) + self.hash[j:j + n]
        return mix(g)


def sliding_argmin(v: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost smallest value of every window."""
    n = len(v) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    best, at, have = v, np.arange(len(v)), 1
    while have < width:
        step = min(have, width - have)
        m = len(best) - step
        right = best[step:] < best[:m]
        best, at = np.where(right, best[step:], best[:m]), np.where(right, at[step:], at[:m])
        have += step
    return at[:n]


def in_chunks(items: list, sizes: list[int], most: int):
    """Ranges of items whose sizes sum to about ``most``; a larger item is alone."""
    lo, held = 0, 0
    for i, s in enumerate(sizes):
        if held and held + s > most:
            yield lo, i
            lo, held = i, 0
        held += s
    if lo < len(items):
        yield lo, len(items)
