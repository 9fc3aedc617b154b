"""FM-index over word sequences: wavelet matrix, backward search, bounded matching statistics."""

from __future__ import annotations

import numpy as np


class BitRank:
    """Packed bits with a rank directory."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        packed = np.packbits(np.concatenate((bits, np.zeros(-n % 64 + 64, dtype=bool))), bitorder="little")
        self.words = packed.view(np.uint64)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words))[:-1])).astype(np.int64)
        self.ones = int(bits.sum())

    def rank1(self, i: np.ndarray) -> np.ndarray:
        w = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask)


class WaveletMatrix:
    """Occurrences of a symbol before a position, a level per bit of the symbols."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.n, self.levels = len(symbols), []
        for shift in range(bits - 1, -1, -1):
            one = (symbols >> shift & 1).astype(bool)
            rank = BitRank(one)
            self.levels.append((shift, rank, self.n - rank.ones))
            symbols = np.concatenate((symbols[~one], symbols[one]))

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Number of ``symbol`` in the first ``i`` places (all arrays)."""
        start = np.zeros_like(i)
        for shift, bits, zeros in self.levels:
            one = (symbol >> shift & 1).astype(bool)
            a, b = bits.rank1(start), bits.rank1(i)
            start, i = np.where(one, zeros + a, start - a), np.where(one, zeros + b, i - b)
        return i - start


def sorted_suffixes(text: np.ndarray, depth: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes ordered by at least their first ``depth`` symbols, and the ranks
    by 1, 2, 4, ... symbols.  Only groups still tied are sorted again."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    s = text[order]
    new = np.concatenate(([True], s[1:] != s[:-1]))
    starts = np.flatnonzero(new)
    rank = np.empty(n + 1, dtype=np.int64)
    rank[n] = -1
    rank[order] = np.repeat(starts, np.diff(np.append(starts, n)))
    levels, k = [rank], 1
    active = order[~(new & np.append(new[1:], True))]
    while k < depth:
        rank = levels[-1]
        second = rank[np.minimum(active + k, n)]
        o = np.lexsort((second, rank[active]))
        active, first, second = active[o], rank[active][o], second[o]
        head = np.concatenate(([True], first[1:] != first[:-1]))[:len(active)]
        new = head | np.concatenate(([True], second[1:] != second[:-1]))[:len(active)]
        pos = np.arange(len(active))
        nxt = rank.copy()
        nxt[active] = first + np.maximum.accumulate(np.where(new, pos, 0)) - np.maximum.accumulate(np.where(head, pos, 0))
        levels.append(nxt)
        active = active[~(new & np.append(new[1:], True)[:len(active)])]
        k *= 2
    return np.lexsort((np.arange(n), levels[-1][:n])), levels


class Marks(BitRank):
    """A bit vector whose first bit is set: the set bits around a place."""

    def __init__(self, bits: np.ndarray):
        super().__init__(bits)
        self.n = len(bits)
        held = np.flatnonzero(self.words)
        #: the last word with a set bit up to each word, the first one from each word on
        at = np.arange(len(self.words))
        self.left = held[np.searchsorted(held, at, side="right") - 1]
        self.right = np.append(held, len(self.words) - 1)[np.searchsorted(held, at)]     # the last word is padding

    def at_or_before(self, i: np.ndarray) -> np.ndarray:
        w = i >> 6
        here = self.words[w] & (~np.uint64(0) >> (63 - (i & 63)).astype(np.uint64))
        w = np.where(here == 0, self.left[np.maximum(w - 1, 0)], w)
        x = np.where(here == 0, self.words[w], here)
        for k in (1, 2, 4, 8, 16, 32):
            x = x | (x >> np.uint64(k))
        return (w << 6) + np.bitwise_count(x).astype(np.int64) - 1

    def after(self, i: np.ndarray) -> np.ndarray:
        """The first set bit past ``i``, or the length."""
        j = i + 1
        w = j >> 6
        here = self.words[w] & (~np.uint64(0) << (j & 63).astype(np.uint64))
        w = np.where(here == 0, self.right[np.minimum(w + 1, len(self.words) - 1)], w)
        x = np.where(here == 0, self.words[w], here)
        low = np.bitwise_count((x & (~x + np.uint64(1))) - np.uint64(1)).astype(np.int64)
        return np.minimum((w << 6) + low, self.n)


class FMIndex:
    """Compressed index of sequences of symbols >= 1; 0 ends every sequence, and
    the largest symbol plus one stands for all that the index does not hold.

    Suffixes are ordered by ``threshold`` symbols or more, which makes every
    interval of a pattern up to that length exact.  Kept are the last column as
    a wavelet matrix, the symbol counts, and a bit per suffix that says where a
    new prefix of ``threshold`` symbols starts; the suffix array goes once these
    are built."""

    def __init__(self, text: np.ndarray, threshold: int):
        self.threshold, self.n = threshold, len(text)
        suffix, levels = sorted_suffixes(text, threshold)
        n = self.n
        bits = (int(text.max()) + 1).bit_length()
        # the text ends with 0, so place -1 is a separator
        self.wavelet = WaveletMatrix(text[suffix - 1], bits)
        self.less = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=1 << bits))))
        # where neighbouring suffixes differ within the first ``threshold`` symbols
        a, b = suffix[:-1], suffix[1:]
        same, done = np.ones(n - 1, dtype=bool), 0
        for level in range(len(levels) - 1, -1, -1):
            if done + (1 << level) <= threshold:
                r = levels[level]
                same &= r[np.minimum(a + done, n)] == r[np.minimum(b + done, n)]
                done += 1 << level
        self.heads = Marks(np.concatenate(([True], ~same)))

    def step(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search by one symbol."""
        base = self.less[symbol]
        return base + self.wavelet.rank(symbol, lo), base + self.wavelet.rank(symbol, hi)

    def find(self, flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns ``flat[start:start + length]``, empty where they do not occur."""
        lo, hi = np.zeros(len(start), dtype=np.int64), np.full(len(start), self.n, dtype=np.int64)
        for back in range(1, int(length.max(initial=0)) + 1):
            k = np.flatnonzero((length >= back) & (lo < hi))
            lo[k], hi[k] = self.step(flat[start[k] + length[k] - back], lo[k], hi[k])
        return lo, hi

    def longest(self, flat: np.ndarray, start: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Length of the longest prefix of ``flat[start:start + most]`` that occurs."""
        least, most = np.zeros_like(most), most.copy()
        while (least < most).any():
            middle = (least + most + 1) >> 1
            lo, hi = self.find(flat, start, middle)
            least, most = np.where(lo < hi, middle, least), np.where(lo < hi, most, middle - 1)
        return least

    def matches(self, flat: np.ndarray, ends: np.ndarray, lengths: np.ndarray):
        """Matching statistics of streamed sequences, bounded by the threshold.

        ``flat`` holds them one after the other, ``ends`` is past the last symbol
        of each.  Yields (sequences, places from the end, lo, hi): suffixes that
        match ``threshold`` symbols from that place on, with their interval.
        A match that grows past the threshold falls back to the enclosing
        interval of exactly that length, one that ends to its longest prefix."""
        at = np.arange(len(ends))
        lo, hi = np.zeros(len(ends), dtype=np.int64), np.full(len(ends), self.n, dtype=np.int64)
        size = np.zeros(len(ends), dtype=np.int64)
        for back in range(1, int(lengths.max(initial=0)) + 1):
            live = lengths[at] >= back
            at, lo, hi, size = at[live], lo[live], hi[live], size[live]
            here = ends[at] - back
            lo, hi = self.step(flat[here], lo, hi)
            size += 1
            lost = np.flatnonzero(lo >= hi)
            if len(lost):
                size[lost] = self.longest(flat, here[lost], size[lost] - 1)
                lo[lost], hi[lost] = self.find(flat, here[lost], size[lost])
            grown = np.flatnonzero(size > self.threshold)
            if len(grown):
                inner = lo[grown]
                lo[grown], hi[grown] = self.heads.at_or_before(inner), self.heads.after(inner)
                size[grown] = self.threshold
            over = size >= self.threshold
            if over.any():
                yield at[over], back, lo[over], hi[over]
