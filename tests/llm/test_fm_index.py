"""The FM-index against plain search: own and foreign sequences, intervals and earliest windows."""

import numpy as np
import pytest

from judicata.llm.fm_index import FMIndex, Marks
from judicata.llm.substring_dedup import earliest_windows


def joined(sequences):
    flat = np.array([x for s in sequences for x in (*s, 0)], dtype=np.int64)
    sizes = np.array([len(s) for s in sequences], dtype=np.int64)
    return flat, np.cumsum(sizes + 1) - 1, sizes


def places(sequences, pattern):
    k = len(pattern)
    return sum(list(s[p:p + k]) == list(pattern) for s in sequences for p in range(len(s) - k + 1))


@pytest.mark.parametrize("n", [1, 63, 64, 65, 128, 1000])
def test_marks(n):
    rng = np.random.default_rng(n)
    for density in (0.002, 0.1, 0.9):
        bits = rng.random(n) < density
        bits[0] = True
        at, i = np.flatnonzero(bits), np.arange(n)
        m = Marks(bits)
        assert (m.at_or_before(i) == at[np.searchsorted(at, i, side="right") - 1]).all()
        assert (m.after(i) == np.append(at, n)[np.searchsorted(at, i, side="right")]).all()


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("width", [1, 3, 5])
def test_matching_statistics(seed, width):
    rng = np.random.default_rng(seed)
    own = [rng.integers(1, 4, rng.integers(1, 40)).tolist() for _ in range(30)]
    own += [own[0], own[1][:7] or [1], [2] * 60]
    index = FMIndex(joined(own)[0], width)
    assert index.n == len(joined(own)[0]) and not hasattr(index, "suffix")
    # 4 is what the index does not hold
    foreign = [rng.integers(1, 5, rng.integers(1, 50)).tolist() for _ in range(20)] + [own[0] + own[2], [4], [4] * 9 + own[3]]
    for streamed in (own, foreign):
        flat, ends, sizes = joined(streamed)
        got = {(int(w), int(b)): (int(lo), int(hi)) for who, b, los, his in index.matches(flat, ends, sizes)
               for w, lo, hi in zip(who, los, his)}
        for k, s in enumerate(streamed):
            for p in range(len(s) - width + 1):
                count = places(own, s[p:p + width])
                interval = got.pop((k, len(s) - p), None)
                assert (interval is not None) == (count > 0)
                if interval:
                    assert interval[1] - interval[0] == count
        assert not got


@pytest.mark.parametrize("seed", range(4))
def test_earliest_windows(seed):
    """Segments in any order, several of one text, repeats inside a segment: the smallest place of every window."""
    rng = np.random.default_rng(seed)
    width, segments = 3, {}
    for doc in range(25):
        start = 0
        for _ in range(rng.integers(1, 4)):
            n = int(rng.integers(width, 12))
            words = b" ".join(b"abc"[c:c + 1] for c in rng.integers(0, 3, n))
            place = (doc // 2, doc % 2 - 1, start)
            segments[words] = min(place, segments.get(words, place))
            start += n - width + 1          # the next run starts at the window after the last
    rows = [(w, *p) for w, p in segments.items()]
    rng.shuffle(rows)
    rows = [(w, int(i), int(t), int(s)) for w, i, t, s in rows]
    first: dict = {}
    for words, i, t, s in rows:
        w = words.split()
        for p in range(len(w) - width + 1):
            key = tuple(w[p:p + width])
            first[key] = min(first.get(key, (i, t, s + p)), (i, t, s + p))
    got = [(i, t, p) for i, t, ps in earliest_windows(rows, width) for p in ps]
    assert sorted(got) == sorted(first.values())
    assert list(earliest_windows([(b"a b", 1, 1, 0)], width)) == []
