"""Quality rules with suffix-array repetition.

For batches of documents the suffix array over words is built by prefix
doubling (only groups that are still tied are sorted again), with the document
as part of every symbol, so suffixes of different documents never match.  The
longest common prefix of neighbours comes from the stored ranks of each
doubling.  A suffix whose longer neighbour prefix reaches the minimum is the
start of a maximal repeated substring; the union of these spans gives the
covered fraction, the maximum the longest repeat.

Defined cases: a null or empty text has no words, fails the base rules
(fewer than ``min_words``) and is not kept; repeated rows are judged alike; an
empty table gives no rows; other columns play no part, whatever their names; a very
long text is a batch of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SYMBOLS = (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")
BLANKS = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
FIELDS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_covered long, longest_repeat long"
#: Words in one suffix array; a longer document is an array by itself.
CHUNK_WORDS = 400_000


def longest_repeats(symbols: np.ndarray) -> np.ndarray:
    """For every position the length of the longest common prefix of its suffix
    with any other suffix, by a suffix array."""
    n = len(symbols)
    best = np.zeros(n, dtype=np.int64)
    if n < 2:
        return best
    order = np.argsort(symbols, kind="stable")
    s = symbols[order]
    new = np.concatenate(([True], s[1:] != s[:-1]))
    starts = np.flatnonzero(new)
    rank = np.empty(n + 1, dtype=np.int64)
    rank[n] = -1
    rank[order] = np.repeat(starts, np.diff(np.append(starts, n)))
    levels, k = [rank], 1
    tied = np.flatnonzero(~(new & np.append(new[1:], True)))
    active = order[tied]
    while len(active):
        rank = levels[-1]
        second = rank[np.minimum(active + k, n)]
        o = np.lexsort((second, rank[active]))
        active, first, second = active[o], rank[active][o], second[o]
        head = np.concatenate(([True], first[1:] != first[:-1]))
        new = head | np.concatenate(([True], second[1:] != second[:-1]))
        pos = np.arange(len(active))
        group0 = np.maximum.accumulate(np.where(head, pos, 0))
        new0 = np.maximum.accumulate(np.where(new, pos, 0))
        nxt = rank.copy()
        nxt[active] = first + (new0 - group0)
        levels.append(nxt)
        active = active[~(new & np.append(new[1:], True))]
        k *= 2
    suffix = np.empty(n, dtype=np.int64)
    suffix[levels[-1][:n]] = np.arange(n)
    a, b = suffix[:-1], suffix[1:]
    pair = np.flatnonzero(levels[0][a] == levels[0][b])
    a, b = a[pair], b[pair]
    lcp = np.zeros(len(pair), dtype=np.int64)
    for level in range(len(levels) - 1, -1, -1):
        r = levels[level]
        same = r[np.minimum(a + lcp, n)] == r[np.minimum(b + lcp, n)]
        lcp[same] += 1 << level
    np.maximum.at(best, a, lcp)
    np.maximum.at(best, b, lcp)
    return best


def covered(starts: np.ndarray, lengths, n: int) -> np.ndarray:
    """Mask of the union of spans."""
    edge = np.bincount(starts, minlength=n + 1) - np.bincount(starts + lengths, minlength=n + 1)
    return np.cumsum(edge[:n]) > 0


def measure(docs: list[list[bytes]], gram: int, min_repeat: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per document: words in repeated grams, words covered by repeats of at
    least ``min_repeat`` words, the longest repeat."""
    sizes = np.array([len(d) for d in docs], dtype=np.int64)
    flat = [w for d in docs for w in d]
    zero = np.zeros(len(docs), dtype=np.int64)
    if not flat:
        return zero, zero.copy(), zero.copy()
    number = {w: i for i, w in enumerate(set(flat))}
    ids = np.fromiter(map(number.__getitem__, flat), dtype=np.int64, count=len(flat))
    doc = np.repeat(np.arange(len(docs)), sizes)
    best = longest_repeats(doc * len(number) + ids)
    n = len(flat)
    hit = np.flatnonzero(best >= gram)
    in_gram = covered(hit, gram, n)
    hit = np.flatnonzero(best >= min_repeat)
    in_span = covered(hit, best[hit], n)
    longest = zero.copy()
    np.maximum.at(longest, doc, best)
    count = lambda mask: np.bincount(doc[mask], minlength=len(docs))
    return count(in_gram), count(in_span), longest


def repetition_features(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
                        gram: int = 5, min_repeat: int = 10) -> DataFrame:
    """The columns ``keep`` and the counts of every text."""
    schema = docs.select(*keep).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            cols = np.zeros((7, n), dtype=np.int64)
            chunk, at, held = [], 0, 0

            def flush(upto: int) -> None:
                nonlocal chunk, at, held
                if chunk:
                    cols[4, at:upto], cols[5, at:upto], cols[6, at:upto] = measure(chunk, gram, min_repeat)
                chunk, at, held = [], upto, 0

            for i, value in enumerate(batch.column(n_keep)):
                text = value.as_py() or ""
                data = text.encode("utf-8")
                words = data.split()
                lines = [x for x in data.split(b"\n") if x.strip()]
                cols[0, i] = len(words)
                cols[1, i] = len(text) - sum(map(text.count, BLANKS))
                cols[2, i] = sum(map(data.count, SYMBOLS))
                cols[3, i] = len(lines) - len(set(lines))
                chunk.append(words)
                held += len(words)
                if held >= CHUNK_WORDS:
                    flush(i + 1)
            flush(n)
            yield pa.record_batch([*[batch.column(k) for k in range(n_keep)], *[pa.array(c) for c in cols]],
                                  names=[*keep, *[f.split()[0] for f in FIELDS.split(", ")]])

    n_keep = len(keep)
    out = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in schema), FIELDS])
    return docs.select(*keep, F.col(text_col)).mapInArrow(run, out)


def quality_rules(features: DataFrame, min_words: int = 10, max_gram_percent: int = 20,
                  max_covered_percent: int = 10, max_longest: int = 50) -> DataFrame:
    """Adds base_failed and kept to the output of :func:`repetition_features`."""
    failed = ((F.col("n_words") < min_words)
              | (100 * F.col("n_repeat_words") > max_gram_percent * F.col("n_words")))
    fine = (100 * F.col("n_covered") <= max_covered_percent * F.col("n_words")) & (F.col("longest_repeat") <= max_longest)
    return features.withColumn("base_failed", failed).withColumn("kept", ~failed & fine)
