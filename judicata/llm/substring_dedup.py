"""Substring deduplication by FM-indexes per shard.

A window of ``width`` words is removed where its word sequence also starts
earlier (smaller document id, or earlier in the same document); the words that
removed windows cover go, all windows are judged on the input.

Shards are cut by content, so that equal windows meet in one shard: a window
belongs to its anchor, the gram with the smallest hash among those inside it.
1. Every document gives its anchors as sorted blocks of hashes; only anchors
   found twice in the corpus can lie in repeated windows.
2. Runs of windows around one repeated anchor become segments, equal segments
   of a task become one with the earliest place, and a shard gets all segments
   of its anchors.  The most frequent anchors are split: their windows are sent
   one by one by their own hash, so a passage of a third of all documents is
   spread and still compared exactly.
3. Each shard builds a compressed FM-index of its distinct segments (wavelet
   matrix, symbol counts, a bit per suffix) and streams the segments through
   backward search; equal windows report the same interval at the threshold, and
   the smallest place that reports it is the earliest.
4. A document loses the words of its repeated windows that are not the earliest.

Words are compared as words in the shards; hashes only route.

Defined cases: a null or empty text has no words and keeps the empty string;
rows without an id keep all words and count for nothing; equal rows are one
document and get equal results; different texts under one id are ordered by
their text hash; every other column is left to the caller's join by id, whatever
its name; an empty table gives no rows; a very long text is one chunk of one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from judicata.llm.common import materialise, n_partitions
from judicata.llm.fm_index import FMIndex
from judicata.llm.wordhash import Words, in_chunks, sliding_argmin

CHUNK_BYTES = 1 << 20
#: Anchors above this count may be split by window; at most HOT_ANCHORS of them, the most frequent ones.
HOT_COUNT, HOT_ANCHORS = 20_000, 10_000
SHARD_WORDS = 300_000
#: One task holds the anchors of one bucket at a time; this much text gives about 2 million anchors (50 MB).
BUCKET_BYTES = 64 << 20


def windows(w: Words, width: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gram hashes, anchor of every window, whether the window lies in one text)."""
    g = w.grams(gram)
    at = sliding_argmin(g, width - gram + 1)
    n = len(at)
    return g, at, w.doc[:n] == w.doc[width - 1:width - 1 + n]


def _blocks(docs: DataFrame, width: int, gram: int, buckets: int) -> DataFrame:
    """Anchors as blocks by hash bucket: kind 0 has one entry per hash of a task
    with its count, kind 1 places whose hash is already known to repeat."""
    def emit(ids, txts, hashes, refs, places):
        order = np.argsort(hashes, kind="stable")
        h, r, p = hashes[order], refs[order], places[order]
        new = np.concatenate(([True], h[1:] != h[:-1]))
        start = np.flatnonzero(new)
        count = np.diff(np.append(start, len(h)))
        ids, txts = np.array(ids, dtype=np.int64), np.array(txts, dtype=np.int64)
        rows = []
        bucket = (h[start] >> np.uint64(40)).astype(np.int64) * buckets >> 24
        cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(bucket) else []
        for a, b in zip(cut, np.append(cut[1:], len(bucket)) if len(cut) else []):
            i = start[a:b]
            rows.append((int(bucket[a]), 0, h[i].tobytes(), np.minimum(count[a:b], 2**31 - 1).astype("<i4").tobytes(),
                         ids[r[i]].tobytes(), txts[r[i]].tobytes(), p[i].astype("<i4").tobytes()))
        known = ~np.isin(np.arange(len(h)), start[count == 1])
        r, p = r[known], p[known]
        order = np.lexsort((p, r))
        r, p = r[order], p[order]
        cut = np.flatnonzero(np.concatenate(([True], r[1:] >> 8 != r[:-1] >> 8)))[:len(r)]      # blocks of 256 documents
        for a, z in zip(cut, np.append(cut[1:], len(r))):
            i = r[a:z]
            rows.append((int(txts[i[0]]) % buckets, 1, b"", b"", ids[i].tobytes(), txts[i].tobytes(), p[a:z].astype("<i4").tobytes()))
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 7, (
            pa.int32(), pa.int32(), *[pa.binary()] * 5))], names=["bucket", "kind", "h", "c", "id", "txt", "pos"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, txts, hs, rs, ps, held = [], [], [], [], [], 0
        for b in batches:
            texts = b.column(2).cast(pa.binary()).to_pylist()
            for lo, hi in in_chunks(texts, [len(t) for t in texts], CHUNK_BYTES):
                w = Words(texts[lo:hi])
                g, at, one = windows(w, width, gram)
                at = at[one]
                if len(at):
                    at = at[np.concatenate(([True], at[1:] != at[:-1]))]
                    hs.append(g[at])
                    rs.append(w.doc[at] + len(ids))
                    ps.append(at - w.first[w.doc[at]])
                    held += len(at)
                ids += b.column(0)[lo:hi].to_pylist()
                txts += b.column(1)[lo:hi].to_pylist()
                if held > 1_500_000:
                    yield emit(ids, txts, np.concatenate(hs), np.concatenate(rs), np.concatenate(ps))
                    ids, txts, hs, rs, ps, held = [], [], [], [], [], 0
        if held:
            yield emit(ids, txts, np.concatenate(hs), np.concatenate(rs), np.concatenate(ps))

    return docs.mapInArrow(run, "bucket int, kind int, h binary, c binary, id binary, txt binary, pos binary")


def _repeated(blocks: DataFrame) -> DataFrame:
    """(id, txt, places) of repeated anchors; rows with ``hot`` name a frequent anchor instead."""
    def rows_of(i, t, p):
        if not len(i):
            return None
        order = np.lexsort((p, t, i))
        i, t, p = i[order], t[order], p[order]
        new = np.flatnonzero(np.concatenate(([True], (i[1:] != i[:-1]) | (t[1:] != t[:-1]))))
        off = np.append(new, len(i)).astype(np.int32)
        n = len(new)
        return pa.record_batch([pa.array(i[new]), pa.array(t[new]), pa.ListArray.from_arrays(pa.array(off), pa.array(p.astype(np.int32))),
                                pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())], names=["id", "txt", "places", "hot", "n"])

    def read(part, k, dtype):
        return np.frombuffer(b"".join(r[k] for r in part), dtype=dtype)

    def bucket(part):
        if not part:
            return
        h, c, i, t, p = (read(part, k, d) for k, d in ((0, "<u8"), (1, "<i4"), (2, "<i8"), (3, "<i8"), (4, "<i4")))
        order = np.argsort(h, kind="stable")
        h, c, i, t, p = h[order], c[order].astype(np.int64), i[order], t[order], p[order]
        start = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
        total = np.add.reduceat(c, start)
        several = np.repeat(total >= 2, np.diff(np.append(start, len(h))))
        yield rows_of(i[several], t[several], p[several])
        hot = np.flatnonzero(total > HOT_COUNT)
        if len(hot):
            n = len(hot)
            yield pa.record_batch([pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.int32())),
                                   pa.array(h[start[hot]].view(np.int64)), pa.array(total[hot])], names=["id", "txt", "places", "hot", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, part = None, []
        for b in batches:
            for r in zip(*(b.column(k).to_pylist() for k in range(7))):
                if r[1] == 1:
                    out = rows_of(np.frombuffer(r[4], "<i8"), np.frombuffer(r[5], "<i8"), np.frombuffer(r[6], "<i4"))
                    if out is not None:
                        yield out
                    continue
                if r[0] != now:
                    yield from (x for x in bucket(part) if x is not None)
                    now, part = r[0], []
                part.append(r[2:])
        yield from (x for x in bucket(part) if x is not None)

    spread = blocks.repartition(n_partitions(blocks.sparkSession), "bucket").sortWithinPartitions("bucket")
    return spread.mapInArrow(run, "id long, txt long, places array<int>, hot long, n long")


STAGE2 = ("kind int, id long, txt long, n_words long, kept_sha256 string, text string, cand array<int>, "
          "route long, seg binary, start int")


def _segments(joined: DataFrame, width: int, gram: int, hot: frozenset[int]) -> DataFrame:
    """kind 0: documents without candidates, finished; 1: documents with candidate
    windows (runs as first, last); 2: segments with their earliest place in the task."""
    names = [f.split()[0] for f in STAGE2.split(", ")]
    types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.int64(), pa.binary(), pa.int32())

    def batch(rows):
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 10, types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segs: dict[bytes, tuple] = {}

        def drain():
            yield batch([(2, o[0], o[1], None, None, None, None, o[3], s, o[2]) for s, o in segs.items()])
            segs.clear()

        for b in batches:
            ids, txts, places = (b.column(k).to_pylist() for k in (0, 1, 3))
            texts = [t or b"" for t in b.column(2).cast(pa.binary()).to_pylist()]
            for lo, hi in in_chunks(texts, [len(t) for t in texts], CHUNK_BYTES):
                rows, chunk = [], texts[lo:hi]
                todo = [k for k in range(lo, hi) if places[k]]
                runs: dict[int, list[int]] = {}
                lists: dict[int, list[bytes]] = {}
                if todo:
                    w = Words([texts[k] for k in todo])
                    g, at, one = windows(w, width, gram)
                    known = np.zeros(len(g) + 1, dtype=bool)
                    for d, k in enumerate(todo):
                        known[np.minimum(np.array(places[k], dtype=np.int64) + w.first[d], len(g))] = True
                    cand = one & known[at] if len(at) else np.zeros(0, dtype=bool)
                    idx = np.flatnonzero(cand)
                    if len(idx):
                        brk = np.concatenate(([True], (idx[1:] != idx[:-1] + 1) | (at[idx[1:]] != at[idx[:-1]]) | (w.doc[idx[1:]] != w.doc[idx[:-1]])))
                        first = idx[brk]
                        last = idx[np.append(np.flatnonzero(brk)[1:] - 1, len(idx) - 1)]
                        for a, z, h in zip(first.tolist(), last.tolist(), g[at[first]].view(np.int64).tolist()):
                            d = int(w.doc[a])
                            k = todo[d]
                            if d not in lists:
                                lists[d] = texts[k].split()
                            off = int(w.first[d])
                            a, z = a - off, z - off
                            runs.setdefault(k, []).extend((a, z))
                            if h in hot:
                                pieces = [(s, s + width, None) for s in range(a, z + 1)]
                            else:
                                pieces = [(a, z + width, h)]
                            for s, e, route in pieces:
                                seg = b" ".join(lists[d][s:e])
                                if route is None:
                                    route = int.from_bytes(hashlib.blake2b(seg, digest_size=8).digest(), "little", signed=True)
                                place = (ids[k], txts[k], s)
                                old = segs.get(seg)
                                if old is None or place < old[:3]:
                                    segs[seg] = (*place, route)
                for k in range(lo, hi):
                    if k in runs:
                        rows.append((1, ids[k], txts[k], None, None, texts[k].decode(), runs[k], None, None, None))
                    else:
                        words = texts[k].split()
                        rows.append((0, ids[k], txts[k], len(words), hashlib.sha256(b" ".join(words)).hexdigest(), None, None, None, None, None))
                yield batch(rows)
                if len(segs) > 100_000:
                    yield from drain()
        yield from drain()

    return joined.select("id", "txt", "text", "places").mapInArrow(run, STAGE2)


def earliest_windows(segments: list[tuple[bytes, int, int, int]], width: int):
    """(id, txt, window starts) of the windows that occur first, by an FM-index
    of distinct segments (words, id, txt, start).

    The index holds the segments in order of their places, and windows of one
    text lie in one segment each, so places of the index are in order too.  The
    segments are streamed against the index; equal windows report the same
    interval, and the smallest place that reports an interval is the earliest."""
    segments = sorted(segments, key=lambda s: s[1:])
    lists = [s[0].split() for s in segments]
    number = {w: i + 1 for i, w in enumerate(dict.fromkeys(x for words in lists for x in words))}
    sizes = np.array([len(x) for x in lists], dtype=np.int64)
    flat = np.zeros(int(sizes.sum()) + len(lists), dtype=np.int64)
    ends = np.cumsum(sizes + 1) - 1                      # places of the separators
    inside = np.ones(len(flat), dtype=bool)
    inside[ends] = False
    flat[inside] = np.fromiter((number[x] for words in lists for x in words), dtype=np.int64, count=int(sizes.sum()))
    del lists, number, inside
    index = FMIndex(flat, width)
    interval, place = [], []
    for who, back, lo, _hi in index.matches(flat, ends, sizes):
        interval.append(lo)
        place.append(ends[who] - back)
    if not place:
        return
    lo, at = np.concatenate(interval), np.concatenate(place)
    order = np.lexsort((at, lo))
    at, lo = at[order], lo[order]
    at = np.sort(at[np.concatenate(([True], lo[1:] != lo[:-1]))])
    seg = np.searchsorted(ends, at)
    offset = at - (ends - sizes)[seg]
    cut = np.flatnonzero(np.concatenate(([True], seg[1:] != seg[:-1])))
    for a, z in zip(cut, np.append(cut[1:], len(seg))):
        _, i, txt, start = segments[seg[a]]
        yield i, txt, (offset[a:z] + start).tolist()


def _search(segments: DataFrame, width: int, shard_words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, tuple] = {}
        words, now = 0, None

        def shard():
            rows = list(earliest_windows([(s, *o) for s, o in held.items()], width)) if held else []
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 3, (
                pa.int64(), pa.int64(), pa.list_(pa.int32())))], names=["id", "txt", "first"])

        for b in batches:
            for route, seg, *place in zip(*(b.column(k).to_pylist() for k in range(5))):
                if route != now:
                    if words >= shard_words:
                        yield shard()
                        held.clear()
                        words = 0
                    now = route
                old = held.get(seg)
                if old is None:
                    words += seg.count(b" ") + 2
                if old is None or tuple(place) < old:
                    held[seg] = tuple(place)
        yield shard()

    spread = (segments.repartition(n_partitions(segments.sparkSession), "route").sortWithinPartitions("route")
              .select("route", "seg", "id", "txt", "start"))
    return spread.mapInArrow(run, "id long, txt long, first array<int>")


def _finish(pending: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, txt, text, cand, first in zip(*(b.column(k).to_pylist() for k in range(5))):
                words = text.encode().split()
                gone = np.zeros(len(words) + 1, dtype=bool)
                for a, z in zip(cand[0::2], cand[1::2]):
                    gone[a:z + 1] = True
                for f in first or ():
                    gone[f] = False
                edge = np.zeros(len(words) + 1, dtype=np.int64)
                s = np.flatnonzero(gone)
                edge[s] += 1
                np.subtract.at(edge, s + width, 1)
                out = np.cumsum(edge)[:len(words)] > 0
                kept = b" ".join([w for w, x in zip(words, out.tolist()) if not x])
                rows.append((i, txt, len(words), int(out.sum()), kept.decode()))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, (
                pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()))], names=["id", "txt", "n_words", "n_removed", "kept_text"])

    return (pending.select("id", "txt", "text", "cand", "first")
            .mapInArrow(run, "id long, txt long, n_words long, n_removed long, kept_text string"))


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 20,
                    gram: int = 8, shard_words: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame]:
    """(documents without removals: id, n_words, kept_sha256;
    documents with candidates: id, n_words, n_removed, kept_text)."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("txt"), F.col(text_col).alias("text"))
    usable = rows.where(F.col("id").isNotNull() & F.col("text").isNotNull())
    size = usable.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    buckets = min(max(4 * n_partitions(docs.sparkSession), -(-size // BUCKET_BYTES)), 1 << 24)
    repeated = materialise(_repeated(_blocks(usable, width, gram, buckets)))
    hot = frozenset(r["hot"] for r in repeated.where("hot IS NOT NULL").orderBy(F.desc("n"), "hot").limit(HOT_ANCHORS).collect())
    places = (repeated.where("id IS NOT NULL").groupBy("id", "txt")
              .agg(F.array_distinct(F.flatten(F.collect_list("places"))).alias("places")))
    stage2 = materialise(_segments(rows.join(places, ["id", "txt"], "left"), width, gram, hot))
    first = (_search(stage2.where("kind = 2"), width, shard_words)
             .groupBy("id", "txt").agg(F.flatten(F.collect_list("first")).alias("first")))
    pending = stage2.where("kind = 1").select("id", "txt", "text", "cand").join(first, ["id", "txt"], "left")
    return stage2.where("kind = 0").select("id", "n_words", "kept_sha256"), _finish(pending, width).drop("txt")
