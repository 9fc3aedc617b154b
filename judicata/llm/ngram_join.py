"""N-gram Jaccard self-join with adaptive multi-match prefixes.

A document is its set of distinct word n-grams; documents link when
100 * intersection >= percent * union.  Sets are ordered by hash.  Two linked
sets share at least one hash among the first p = n - ceil(t n) + 1 of each, and
at least l + 1 among the first p + l.  So a document whose prefix holds l hot
n-grams (found in more than ``hot`` different sets, the estimate of their
candidate cost) lengthens its prefix until p others are in it, and the hot ones
are not needed as candidates: a linked partner shares l + 1 of that prefix, one
of them not hot.  The lengthening is bounded by what any partner's zone can
answer (``margin`` of the smallest partner size); a document that is hot beyond
that keeps the others of its zone and the hot ones of its plain prefix (both
partners of that kind share one there; a partner of the first kind shares one
that is not hot).  A document whose zone shares fewer n-grams with the
rest of the corpus than any link needs there has no partner and drops out.

Equal sets are one class before the join.  The classes of a token group that can
still link with one another go to the group's leader, counted by shared tokens.
First every class is verified with the leader it shares the most tokens with and
united; then families of leaders that still hold several components are cut into
blocks of bounded size, and every pair of blocks compares the sets of different
components in one task.  A pair is so met once per family instead of once per
token, and sets are shipped once per block and not per pair.  Every link between
sets of different components is tried, and the components are exact.

Hashes of n-grams have 64 bits; the exact check compares 48 of them within a
pair of sets, classes are told apart by 64 bits of a digest of the set.

Defined cases: fewer than n words are one n-gram of all words; null or blank
texts have an empty set and link with nothing; rows without an id link with
nothing and have no component; rows that repeat an id are one document; an empty
table gives no rows; other columns play no part, whatever their names; a very long
text is one set, held whole by one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from judicata.llm.common import materialise, n_partitions
from judicata.operators.components import components
from judicata.llm.wordhash import Words, in_chunks, mix

CHUNK_BYTES = 1 << 18
#: Zone entries that a task writes as one block for each bucket.
BLOCK_ENTRIES = 500_000
#: Entries of a bucket that are sorted at a time.
SLICE_ENTRIES = 250_000
#: Sets of at most this size show their whole set; a longer prefix than half again is free up to there.
SHORT = 300
#: Candidate classes up to this many are sent to all executors to pick their texts (about 16 bytes each).
BROADCAST_CLASSES = 500_000
#: N-grams in one block of a family; two blocks are compared in one task.
BLOCK_GRAMS = 2_000_000


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def margin(n: int, percent: int) -> int:
    """How far a zone goes past the plain prefix; never falls as n grows."""
    if n <= 0:
        return 0
    s = min(n, SHORT)
    return min(n - prefix_length(n, percent), max(s - prefix_length(s, percent), prefix_length(n, percent) // 2))


def rests(n: np.ndarray, percent: int) -> np.ndarray:
    """How many hashes of sets of these sizes lie beyond their zones."""
    p, s = n - -(-percent * n // 100) + 1, np.minimum(n, SHORT)
    return n - p - np.minimum(n - p, np.maximum(s - (s - -(-percent * s // 100) + 1), p // 2))


def shingle_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of every text."""
    w = Words(texts, lower=True)
    g = w.grams(n)
    out = []
    for a, z in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        if z - a >= n:
            out.append(np.unique(g[a:z - n + 1]))
        elif z > a:
            h = np.zeros(1, dtype=np.uint64)
            for x in w.hash[a:z]:
                h = mix(h * np.uint64(31) + x)
            out.append(h)
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def class_of(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def _sets(batch: pa.RecordBatch, col: int, n: int):
    texts = [t or b"" for t in batch.column(col).cast(pa.binary()).to_pylist()]
    for lo, hi in in_chunks(texts, [len(t) for t in texts], CHUNK_BYTES):
        yield from zip(range(lo, hi), shingle_sets(texts[lo:hi], n))


def _members(rows: DataFrame, n: int) -> DataFrame:
    """(id, cls, n) of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cls, size = [], []
            for _, s in _sets(b, 1, n):
                cls.append(class_of(s) if len(s) else None)
                size.append(len(s))
            yield pa.record_batch([b.column(0), pa.array(cls, pa.int64()), pa.array(size, pa.int64())], names=["id", "cls", "n"])

    return rows.select("id", "text").mapInArrow(run, "id long, cls long, n long")


def _zones(rows: DataFrame, n: int, percent: int, buckets: int) -> DataFrame:
    """Zones of the sets as blocks by hash bucket, each with its table of classes."""
    names = ["bucket", "h", "ref", "rank", "cls", "n"]
    types = (pa.int32(), *[pa.binary()] * 5)

    def emit(hs, refs, ranks, cls, sizes):
        h, ref, rank = np.concatenate(hs), np.concatenate(refs), np.concatenate(ranks)
        order = np.argsort(h, kind="stable")
        h, ref, rank = h[order], ref[order], rank[order]
        bucket = (h >> np.uint64(40)).astype(np.int64) * buckets >> 24
        cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
        cls, sizes, out = np.array(cls, dtype=np.int64), np.array(sizes, dtype=np.int64), []
        narrow = "<u2" if len(rank) and int(rank.max()) < 65536 else "<u4"
        for a, z in zip(cut, np.append(cut[1:], len(h))):
            used, at = np.unique(ref[a:z], return_inverse=True)
            out.append((int(bucket[a]), h[a:z].tobytes(), at.astype("<u2").tobytes(), rank[a:z].astype(narrow).tobytes(),
                        cls[used].tobytes(), sizes[used].tobytes()))
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hs, refs, ranks, cls, sizes, held, seen = [], [], [], [], [], 0, set()
        for b in batches:
            for _, s in _sets(b, 0, n):
                if not len(s):
                    continue
                c = class_of(s)
                if c in seen:
                    continue
                seen.add(c)
                zone = s[:prefix_length(len(s), percent) + margin(len(s), percent)]
                hs.append(zone)
                refs.append(np.full(len(zone), len(cls), dtype=np.uint32))
                ranks.append(np.arange(len(zone), dtype=np.uint32))
                cls.append(c)
                sizes.append(len(s))
                held += len(zone)
                if len(seen) >= 60_000:
                    seen.clear()
                if held > BLOCK_ENTRIES or len(cls) >= 60_000:
                    yield emit(hs, refs, ranks, cls, sizes)
                    hs, refs, ranks, cls, sizes, held = [], [], [], [], [], 0
        if held:
            yield emit(hs, refs, ranks, cls, sizes)

    return rows.select("text").mapInArrow(run, "bucket int, h binary, ref binary, rank binary, cls binary, n binary")


def _shared(zones: DataFrame, hot: int, parts: int) -> DataFrame:
    """Entries of hashes found in several classes, as blocks by class bucket."""
    names, types = ["cb", "cls", "n", "h", "rank", "hot"], (pa.int32(), *[pa.binary()] * 5)

    def found(part, keys, cut):
        hs, cs, ns, rs = [], [], [], []
        for (_, ref, rank, cls, n), key, s in zip(part, keys, cut):
            at = np.frombuffer(ref, "<u2")
            rs.append(np.frombuffer(rank, "<u2" if len(rank) == 2 * len(at) else "<u4")[s].astype("<u4"))
            at = at[s]
            hs.append(key[s])
            cs.append(np.frombuffer(cls, "<i8")[at])
            ns.append(np.frombuffer(n, "<i8")[at])
        h, c, n, r = (np.concatenate(x) for x in (hs, cs, ns, rs))
        order = np.argsort(h, kind="stable")
        start = np.flatnonzero(np.concatenate(([True], h[order][1:] != h[order][:-1])))
        size = np.diff(np.append(start, len(h)))
        keep = order[np.repeat(size > 1, size)]
        keep = keep[np.lexsort((c[keep], h[keep]))]
        h, c, n, r = h[keep], c[keep], n[keep], r[keep]
        if not len(h):
            return None
        one = np.concatenate(([True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])))      # copies from other tasks
        h, c, n, r = h[one], c[one], n[one], r[one]
        start = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
        df = np.diff(np.append(start, len(h)))
        df = np.repeat(df, df)
        many = df > 1
        return (h[many], c[many], n[many], r[many], df[many] > hot) if many.any() else None

    def emit(some):
        h, c, n, r, over = (np.concatenate(x) for x in zip(*some))
        cb = c % parts
        order = np.lexsort((c, cb))
        h, c, n, r, over, cb = h[order], c[order], n[order], r[order], over[order], cb[order]
        cut = np.flatnonzero(np.concatenate(([True], cb[1:] != cb[:-1])))
        rows = [(int(cb[a]), c[a:z].tobytes(), n[a:z].tobytes(), h[a:z].tobytes(), r[a:z].tobytes(), over[a:z].tobytes())
                for a, z in zip(cut, np.append(cut[1:], len(c)))]
        return pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows), types)], names=names)

    def bucket(part):
        keys, some, held = [np.frombuffer(x[0], "<u8") for x in part], [], 0
        for cut in _slices(keys, SLICE_ENTRIES):
            got = found(part, keys, cut)
            if got is None:
                continue
            some.append(got)
            held += len(got[0])
            if held > BLOCK_ENTRIES:
                yield emit(some)
                some, held = [], 0
        if some:
            yield emit(some)

    return _by_key(zones.repartitionById(parts, "bucket").sortWithinPartitions("bucket"), bucket,
                   "cb int, cls binary, n binary, h binary, rank binary, hot binary")


def _slices(keys: list[np.ndarray], most: int) -> Iterator[list[slice]]:
    """Ranges of sorted blocks, one slice of every block, that hold about ``most``
    entries together; equal keys are in one range, however many they are."""
    some = np.sort(np.concatenate(keys)[::max(1, most // 64)])
    cuts = np.unique(some[64::64])
    at = [np.concatenate(([0], np.searchsorted(k, cuts), [len(k)])) for k in keys]
    for x in range(len(cuts) + 1):
        yield [slice(int(a[x]), int(a[x + 1])) for a in at]


def _by_key(df: DataFrame, work, schema: str) -> DataFrame:
    """``work`` on the rows of each value of the first column of a sorted frame;
    binary values reach it as buffers of their batch, not as copies."""
    def values(column):
        return [x.as_buffer() for x in column] if pa.types.is_binary(column.type) else column.to_pylist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, part = None, []
        for b in batches:
            for r in zip(*(values(b.column(k)) for k in range(b.num_columns))):
                if r[0] != now and part:
                    yield from work(part)
                    part = []
                now = r[0]
                part.append(r[1:])
        if part:
            yield from work(part)

    return df.mapInArrow(run, schema)


def _prefixes(shared: DataFrame, percent: int, parts: int) -> DataFrame:
    """(token, n, cls, shared): the candidate tokens of every class; ``shared`` counts
    its zone's hashes that lie in another class's zone too."""
    names = ["token", "n", "cls", "shared"]

    def classes(part):
        blocks = [[np.frombuffer(x[k], d) for k, d in enumerate(("<i8", "<i8", "<u8", "<u4", "?"))] for x in part]
        for cut in _slices([x[0] for x in blocks], SLICE_ENTRIES):
            yield candidates(*(np.concatenate([x[k][s] for x, s in zip(blocks, cut)]) for k in range(5)))

    def candidates(c, n, h, r, hot):
        order = np.lexsort((r, c))
        c, n, h, r, hot = c[order], n[order], h[order], r[order].astype(np.int64), hot[order]
        cut = np.flatnonzero(np.concatenate(([True], c[1:] != c[:-1])))
        keep, shared = np.zeros(len(c), dtype=bool), np.zeros(len(c), dtype=np.int64)
        for a, z in zip(cut.tolist(), np.append(cut[1:], len(c)).tolist()):
            size = int(n[a])
            least = margin(-(-percent * size // 100), percent)
            if z - a <= least:              # a partner shares least + 1 or more of this zone
                continue
            p = prefix_length(size, percent)
            shared[a:z] = z - a
            ranks = r[a:z][hot[a:z]]
            # with l hot entries before it, place p + l holds the p-th other entry
            dropped = int(np.searchsorted(ranks - np.arange(len(ranks)), p, side="left"))
            if dropped <= least:
                keep[a:z] = ~hot[a:z] & (r[a:z] < p + dropped)
            else:
                keep[a:z] = ~hot[a:z] | (r[a:z] < p)
        cols = (h.view(np.int64)[keep], n[keep], c[keep], shared[keep])
        return pa.record_batch([pa.array(x) for x in cols], names=names)

    return _by_key(shared.repartitionById(parts, "cb").sortWithinPartitions("cb"), classes,
                   "token long, n long, cls long, shared long")


def _families(tokens: DataFrame, percent: int, parts: int) -> DataFrame:
    """(leader, cls, n, able, hits): the classes of every token group that sizes and
    largest possible intersections leave a partner in, under the group's leader, the
    class with the fewest zone hashes of its own; ``able``: it can link with the leader;
    ``hits`` counts their tokens.

    Of two sets take the one whose zone ends at the smaller hash.  Common hashes up
    to there lie in both zones, the others beyond its zone; so the intersection is at
    most the smaller ``shared`` and the larger ``rests`` of the two together."""
    def leave(n, shared, rest):
        """Which of a group, sorted by n, can link with any partner their size allows:
        the smallest one, with the largest rest of all."""
        rest = np.maximum.accumulate(rest)[np.searchsorted(n, 100 * n // percent, side="right") - 1]
        most = np.minimum(n, shared + rest)
        least = n[np.searchsorted(n, -(-percent * n // 100))]
        return 100 * most >= percent * (n + least - most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, int] = {}
        rest = [np.zeros(0, dtype=np.int64)] * 4

        def out():
            lead, ln, ls, cls, n, shared = np.array(list(found), dtype=np.int64).reshape(-1, 6).T
            hits = list(found.values())
            found.clear()
            both = np.minimum(np.minimum(ls, shared) + np.maximum(rests(ln, percent), rests(n, percent)), np.minimum(ln, n))
            able = (cls != lead) & (100 * both >= percent * (n + ln - both))
            return pa.record_batch([pa.array(lead), pa.array(cls), pa.array(n), pa.array(able), pa.array(hits, pa.int64())],
                                   names=["leader", "cls", "n", "able", "hits"])

        def groups(token, n, cls, shared):
            first = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
            beyond = rests(n, percent)
            for a, z in zip(first.tolist(), np.append(first[1:], len(token)).tolist()):
                if z - a < 2:
                    continue
                gn, gc, gs, gr = n[a:z], cls[a:z], shared[a:z], beyond[a:z]
                while len(gn) > 1:
                    ok = leave(gn, gs, gr)
                    if ok.all():
                        break
                    gn, gc, gs, gr = gn[ok], gc[ok], gs[ok], gr[ok]
                if len(gn) < 2:
                    continue
                head = int(np.lexsort((gc, gn, -((gs + gr) / gn)))[0])
                lead = (int(gc[head]), int(gn[head]), int(gs[head]))
                for x in zip(gc.tolist(), gn.tolist(), gs.tolist()):
                    k = lead + x
                    found[k] = found.get(k, 0) + 1
                if len(found) > 100_000:
                    yield out()

        for b in batches:
            cols = [np.concatenate((r, b.column(k).to_numpy(zero_copy_only=False))) for k, r in enumerate(rest)]
            cut = int(np.searchsorted(cols[0], cols[0][-1])) if len(cols[0]) else 0
            rest = [c[cut:] for c in cols]              # the last group may go on in the next batch
            if cut:
                yield from groups(*(c[:cut] for c in cols))
        if len(rest[0]):
            yield from groups(*rest)
        yield out()

    spread = tokens.repartition(parts, "token").sortWithinPartitions("token", "n", "cls")
    found = spread.select("token", "n", "cls", "shared").mapInArrow(run, "leader long, cls long, n long, able boolean, hits long")
    return found.groupBy("leader", "cls", "n", "able").agg(F.sum("hits").alias("hits"))


def _stars(families: DataFrame) -> DataFrame:
    """(a, b): every class with the leader it shares the most tokens with, where that pair can link."""
    return families.where("able").groupBy("cls").agg(F.max_by("leader", F.struct("hits", "leader")).alias("b")).select(F.col("cls").alias("a"), "b")


def _crossing(families: DataFrame, comp: DataFrame) -> DataFrame:
    """(family, cls, n, comp): families that still hold several components.  Leaders
    that share classes become one family by one step to the smallest leader."""
    rows = families.select("leader", "cls", "n").join(comp.select(F.col("node").alias("cls"), "component"), "cls", "left")
    rows = materialise(rows.select("leader", "cls", "n", F.coalesce("component", "cls").alias("comp")))
    open_ = rows.groupBy("leader").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x < y").select("leader")
    rows = materialise(rows.join(open_, "leader", "left_semi"))
    least = rows.groupBy("cls").agg(F.min("leader").alias("least"))
    step = rows.join(least, "cls").groupBy("leader").agg(F.min("least").alias("family"))
    return rows.join(step, "leader").select("family", "cls", "n", "comp").distinct()


def _blocks(crossing: DataFrame, most: int, parts: int) -> DataFrame:
    """The classes of a family, ordered by component and size, in blocks of bounded total size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, block, held = None, 0, 0
        for b in batches:
            number = []
            for family, n in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if family != now:
                    now, block, held = family, 0, 0
                elif held + n > most:
                    block, held = block + 1, 0
                held += n
                number.append(block)
            yield pa.record_batch([*b.columns, pa.array(number, pa.int64())], names=["family", "cls", "n", "comp", "block"])

    order = crossing.repartition(parts, "family").sortWithinPartitions("family", "comp", "n", "cls")
    return materialise(order.mapInArrow(run, "family long, cls long, n long, comp long, block long"))


def _cross_links(blocks: DataFrame, sets: DataFrame, percent: int, parts: int) -> DataFrame:
    """(a, b): links that join different components of a family, from pairs of its
    blocks; a pair that earlier links of the same task connect is not compared."""
    stat = blocks.groupBy("family", "block").agg(
        F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.min("n").alias("n0"), F.max("n").alias("n1"))
    i, j = stat.alias("i"), stat.alias("j")
    tasks = i.join(j, (F.col("i.family") == F.col("j.family")) & (F.col("i.block") <= F.col("j.block")))
    tasks = tasks.where((F.least("i.c0", "j.c0") < F.greatest("i.c1", "j.c1"))
                        & (100 * F.col("i.n1") >= percent * F.col("j.n0")) & (100 * F.col("j.n1") >= percent * F.col("i.n0")))
    tasks = materialise(tasks.select(F.col("i.family").alias("family"), F.col("i.block").alias("bi"), F.col("j.block").alias("bj")))
    sides = tasks.select("family", "bi", "bj", F.explode(F.array_distinct(F.array("bi", "bj"))).alias("block"))
    wanted = blocks.join(sides, ["family", "block"]).select("family", "bi", "bj", "block", "cls", "comp")
    rows = wanted.join(sets, "cls").select(
        F.struct("family", "bi", "bj").alias("task"), (F.col("block") > F.col("bi")).alias("right"), "cls", "comp", "grams")

    def work(part):
        part.sort(key=lambda r: (r[0], r[2], r[1]))
        cls = [r[1] for r in part]
        right = np.array([r[0] for r in part])
        roots = np.array([r[2] for r in part], dtype=np.int64)
        raw = np.zeros((sum(len(r[3]) for r in part) // 6, 8), dtype=np.uint8)
        raw[:, :6] = np.frombuffer(b"".join(r[3] for r in part), dtype=np.uint8).reshape(-1, 6)
        size = np.array([len(r[3]) // 6 for r in part], dtype=np.int64)
        part.clear()
        seen, grams = np.unique(raw.view(np.uint64).ravel(), return_inverse=True)
        del raw
        first = np.concatenate(([0], np.cumsum(size)))
        mark = np.zeros(len(seen), dtype=bool)
        others = np.flatnonzero(right) if right.any() else None
        found = []
        for k in range(len(cls)):
            if others is not None and right[k]:
                break
            rest = others if others is not None else np.arange(k + 1, len(cls))
            rest = rest[(roots[rest] != roots[k]) & (100 * np.minimum(size[rest], size[k]) >= percent * np.maximum(size[rest], size[k]))]
            if not len(rest):
                continue
            mark[grams[first[k]:first[k + 1]]] = True
            for lo in range(0, len(rest), 4096):
                some = rest[lo:lo + 4096]
                at = np.concatenate(([0], np.cumsum(size[some])[:-1]))
                both = np.add.reduceat(mark[np.concatenate([grams[first[x]:first[x + 1]] for x in some])].astype(np.int32), at)
                for x in some[100 * both >= percent * (size[some] + size[k] - both)].tolist():
                    if roots[x] != roots[k]:
                        found.append((cls[k], cls[x]))
                        roots[roots == roots[x]] = roots[k]
            mark[grams[first[k]:first[k + 1]]] = False
        yield pa.record_batch([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    flat = rows.select(F.concat_ws(":", "task.family", "task.bi", "task.bj").alias("task"), "right", "cls", "comp", "grams")
    return _by_key(flat.repartition(parts, "task").sortWithinPartitions("task"), work, "a long, b long")


def _class_sets(rows: DataFrame, members: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(cls, grams): the 48 low bits of the n-grams of every wanted class, from its
    first document; of the texts of a repeated id only the one with the class's digest counts."""
    chosen = materialise(members.groupBy("cls").agg(F.min("id").alias("id")).join(wanted, "cls", "left_semi").select("id", "cls"))
    if chosen.count() <= BROADCAST_CLASSES:
        chosen = F.broadcast(chosen)
    picked = rows.join(chosen, "id").select("cls", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cls, blobs = [], []
            for c, (_, s) in zip(b.column(0).to_pylist(), _sets(b, 1, n)):
                if len(s) and class_of(s) == c:
                    cls.append(c)
                    blobs.append(np.unique(s & np.uint64((1 << 48) - 1)).view(np.uint8).reshape(-1, 8)[:, :6].tobytes())
            yield pa.record_batch([pa.array(cls, pa.int64()), pa.array(blobs, pa.binary())], names=["cls", "grams"])

    return materialise(picked.mapInArrow(run, "cls long, grams binary").dropDuplicates(["cls"]))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    def grams(blob: bytes) -> np.ndarray:
        x = np.zeros((len(blob) // 6, 8), dtype=np.uint8)
        x[:, :6] = np.frombuffer(blob, dtype=np.uint8).reshape(-1, 6)
        return x.view(np.uint64).ravel()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            linked = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                x, y = grams(x), grams(y)
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            t = pa.Table.from_batches([b]).select([0, 1]).filter(pa.array(linked, pa.bool_()))
            yield from t.to_batches()

    j = (pairs.join(sets.select(F.col("cls").alias("a"), F.col("grams").alias("ga")), "a")
         .join(sets.select(F.col("cls").alias("b"), F.col("grams").alias("gb")), "b"))
    return j.select("a", "b", "ga", "gb").mapInArrow(run, "a long, b long")


def ngram_jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 75,
                       hot: int = 64, block_grams: int = BLOCK_GRAMS) -> DataFrame:
    """(id, n_shingles, component_id) for every distinct id."""
    parts = n_partitions(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    members = materialise(_members(rows, n))
    known = members.where("id IS NOT NULL AND cls IS NOT NULL")
    usable = rows.where("id IS NOT NULL AND text IS NOT NULL")
    shared = _shared(_zones(usable, n, percent, parts), hot, parts)
    tokens = materialise(_prefixes(shared, percent, parts))
    families = materialise(_families(tokens, percent, parts))
    sets = _class_sets(usable, known, families.select("cls").distinct(), n)
    edges = materialise(_verified(_stars(families), sets, percent))
    blocks = _blocks(_crossing(families, components(edges)), block_grams, parts)
    more = materialise(edges.unionByName(_cross_links(blocks, sets, percent, parts)))
    comp = components(more)
    # components by class; the component's number is the smallest id of its documents
    owner = known.join(comp, known["cls"] == comp["node"], "left").withColumn("root", F.coalesce("component", "cls"))
    first = owner.groupBy("root").agg(F.min("id").alias("component_id"))
    found = materialise(owner.select("id", "root")).join(materialise(first), "root").groupBy("id").agg(F.min("component_id").alias("component_id"))
    sizes = members.where("id IS NOT NULL").groupBy("id").agg(F.max("n").alias("n_shingles"))
    return (sizes.join(found, "id", "left")
            .select("id", "n_shingles", F.coalesce("component_id", "id").alias("component_id")))
