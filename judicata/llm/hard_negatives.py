"""Hard-negative mining by segment summary filtering.

For every anchor the most similar other rows of its label are its positives; for
every positive the most similar rows of other labels whose score lies in a band
below the positive's score are its hard negatives.  Scores are inner products
of integer components, so that ties are exact.

Vectors are stored in blocks together with the mean and the deviation of every
segment, for few long segments and again for many short ones.  The product of
two segments lies within their means' product plus or minus the product of
their deviations (Cauchy-Schwarz on what is left of the means), so the sums of
these bound a score from both sides.  A pair is refined only while its bounds
leave it undecided: long segments, short segments, exact score.  What it must
beat is the anchor's k-th best score so far and, for negatives, the band of its
positives; the bounds are safe, so the result is the exact one.

Anchors are cut into chunks and blocks into slots; a task streams the blocks of
one slot past the anchors of one chunk and returns at most k rows an anchor (and
band), and a window over these few rows gives the result.  The number of
chunks and slots follows the counted rows, whatever labels they carry: a label
with a third of all rows is spread like any other.

Defined cases: rows whose id, label or vector is null, or whose vector holds a
null or non-finite component, take no part; equal rows (id, label, vector) count
once; different rows under one id are rows of their own, though never positives
of each other; vectors of different lengths are not compared, empty vectors have
score 0; ties go to the smaller id; components of any finite size are scored
exactly and scores beyond a long are held to its range; an anchor without
positives and a positive without negatives give no rows; an empty table gives
none; other columns of the table play no part, whatever their names."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from judicata.llm.common import materialise, n_partitions

#: Numbers of segments by level; a level is left out where vectors are no longer than it.
LEVELS = (4, 16)
BLOCK = 1024
CHUNK_ROWS, CHUNK_BYTES = 65_536, 32 << 20
SLOT_LEAST, SLOT_MOST = 4096, 524_288
TILE = 2048
#: Inner products up to this size, and 100 times them, are exact in double precision.
EXACT = 2.0 ** 46
FLOAT_ERROR = 4e-6


def _valid(vectors: DataFrame, id_col: str, vec_col: str, label_col: str, anchor: Column, scale: float) -> DataFrame:
    """(vec, label, anchor, emb): usable rows once, components floor(scale * x) as little-endian doubles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for i, lab, a, v in zip(*(b.column(k).to_pylist() for k in range(4))):
                if i is None or lab is None or v is None or None in v:
                    continue
                x = np.array(v, dtype="<f8")
                if np.isfinite(x).all():
                    with np.errstate(over="ignore"):
                        x = np.nan_to_num(np.floor(x * scale)) + 0.0        # no negative zero
                    out.append((i, lab, bool(a), x.tobytes()))
            cols = list(zip(*out)) or [(), (), (), ()]
            yield pa.record_batch([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()),
                                   pa.array(cols[2], pa.bool_()), pa.array(cols[3], pa.binary())],
                                  names=["vec", "label", "anchor", "emb"])

    rows = vectors.select(F.col(id_col).cast("long"), F.col(label_col).cast("string"), anchor, F.col(vec_col))
    return rows.mapInArrow(run, "vec long, label string, anchor boolean, emb binary").distinct()


def _narrow(x: np.ndarray) -> bytes:
    """The matrix in the narrowest type that holds it."""
    top = np.abs(x).max() if x.size else 0.0
    return x.astype("<i2" if top < 2 ** 15 else "<i4" if top < 2 ** 31 else "<f8").tobytes()


def _wide(blob: bytes, n: int, size: int) -> np.ndarray:
    if n * size == 0:
        return np.zeros((n, size))
    kind = {2: "<i2", 4: "<i4", 8: "<f8"}[len(blob) // (n * size)]
    return np.frombuffer(blob, dtype=kind).reshape(n, size).astype(np.float64)


def summaries(x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """By level: mean and deviation of every segment, both times the root of its length."""
    out = []
    for segments in LEVELS:
        if segments < x.shape[1]:
            cut = np.arange(segments) * x.shape[1] // segments
            length = np.diff(np.append(cut, x.shape[1]))
            mean = np.add.reduceat(x, cut, axis=1) / length
            rest = x - np.repeat(mean, length, axis=1)
            root = np.sqrt(length)
            out.append((mean * root, np.sqrt(np.add.reduceat(rest * rest, cut, axis=1))))
    return out


def _pack_summaries(x: np.ndarray) -> bytes:
    """Float32 is enough, as the bounds allow for its rounding."""
    with np.errstate(over="ignore"):
        parts = [np.hstack(level).astype("<f4") for level in summaries(x)]
    return np.hstack(parts).tobytes() if parts else b""


def _unpack_summaries(blob: bytes, n: int, size: int) -> list[tuple[np.ndarray, np.ndarray]]:
    widths = [s for s in LEVELS if s < size]
    if not widths:
        return []
    flat = np.frombuffer(blob, dtype="<f4").reshape(n, -1)
    out, at = [], 0
    for w in widths:
        out.append((flat[:, at:at + w], flat[:, at + w:at + 2 * w]))
        at += 2 * w
    return out


def _blocks(rows: DataFrame) -> DataFrame:
    """One row per block of up to BLOCK vectors of one length, sorted by label."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: dict[int, list[tuple]] = {}

        def block(size: int, rows: list[tuple]) -> pa.RecordBatch:
            nonlocal number
            rows.sort(key=lambda r: (r[1], r[0], r[3]))
            x = np.frombuffer(b"".join(r[3] for r in rows), dtype="<f8").reshape(len(rows), size)
            number += BLOCK
            return pa.record_batch(
                [pa.array([number], pa.int64()), pa.array([size], pa.int32()), pa.array([len(rows)], pa.int32()),
                 pa.array([sum(r[2] for r in rows)], pa.int32()), pa.array([np.array([r[0] for r in rows], dtype="<i8").tobytes()], pa.binary()),
                 pa.array([[r[1] for r in rows]], pa.list_(pa.string())), pa.array([bytes(r[2] for r in rows)], pa.binary()),
                 pa.array([_narrow(x)], pa.binary()), pa.array([_pack_summaries(x)], pa.binary())],
                names=["block", "size", "n", "n_anchors", "ids", "labels", "anchor", "emb", "sums"])

        for b in batches:
            for r in zip(*(b.column(k).to_pylist() for k in range(4))):
                size = len(r[3]) // 8
                mine = held.setdefault(size, [])
                mine.append(r)
                if len(mine) == BLOCK:
                    yield block(size, held.pop(size))
        for size, mine in held.items():
            yield block(size, mine)

    return rows.select("vec", "label", "anchor", "emb").mapInArrow(
        run, "block long, size int, n int, n_anchors int, ids binary, labels array<string>, anchor binary, emb binary, sums binary")


def _anchors(blocks: DataFrame) -> DataFrame:
    """One row per anchor, in the columns of a block of one vector; ``block`` is its key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for r in b.to_pylist():
                n, size = r["n"], r["size"]
                at = np.flatnonzero(np.frombuffer(r["anchor"], dtype=np.uint8))
                ids = np.frombuffer(r["ids"], dtype="<i8")
                width, wide = len(r["emb"]) // n, len(r["sums"]) // n
                out += [(r["block"] + int(k), size, 1, ids[k:k + 1].tobytes(), [r["labels"][k]], r["emb"][k * width:(k + 1) * width],
                         r["sums"][k * wide:(k + 1) * wide]) for k in at]
            cols = list(zip(*out)) or [()] * 7
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int32(), pa.binary(),
                                                                         pa.list_(pa.string()), pa.binary(), pa.binary()))],
                                  names=["block", "size", "n", "ids", "labels", "emb", "sums"])

    return (blocks.where("n_anchors > 0").select("block", "size", "n", "ids", "labels", "anchor", "emb", "sums")
            .mapInArrow(run, "block long, size int, n int, ids binary, labels array<string>, emb binary, sums binary"))


class _Best:
    """The first k of every group by falling score and rising id."""

    def __init__(self, groups: int, k: int):
        self.k, self.group = k, np.zeros(0, dtype=np.int64)
        self.score, self.ident = np.zeros(0), np.zeros(0, dtype=np.int64)
        self.least = np.full(groups, -np.inf)           # the k-th score, once there are k

    def add(self, group: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        if not len(group):
            return
        group, ident = np.concatenate((self.group, group)), np.concatenate((self.ident, ident))
        score = np.concatenate((self.score, score))
        height = np.unique(score, return_inverse=True)[1] if score.dtype == object else score
        order = np.lexsort((ident, -height, group))
        g = group[order]
        start = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1])))
        rank = np.arange(len(g)) - np.repeat(start, np.diff(np.append(start, len(g))))
        kept = order[rank < self.k]
        self.group, self.score, self.ident = group[kept], score[kept], ident[kept]
        full = order[rank == self.k - 1]
        self.least[group[full]] = score[full].astype(np.float64)


class _Chunk:
    """Anchors of one length, gathered before their blocks arrive."""

    def __init__(self, rows: list[dict], size: int, k: int, banded: bool):
        self.key = np.array([r["block"] for r in rows], dtype=np.int64)
        self.ids = np.frombuffer(b"".join(r["ids"] for r in rows), dtype="<i8")
        self.size, self.k, self.banded = size, k, banded
        self.x = np.vstack([_wide(r["emb"], 1, size) for r in rows])
        self.sums = [_unpack_summaries(r["sums"], 1, size) for r in rows]
        self.sums = [tuple(np.vstack([s[level][part] for s in self.sums]).astype(np.float64) for part in (0, 1))
                     for level in range(len(self.sums[0]))]
        self.norm = np.sqrt((self.x * self.x).sum(axis=1))
        names = sorted({r["labels"][0] for r in rows})
        self.code = {name: i for i, name in enumerate(names)}
        self.label = np.array([self.code[r["labels"][0]] for r in rows])
        self.high = np.full((len(rows), k), np.nan)             # scores of the positives, falling
        self.whole = np.zeros((len(rows), k), dtype=np.int64)
        if banded:
            for i, r in enumerate(rows):
                self.high[i, :len(r["scores"])] = self.whole[i, :len(r["scores"])] = r["scores"]
        self.best = _Best(len(rows) * (k if banded else 1), k)

    def bounds(self) -> tuple[np.ndarray, np.ndarray]:
        """By anchor: the least score that still matters, and the greatest."""
        if not self.banded:
            return self.best.least, np.full(len(self.key), np.inf)
        low = np.fmax(0.8 * self.high - 0.5, np.where(np.isnan(self.high), np.nan, self.best.least.reshape(self.high.shape)))
        return np.nanmin(low, axis=1), np.nanmax(self.high, axis=1)

    def meet(self, row: dict) -> None:
        """Score one block against all anchors as far as needed."""
        n = row["n"]
        y, ids = _wide(row["emb"], n, self.size), np.frombuffer(row["ids"], dtype="<i8")
        label = np.array([self.code.get(name, -1) for name in row["labels"]])
        sums = [(m.astype(np.float64), d.astype(np.float64)) for m, d in _unpack_summaries(row["sums"], n, self.size)]
        norm = np.sqrt((y * y).sum(axis=1))
        least, most = self.bounds()
        found: list[tuple] = []
        if self.banded:
            tiles = [(np.arange(t, min(t + TILE, len(self.key))), np.arange(n)) for t in range(0, len(self.key), TILE)]
        else:                                       # runs of one label against its anchors
            tiles = []
            for code in np.unique(label[label >= 0]):
                mine, run = np.flatnonzero(self.label == code), np.flatnonzero(label == code)
                tiles += [(mine[t:t + TILE], run) for t in range(0, len(mine), TILE)]
        for at, of in tiles:
            found.append(self._tile(at, of, y, ids, label, sums, norm, least, most))
        if found:
            self._take(*(np.concatenate(c) for c in zip(*found)))

    def _tile(self, at, of, y, ids, label, sums, norm, least, most):
        top = float(self.norm[at].max() * norm[of].max()) if len(at) and len(of) else 0.0
        fast = top < EXACT
        other = self.ids[at][:, None] != ids[of][None, :] if not self.banded else self.label[at][:, None] != label[of][None, :]
        i, j = np.nonzero(other) if not (fast and sums) else (None, None)
        slack = FLOAT_ERROR * top + 1.0
        if i is None:
            (am, ad), (bm, bd) = self.sums[0], sums[0]
            middle, spread = am[at] @ bm[of].T, ad[at] @ bd[of].T + slack
            i, j = np.nonzero(other & (middle + spread >= least[at][:, None]) & (middle - spread <= most[at][:, None]))
            if len(i) > 0.3 * other.size:           # most pairs are undecided: one product is cheaper than refining them
                score = (self.x[at] @ y[of].T)[i, j]
                hit = (score >= least[at][i]) & (score <= most[at][i])
                return at[i[hit]], score[hit], of[j[hit]], ids[of[j[hit]]]
            for (am, ad), (bm, bd) in zip(self.sums[1:], sums[1:]):
                a, b = at[i], of[j]
                middle = np.einsum("ij,ij->i", am[a], bm[b])
                spread = np.einsum("ij,ij->i", ad[a], bd[b]) + slack
                hit = (middle + spread >= least[a]) & (middle - spread <= most[a])
                i, j = i[hit], j[hit]
        a, b = at[i], of[j]
        if fast:
            score = np.concatenate([np.einsum("ij,ij->i", self.x[a[s:s + 65_536]], y[b[s:s + 65_536]])
                                    for s in range(0, len(a), 65_536)] or [np.zeros(0)])
        else:                                       # beyond double precision: whole numbers of any size
            ax, by = [[int(v) for v in r] for r in self.x], [[int(v) for v in r] for r in y]
            score = np.array([sum(p * q for p, q in zip(ax[p], by[q])) for p, q in zip(a, b)] or [], dtype=object)
        return a, score, b, ids[b]

    def _take(self, a: np.ndarray, score: np.ndarray, _: np.ndarray, ident: np.ndarray) -> None:
        if not self.banded:
            self.best.add(a, score, ident)
            return
        for band in range(self.k):
            high = self.whole[a, band].astype(score.dtype)
            hit = ~np.isnan(self.high[a, band]) & (score <= high) & (100 * score >= 80 * high)
            self.best.add(a[hit] * self.k + band, score[hit], ident[hit])

    def result(self) -> pa.RecordBatch:
        width = self.k if self.banded else 1
        score = [max(-2 ** 63, min(2 ** 63 - 1, int(s))) for s in self.best.score]
        return pa.record_batch([pa.array(self.key[self.best.group // width], pa.int64()), pa.array(self.best.group % width, pa.int64()),
                                pa.array(self.best.ident, pa.int64()), pa.array(score, pa.int64())],
                               names=["key", "band", "other", "score"])


FOUND = "key long, band long, other long, score long"


def _search(anchors: DataFrame, blocks: DataFrame, chunks: int, slots: int, k: int, banded: bool) -> DataFrame:
    """(key, band, other, score): the best of every slot, at most k by anchor and band."""
    scores = F.col("scores") if banded else F.lit(None).cast("array<long>")
    shape = ["chunk", "slot", "kind", "block", "size", "n", "ids", "labels", "emb", "sums", "scores"]
    left = (anchors.withColumn("scores", scores).withColumn("kind", F.lit(0))
            .withColumn("chunk", F.pmod(F.xxhash64("block"), F.lit(chunks)).cast("int"))
            .withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1)))))
    right = (blocks.withColumn("scores", F.lit(None).cast("array<long>")).withColumn("kind", F.lit(1))
             .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
             .withColumn("slot", F.pmod(F.xxhash64(F.lit("slot"), "block"), F.lit(slots)).cast("int")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, waiting, chunk = None, [], None
        for b in batches:
            for r in (row for k0 in range(b.num_rows) for row in b.slice(k0, 1).to_pylist()):
                here = (r["chunk"], r["slot"], r["size"])
                if here != at:
                    if chunk is not None:
                        yield chunk.result()
                    at, waiting, chunk = here, [], None
                if r["kind"] == 0:
                    waiting.append(r)
                elif waiting or chunk is not None:
                    if chunk is None:
                        chunk, waiting = _Chunk(waiting, r["size"], k, banded), []
                    chunk.meet(r)
        if chunk is not None:
            yield chunk.result()

    both = left.select(*shape).unionByName(right.select(*shape))
    return (both.repartition(max(1, min(chunks * slots, 4 * n_partitions(blocks.sparkSession))), "chunk", "slot")
            .sortWithinPartitions("chunk", "slot", "size", "kind", "block").mapInArrow(run, FOUND))


def _first(found: DataFrame, k: int) -> DataFrame:
    """The first k by key and band, with their rank."""
    w = Window.partitionBy("key", "band").orderBy(F.desc("score"), "other")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, anchor: Column, id_col: str = "vec_id", vec_col: str = "embedding",
                   label_col: str = "label", scale: float = 256.0, k: int = 5) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchor`` marks the rows that are anchors; the negatives of a positive score
    between 80 and 100 percent of it."""
    spark = vectors.sparkSession
    blocks = materialise(_blocks(_valid(vectors, id_col, vec_col, label_col, anchor, scale)))
    n, n_anchors, size = blocks.agg(F.sum("n"), F.sum("n_anchors"), F.max("size")).first()
    n, n_anchors, size = n or 0, n_anchors or 0, size or 0
    chunks = max(1, -(-n_anchors // max(1, min(CHUNK_ROWS, CHUNK_BYTES // (8 * max(1, size))))))
    slots = max(1, -(-n // max(SLOT_LEAST, min(SLOT_MOST, -(-n // n_partitions(spark))))))
    anchors = materialise(_anchors(blocks))
    body = blocks.select("block", "size", "n", "ids", "labels", "emb", "sums")
    positives = materialise(_first(_search(anchors, body, chunks, slots, k, False), k)
                            .select("key", F.col("other").alias("positive_id"), F.col("score").alias("positive_score"),
                                    (F.col("rank") - 1).cast("long").alias("band")))
    scores = positives.groupBy("key").agg(F.transform(F.sort_array(F.collect_list(F.struct("band", "positive_score"))),
                                                      lambda s: s["positive_score"]).alias("scores"))      # k at most
    banded = anchors.join(scores, anchors["block"] == scores["key"]).drop("key")
    negatives = _first(_search(banded, body, chunks, slots, k, True), k)
    return _named(anchors, positives, negatives)


def _named(anchors: DataFrame, positives: DataFrame, negatives: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = np.frombuffer(b"".join(b.column(1).to_pylist()), dtype="<i8")
            yield pa.record_batch([b.column(0), pa.array(ids, pa.int64())], names=["key", "anchor_id"])

    names = anchors.select("block", "ids").mapInArrow(run, "key long, anchor_id long")
    return (negatives.select("key", "band", "rank", F.col("other").alias("negative_id"), F.col("score").alias("negative_score"))
            .join(positives, ["key", "band"]).join(names, "key")
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"))
