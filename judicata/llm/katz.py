"""LM scoring by Katz backoff over Good-Turing discounted n-gram counts.

P(w | h) is d(c) c(h, w) / c(h) where the n-gram was seen and a(h) P(w | h') where
it was not, h' being h without its first word; a(h) shares out exactly what the
discounts of h leave, so that every P(. | h) sums to 1.  Below the words stands
one unknown word with what the discounts of all words leave.  Counts up
to 5 are discounted by Good-Turing as far as their counts of counts allow it
(:func:`discounts`); where no count of a history is discounted one is added to its total.

Texts are cut into blocks of tokens, written once as packed numbers.  Level by level
a block sends every different n-gram it holds, its count in training texts and
P(w | h'), to the table of the level, which is partitioned by history.  A
partition adds the counts of all blocks and answers every block in the order
it was asked: count, number for the next level, and of every history its total, its
counts of counts and the sum of P(w | h') over its n-grams, which give a(h).  So
every token is evaluated recursively from what its block was told, and an n-gram
crosses the network once a block, not once a token.  A history with very many tokens
is spread over several partitions by its words, and its few numbers are added up afterwards.

All counts cover all training texts: no cut-off, no pruning, no vocabulary bound.

Defined cases: a null or empty text is its end token alone; rows that repeat, also
by id, are texts of their own; a row without id is a training text; words are told apart by 64
bits of a hash; a text of any length is cut into blocks and its parts are added;
without training texts every token is the unknown word of probability 1; an
empty table gives no rows; other columns are left out whatever their names."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from judicata.llm.common import materialise, n_partitions
from judicata.llm.wordhash import Words, mix

BLOCK_TOKENS = 2 << 20
#: Texts are hashed in pieces of about this many bytes, cut at white space.
PIECE_BYTES = 2 << 20
#: N-grams a partition of a table receives, about; tokens above which a history is spread; most histories that are.
BUCKET, HOT_TOKENS, HOT_MOST = 2 << 20, 4 << 20, 50_000
#: Counts that are discounted.
DISCOUNTED = 5
END = np.uint64(0x0E0D)
SPACE = re.compile(rb"[\x20\x09-\x0D]")


def pack(x: np.ndarray) -> bytes:
    """Non-negative whole numbers by byte planes, so that what is always zero costs nothing."""
    x = np.ascontiguousarray(x, dtype="<u8")
    width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    planes = x.view(np.uint8).reshape(-1, 8).T[:width]
    return bytes([width]) + len(x).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(blob: bytes) -> np.ndarray:
    width, n = blob[0], int.from_bytes(blob[1:9], "little")
    raw = np.frombuffer(pa.decompress(blob[9:], width * n, codec="zstd", asbytes=True), dtype=np.uint8).reshape(width, n)
    out = np.zeros((n, 8), dtype=np.uint8)
    out[:, :width] = raw.T
    return out.reshape(-1).view("<i8")


def pack_floats(x: np.ndarray) -> bytes:
    """Doubles as they are: the same few follow each other again and again."""
    return len(x).to_bytes(8, "little") + pa.compress(x.astype("<f8").tobytes(), codec="zstd", asbytes=True)


def unpack_floats(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[:8], "little")
    return np.frombuffer(pa.decompress(blob[8:], 8 * n, codec="zstd", asbytes=True), dtype="<f8")


def discounts(n: list[int]) -> list[float] | None:
    """Good-Turing ratios d(1), d(2), ... from n(1) to n(DISCOUNTED + 1), the numbers of
    n-grams seen so often; for the most counts for which all lie between 0 and 1.
    None: for none; then one half is taken off every count."""
    for most in range(DISCOUNTED, 0, -1):
        if min(n[:most + 1]) > 0:
            x = (most + 1) * n[most] / n[0]
            if x != 1:
                d = [((r + 1) * n[r] / (r * n[r - 1]) - x) / (1 - x) for r in range(1, most + 1)]
                if all(0 < v < 1 for v in d):
                    return d
    return None


def factor(count: np.ndarray, d: list[float] | None) -> np.ndarray:
    """d(c) by count."""
    if d is None:
        return (count - 0.5) / np.maximum(count, 1)
    table = np.array([0.0, *d, 1.0])
    return table[np.minimum(count, len(d) + 1)]


def left_over(by_count: np.ndarray, seen: np.ndarray, d: list[float] | None) -> np.ndarray:
    """What the discounts of a history leave, as a count; ``by_count``: its n-grams seen once, twice, ..."""
    if d is None:
        return 0.5 * seen
    return by_count[:, :len(d)] @ np.array([(1 - v) * r for r, v in enumerate(d, 1)])


# ---------------------------------------------------------------- blocks

BLOCK = ("block long, key array<long>, id array<long>, held binary, handed binary, whole binary, length binary, tokens binary, "
         "words binary, n_words long, n_tokens long, n_texts long")


def _pieces(data: bytes) -> Iterator[bytes]:
    at = 0
    while len(data) - at > PIECE_BYTES:
        cut = SPACE.search(data, at + PIECE_BYTES)
        if cut is None:
            break
        yield data[at:cut.start()]
        at = cut.start()
    yield data[at:]


def blocks(docs: DataFrame, id_col: str, text_col: str, held_out: Column, context: int) -> DataFrame:
    """Packed token blocks; a text that goes on in the next block hands over ``context`` tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        key = TaskContext.get().partitionId() << 40
        parts: list[tuple] = []                 # key, id, held, tokens handed over, whole, hashes, first
        held_tokens = 0

        def flush() -> pa.RecordBatch:
            nonlocal held_tokens, number
            number += 1
            words, tokens, count = np.unique(np.concatenate([p[5] for p in parts]), return_inverse=True, return_counts=True)
            order = np.argsort(-count, kind="stable")          # frequent words get small numbers
            place = np.empty_like(order)
            place[order] = np.arange(len(order))
            flags = [bytes(p[k] for p in parts) for k in (2, 3, 4)]
            row = [number, [p[0] for p in parts], [p[1] for p in parts], *flags, pack(np.array([len(p[5]) for p in parts])),
                   pack(place[tokens]), words[order].tobytes(), len(words), len(tokens), sum(p[6] for p in parts)]
            parts.clear()
            held_tokens = 0
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), *[pa.binary()] * 6, *[pa.int64()] * 3]
            return pa.record_batch([pa.array([v], k) for v, k in zip(row, kinds)], names=[f.split()[0] for f in BLOCK.split(", ")])

        def groups(b: pa.RecordBatch) -> Iterator[tuple]:
            """(row, hashes, is the first piece, is the last): short texts hashed together, long ones piece by piece."""
            some: list[tuple] = []
            size = 0
            for i in range(b.num_rows):
                data = (b.column(2)[i].as_py() or "").encode()
                if len(data) > PIECE_BYTES:
                    first = True
                    for piece in _pieces(data):
                        yield i, Words([piece], lower=True).hash, first, False
                        first = False
                    yield i, np.zeros(0, dtype=np.uint64), False, True
                    continue
                some.append((i, data))
                size += len(data)
                if size > PIECE_BYTES or i == b.num_rows - 1:
                    yield from together(some)
                    some, size = [], 0
            yield from together(some)

        def together(some: list[tuple]) -> Iterator[tuple]:
            if some:
                w = Words([data for _, data in some], lower=True)
                for k, (i, _) in enumerate(some):
                    yield i, w.hash[w.first[k]:w.first[k + 1]], True, True

        for b in batches:
            ids, outs = b.column(0).to_pylist(), b.column(1).to_pylist()
            for i, hashes, first, last in groups(b):
                if first:
                    key += 1
                    tail = np.zeros(0, dtype=np.uint64)
                if last:
                    hashes = np.append(hashes, END)
                parts.append((key, ids[i], bool(outs[i]), len(tail), first and last, np.concatenate((tail, hashes)), first))
                held_tokens += len(parts[-1][5])
                tail = parts[-1][5][-context:] if context else tail
                if held_tokens >= BLOCK_TOKENS:
                    yield flush()
        if parts:
            yield flush()

    return docs.select(F.col(id_col).cast("long"), held_out, F.col(text_col)).mapInArrow(run, BLOCK)


# ---------------------------------------------------------------- what a block knows


@dataclass
class Told:
    """Answers about the n-grams of one level, in the block's own order of them."""
    count: np.ndarray
    number: np.ndarray
    p: np.ndarray


@dataclass
class Level:
    """What every block must know of a level: discounts, totals, histories that are spread."""
    d: list[float] | None
    total: int
    distinct: int
    by_count: list[int]
    hot: dict[str, np.ndarray]


class Block:
    """Tokens of a block and, level by level, its different n-grams."""

    def __init__(self, row: dict):
        self.number, self.key, self.id = row["block"], row["key"], row["id"]
        self.held, self.whole = (np.frombuffer(row[c], dtype=np.uint8).astype(bool) for c in ("held", "whole"))
        self.handed = np.frombuffer(row["handed"], dtype=np.uint8)
        self.length = unpack(row["length"])
        self.word = unpack(row["tokens"]).astype(np.int32)
        self.words = np.frombuffer(row["words"], dtype="<u8")
        self.part = np.repeat(np.arange(len(self.length), dtype=np.int32), self.length)
        self.first = np.cumsum(self.length) - self.length

    def own(self) -> np.ndarray:
        """Tokens that are not handed over by the part before."""
        return np.arange(len(self.word)) - np.repeat(self.first, self.length) >= self.handed[self.part]

    def grams(self, level: int, below: tuple | None, told: Told | None, words: Told | None, counted: np.ndarray) -> tuple:
        """(history, word) of every different n-gram as the table knows them, training
        counts, P of the next lower level, tokens of its history, and the n-gram of every token."""
        if level == 1:
            of, n = self.word, len(self.words)
            h, w = np.zeros(n, dtype=np.int64), self.words
            low, mass = np.ones(n), np.zeros(n, dtype=np.int64)
        else:
            n_below, of_below = len(told.count), below[-1]
            before = np.empty(len(self.word), dtype=np.int64)
            before[1:] = of_below[:-1]
            before[self.first[self.length > 0]] = n_below                  # the start of a text
            code, of = np.unique(before * len(self.words) + self.word, return_inverse=True)
            mine, word = np.divmod(code, len(self.words))
            # P(w | h'): the n-gram of the level below at any of its tokens
            some = np.zeros(len(code), dtype=np.int64)
            some[of] = np.arange(len(of))
            low = told.p[of_below[some]]
            h = np.append(told.number, -1)[mine]
            w = words.number[word]
            mass = np.append(told.count, 0)[mine]
        count = np.bincount(of[counted], minlength=len(h))
        return h, w, count, low, mass, of


def _bucket(h: np.ndarray, w: np.ndarray, parts: np.ndarray, n: int, level: int) -> np.ndarray:
    if level == 1:
        return (mix(w.astype(np.uint64)) % np.uint64(n)).astype(np.int64)
    spread = mix(w.astype(np.uint64)) % parts.astype(np.uint64)
    return ((mix(h.astype(np.uint64)) + spread) % np.uint64(n)).astype(np.int64)


def _sorted(grams: tuple, n_buckets: int, limit: int, starts: int, level: int) -> tuple:
    """Order in which a block sends its n-grams, and (bucket, spread) of each in that order."""
    h, w, _, _, mass, _ = grams
    parts = 1 + np.where(h == -1, starts, mass) // limit if level > 1 else np.ones(len(h), dtype=np.int64)
    to = 2 * _bucket(h, w, np.minimum(parts, n_buckets), n_buckets, level) + (parts > 1)
    order = np.lexsort((w, h, to))
    return order, to[order]


SENT = "bucket int, block long, hot boolean, heads binary, runs binary, words binary, counts binary, low binary"
REPLY = ("level int, bucket int, block long, hot boolean, counts binary, numbers binary, totals binary, sums binary, by_count binary, "
         "stats array<long>")


def _edges(*columns: np.ndarray) -> np.ndarray:
    """Places where any of the columns changes, the first included."""
    if not len(columns[0]):
        return np.zeros(0, dtype=np.int64)
    change = np.zeros(len(columns[0]), dtype=bool)
    change[0] = True
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(change)


def _send(block: Block, grams: tuple, order: np.ndarray, to: np.ndarray, level: int) -> pa.RecordBatch:
    h, w, count, low = (c[order] for c in grams[:4])
    rows: list[tuple] = []
    cut = _edges(to)
    for a, b in zip(cut, np.append(cut[1:], len(to))):
        head = _edges(h[a:b])
        heads = h[a:b][head] + 1                # the start of a text is -1
        rows.append((int(to[a]) // 2, block.number, bool(to[a] & 1), pack(np.diff(heads, prepend=0)), pack(np.diff(np.append(head, b - a))),
                     w[a:b].tobytes() if level == 1 else pack(w[a:b]), pack(count[a:b]), b"" if level == 1 else pack_floats(low[a:b])))
    cols = list(zip(*rows)) or [()] * 8
    kinds = [pa.int32(), pa.int64(), pa.bool_(), *[pa.binary()] * 5]
    return pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)], names=[f.split()[0] for f in SENT.split(", ")])


def _merge(level: int, numbered: bool):
    """The work of one partition of a table: add up what all blocks sent, answer each."""
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        rows.sort(key=lambda r: (r["block"], r["hot"]))
        heads = [np.cumsum(unpack(r["heads"])) - 1 for r in rows]
        runs = [unpack(r["runs"]) for r in rows]
        h = np.concatenate([np.repeat(a, b) for a, b in zip(heads, runs)])
        w = np.concatenate([np.frombuffer(r["words"], dtype="<u8") if level == 1 else unpack(r["words"]) for r in rows])
        count = np.concatenate([unpack(r["counts"]) for r in rows])
        low = np.zeros(len(h)) if level == 1 else np.concatenate([unpack_floats(r["low"]) for r in rows])
        size = [int(b.sum()) for b in runs]
        order = np.lexsort((w, h))
        start = _edges(h[order], w[order])
        gram = np.empty(len(h), dtype=np.int64)
        gram[order] = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(h))))
        total = np.add.reduceat(count[order], start) if len(start) else np.zeros(0, dtype=np.int64)
        head_of, seen = h[order][start], total > 0
        first = _edges(head_of)
        add = lambda x: np.add.reduceat(x, first) if len(first) else x[:0]      # noqa: E731
        name = head_of[first]
        totals, sums = add(total), add(np.where(seen, low[order][start], 0.0))
        by_count = np.stack([add((total == r).astype(np.int64)) for r in range(1, DISCOUNTED + 1)] + [add(seen.astype(np.int64))], axis=1)
        is_hot = np.zeros(len(name), dtype=bool)
        for r, a in zip(rows, heads):
            if r["hot"]:
                is_hot[np.searchsorted(name, a)] = True
        bucket = rows[0]["bucket"]
        stats = [int(total.sum()), int(seen.sum()), *(int((total == r).sum()) for r in range(1, DISCOUNTED + 2))]
        out, at = [], 0
        for r, a, n in zip(rows, heads, size):
            mine, own = gram[at:at + n], np.searchsorted(name, a)
            at += n
            told = (b"", b"", b"") if r["hot"] or level == 1 else (pack(totals[own]), pack_floats(sums[own]), pack(by_count[own].reshape(-1)))
            out.append((level, bucket, r["block"], r["hot"], pack(total[mine]), pack(mine + (bucket << 32)) if numbered else b"", *told,
                        stats if at == n else None))
        if is_hot.any():
            out.append((level, bucket, None, True, b"", pack(name[is_hot] + 1), pack(totals[is_hot]), pack_floats(sums[is_hot]),
                        pack(by_count[is_hot].reshape(-1)), None))
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.bool_(), *[pa.binary()] * 5, pa.list_(pa.int64())]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=[f.split()[0] for f in REPLY.split(", ")])

    return run


def _told(block: Block, grams: tuple, order: np.ndarray, replies: list[dict], level: int, known: Level) -> Told:
    """Probabilities of the block's n-grams of one level from the answers to it."""
    replies = sorted(replies, key=lambda r: (r["bucket"], r["hot"]))
    count = np.concatenate([unpack(r["counts"]) for r in replies])
    numbers = np.concatenate([unpack(r["numbers"]) if r["numbers"] else np.zeros(0, dtype=np.int64) for r in replies])
    h, low = grams[0][order], grams[3][order]
    if level == 1:
        total = np.full(len(h), known.total)
        sums, by_count = np.zeros(len(h)), np.tile(np.array([*known.by_count[:DISCOUNTED], known.distinct]), (len(h), 1))
    else:
        totals, all_sums, counts, at = [], [], [], 0
        runs = []
        for r in replies:
            n = int.from_bytes(r["counts"][1:9], "little")
            head = _edges(h[at:at + n])
            runs.append(np.diff(np.append(head, n)))
            if r["hot"]:
                k = np.searchsorted(known.hot["h"], h[at:at + n][head])
                totals.append(known.hot["total"][k]), all_sums.append(known.hot["sum"][k]), counts.append(known.hot["by_count"][k])
            else:
                totals.append(unpack(r["totals"])), all_sums.append(unpack_floats(r["sums"]))
                counts.append(unpack(r["by_count"]).reshape(-1, DISCOUNTED + 1))
            at += n
        run = np.concatenate(runs)
        total, sums = np.repeat(np.concatenate(totals), run), np.repeat(np.concatenate(all_sums), run)
        by_count = np.repeat(np.concatenate(counts), run, axis=0)
    left = left_over(by_count, by_count[:, DISCOUNTED], known.d)
    plus = left == 0
    whole = total + plus
    seen = factor(count, known.d) * count / np.maximum(whole, 1)
    rest = (left + plus) / np.maximum(whole, 1) / np.maximum(1 - sums, np.finfo(float).tiny) * low
    p = np.where(count > 0, seen, np.where(total > 0, rest, low))
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    return Told(count[back], numbers[back] if len(numbers) else numbers, p[back])


class KatzModel:
    """Blocks of all texts and the answers of every level's table."""

    def __init__(self, source: DataFrame, order: int):
        self.spark, self.order, self.blocks = source.sparkSession, order, source
        self.levels: list[Level] = []
        self.plan: list[tuple[int, int, int]] = []          # partitions, tokens of a history that is not spread, texts
        self.replies: DataFrame | None = None
        n_words, n_tokens, n_texts = source.agg(F.sum("n_words"), F.sum("n_tokens"), F.sum("n_texts")).first()
        self.texts = n_texts or 0
        self.sizes = [n_words or 0, *[n_tokens or 0] * (order - 1)]

    def _climb(self, block: Block, replies: list[dict], upto: int) -> tuple[list, list[Told]]:
        """N-grams and answers of the levels below ``upto``."""
        counted = self._counted(block)
        grams, told = [], []
        for level in range(1, upto + 1):
            g = block.grams(level, grams[-1] if grams else None, told[-1] if told else None, told[0] if told else None, counted)
            grams.append(g)
            if level < upto:
                order, _ = _sorted(g, *self.plan[level - 1], level)
                told.append(_told(block, g, order, [r for r in replies if r["level"] == level], level, self.levels[level - 1]))
        return grams, told

    def _counted(self, block: Block) -> np.ndarray:
        return block.own() & ~block.held[block.part]

    def add_level(self) -> None:
        """Count the next level's n-grams over all blocks."""
        level = len(self.levels) + 1
        size = self.sizes[level - 1]
        n = max(1, -(-size // BUCKET), min(n_partitions(self.spark), -(-size // 100_000)))
        self.plan.append((n, max(HOT_TOKENS, -(-(self.sizes[-1] or 1) // HOT_MOST)), self.texts))
        light = _detached(self)

        def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for k in range(b.num_rows):
                    yield from_block(b.slice(k, 1).to_pylist()[0], [])

        def later(left: pa.Table, right: pa.Table) -> pa.Table:
            batches = [from_block(r, right.to_pylist()) for r in left.to_pylist()]
            return pa.Table.from_batches(batches, schema=None if batches else _schema())

        def from_block(row: dict, replies: list[dict]) -> pa.RecordBatch:
            block = Block(row)
            grams, _ = light._climb(block, replies, level)
            order, to = _sorted(grams[-1], *light.plan[level - 1], level)
            return _send(block, grams[-1], order, to, level)

        if level == 1:
            sent = self.blocks.mapInArrow(first, SENT)
        else:
            sent = self._beside().applyInArrow(later, SENT)
        reply = materialise(sent.groupBy("bucket").applyInArrow(_merge(level, level < self.order), REPLY))
        stats = reply.where("stats IS NOT NULL").agg(*[F.sum(F.col("stats")[k]) for k in range(DISCOUNTED + 3)]).first()
        stats = [v or 0 for v in stats]
        self.levels.append(Level(discounts(stats[2:]), stats[0], stats[1], stats[2:], _hot(reply)))
        answers = reply.where("block IS NOT NULL").drop("stats")
        self.replies = answers if self.replies is None else self.replies.unionByName(answers)

    def _beside(self):
        return self.blocks.groupBy("block").cogroup(self.replies.groupBy("block"))

    def score(self) -> DataFrame:
        """(key, id, held_out, n_tokens, n_known, base_score, score), one row per text."""
        light = _detached(self)

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            tables = [scored(Block(r), right.to_pylist()) for r in left.to_pylist()]
            return pa.concat_tables(tables) if tables else _scores([], [], [], [], np.zeros((4, 0)))

        def scored(block: Block, replies: list[dict]) -> pa.Table:
            grams, told = light.climb_all(block, replies)
            own = block.own()
            known = light.levels[0]
            count = told[0].count[grams[0][-1]]
            sums = [np.ones(len(count)), count > 0, np.log10((count + 1) / (known.total + known.distinct + 1)),
                    np.log10(told[-1].p[grams[-1][-1]])]
            return _scores(block.key, block.id, block.held, block.whole,
                           np.stack([np.bincount(block.part, weights=s * own, minlength=len(block.length)) for s in sums]))

        rows = materialise(self._beside().applyInArrow(run, SCORES))
        whole = rows.where("whole").drop("whole")
        cut = rows.where("NOT whole").groupBy("key", "id", "held_out").agg(
            *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")])
        return whole.unionByName(cut)

    def climb_all(self, block: Block, replies: list[dict]) -> tuple[list, list[Told]]:
        grams, told = self._climb(block, replies, self.order)
        order, _ = _sorted(grams[-1], *self.plan[-1], self.order)
        told.append(_told(block, grams[-1], order, [r for r in replies if r["level"] == self.order], self.order, self.levels[-1]))
        return grams, told


SCORES = "key long, id long, held_out boolean, whole boolean, n_tokens long, n_known long, base_score double, score double"


def _scores(key, ids, held, whole, sums: np.ndarray) -> pa.Table:
    return pa.table([pa.array(key, pa.int64()), pa.array(ids, pa.int64()), pa.array(held, pa.bool_()), pa.array(whole, pa.bool_()),
                     pa.array(sums[0].astype(np.int64)), pa.array(sums[1].astype(np.int64)), pa.array(sums[2]), pa.array(sums[3])],
                    names=[f.split()[0] for f in SCORES.split(", ")])


def _schema() -> pa.Schema:
    kinds = [pa.int32(), pa.int64(), pa.bool_(), *[pa.binary()] * 5]
    return pa.schema([pa.field(f.split()[0], k) for f, k in zip(SENT.split(", "), kinds)])


def _detached(model: KatzModel) -> KatzModel:
    """The model without its tables, for the workers."""
    light = object.__new__(KatzModel)
    light.order, light.levels, light.plan = model.order, list(model.levels), list(model.plan)
    return light


def _hot(reply: DataFrame) -> dict[str, np.ndarray]:
    """Totals of the histories that are spread over partitions: at most HOT_MOST rows after adding up."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                by_count = unpack(r["by_count"]).reshape(-1, DISCOUNTED + 1)
                yield pa.record_batch([pa.array(unpack(r["numbers"]) - 1), pa.array(unpack(r["totals"])), pa.array(unpack_floats(r["sums"])),
                                       *[pa.array(by_count[:, k]) for k in range(DISCOUNTED + 1)]], names=["h", "total", "sum", *names])

    names = [f"n{k}" for k in range(DISCOUNTED + 1)]
    rows = reply.where("block IS NULL").select("numbers", "totals", "sums", "by_count").mapInArrow(
        run, "h long, total long, sum double, " + ", ".join(f"{n} long" for n in names))
    rows = rows.groupBy("h").agg(*[F.sum(c).alias(c) for c in ("total", "sum", *names)]).orderBy("h").collect()
    return {"h": np.array([r["h"] for r in rows], dtype=np.int64), "total": np.array([r["total"] for r in rows], dtype=np.int64),
            "sum": np.array([r["sum"] for r in rows]), "by_count": np.array([[r[n] for n in names] for r in rows],
                                                                            dtype=np.int64).reshape(-1, DISCOUNTED + 1)}


def fit(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", order: int = 2) -> KatzModel:
    """Count the n-grams of the texts that are not held out, and of all texts what they need to know."""
    model = KatzModel(materialise(blocks(docs, id_col, text_col, held_out, order - 1)), order)
    for _ in range(order):
        model.add_level()
    return model
