"""Best-fit decreasing packing of token pieces into sequences.

Documents are tokenised, cut where longer than a sequence, and packed longest
first, each piece into the open sequence with the least room that still holds
it.  A segment tree over the remaining capacities finds that sequence in
logarithmic time.  Pieces of one length are interchangeable, so the tree runs
over the table of piece counts by length (at most ``capacity`` rows, whatever
the corpus) and places whole runs; a piece then finds its sequence and offset
from its rank among the pieces of its length.  The result is that of one
best-fit decreasing pass over all pieces of the corpus.

Defined cases: a null or empty text is its end token alone; repeated rows are
packed as often as they are there; an empty table gives no rows; other columns
play no part, whatever their names; a very long text is cut into pieces.
"""

from __future__ import annotations

import base64
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from judicata.llm.common import materialise

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, idx long"


class CapacityTree:
    """Segment tree over remaining capacities; a leaf holds the runs of open
    sequences with exactly that room, an inner node how many runs are below."""

    def __init__(self, capacity: int):
        self.size = 1
        while self.size <= capacity:
            self.size *= 2
        self.count = [0] * (2 * self.size)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, by: int) -> None:
        node = room + self.size
        while node:
            self.count[node] += by
            node //= 2

    def push(self, room: int, first: int, n: int) -> None:
        if n > 0 and room > 0:
            self.runs[room].append((first, n))
            self._add(room, 1)

    def pop(self, room: int) -> tuple[int, int]:
        self._add(room, -1)
        return self.runs[room].pop()

    def tightest(self, length: int) -> int | None:
        """The smallest room of at least ``length`` that an open sequence has."""
        node = length + self.size
        if not self.count[node]:
            while node > 1 and not (node % 2 == 0 and self.count[node + 1]):
                node //= 2
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        return node - self.size


def best_fit_plan(counts: dict[int, int], capacity: int) -> dict[str, np.ndarray]:
    """Placements (length, rank0, n, seq0, per, offset): the pieces of that
    length with ranks rank0 .. rank0 + n - 1 go ``per`` to a sequence, from
    sequence seq0 and place ``offset`` on."""
    tree, rows, opened = CapacityTree(capacity), [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0

        def put(first: int, n_seq: int, per: int, room: int) -> None:
            nonlocal left, rank
            rows.append((length, rank, n_seq * per, first, per, capacity - room))
            rank += n_seq * per
            left -= n_seq * per
            tree.push(room - per * length, first, n_seq)

        while left:
            room = tree.tightest(length)
            if room is None:
                room, first, n = capacity, opened, -(-left // (capacity // length))
                opened += n
            else:
                first, n = tree.pop(room)
            per = room // length            # a sequence that takes one piece is then the tightest until it is full
            full = min(n, left // per)
            if full:
                put(first, full, per, room)
            if left and full < n:
                put(first + full, 1, left, room)
                full += 1
            tree.push(room, first + full, n - full)
    cols = list(zip(*rows)) if rows else [[]] * 6
    return {k: np.array(v, dtype=np.int64) for k, v in zip(("length", "rank0", "n", "seq0", "per", "offset"), cols)}


def token_encoder(json_path: str, ranks_path: str, pattern: str):
    """text -> array of ids, as the tokenizer file gives them without special tokens added.

    The rank file holds the same vocabulary and encodes several times faster;
    a text that spells a special token goes through the tokenizer file itself,
    which gives it the special id."""
    import tiktoken
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(json_path)
    special = [t.content for t in slow.get_added_tokens_decoder().values()]
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> array:
        if any(s in text for s in special):
            return array("I", slow.encode(text, add_special_tokens=False).ids)
        return array("I", fast.encode_ordinary(text))
    return encode


def default_encoder():
    import public_tokenizers as P
    return token_encoder(P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids; only the first may be shorter."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity
    return ([(0, first)] if first else []) + [(s, capacity) for s in range(first, n, capacity)]


def token_pieces(docs: DataFrame, id_col: str, text_col: str, capacity: int, end_id: int, encoder) -> DataFrame:
    """One row per piece, with its task and its number among the pieces of its
    length there; written once, so tokenising runs once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, encode, seen = TaskContext.get().partitionId(), encoder(), {}
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py() or "")
                ids.append(end_id)
                data = memoryview(ids).cast("B")
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    idx = seen.get(length, 0)
                    seen[length] = idx + 1
                    crc = zlib.crc32(data[4 * start:4 * (start + length)])
                    for col, v in zip(out, (doc, k, start, length, crc, part, idx)):
                        col.append(v)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(out, (
                pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()))],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "idx"])

    return materialise(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
                       .mapInArrow(run, PIECES))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024, end_id: int = 2,
         encoder=default_encoder) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece."""
    pieces = token_pieces(docs, id_col, text_col, capacity, end_id, encoder)
    by_task = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    by_task = by_task.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    # at most one row per length up to the capacity
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = best_fit_plan(counts, capacity)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((plan["rank0"], plan["length"]))
        p = {k: v[order] for k, v in plan.items()}
        stride = int(p["rank0"].max()) + int(p["n"].max()) + 1 if len(order) else 1
        keys = p["length"] * stride + p["rank0"]
        for b in batches:
            length = b.column("length").to_numpy()
            rank = b.column("rank").to_numpy()
            at = np.searchsorted(keys, length * stride + rank, side="right") - 1
            j = rank - p["rank0"][at]
            seq = p["seq0"][at] + j // p["per"][at]
            off = p["offset"][at] + j % p["per"][at] * length
            cols = [b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.record_batch([*cols, pa.array(seq, pa.int64()), pa.array(off, pa.int64())],
                                  names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    ranked = (pieces.join(by_task.drop("n"), ["part", "length"])
              .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("idx")).alias("rank")))
    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                    "sequence_id long, offset long")
