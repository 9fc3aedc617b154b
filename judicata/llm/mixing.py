"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources they belong
to).  A flow network routes token capacity from patterns to source quotas: a
pattern's words come in quarter copies of rising cost, so repetition is spread
evenly and the cheapest, least repeated words go first.  The flow decides how
many words of every pattern are taken; documents are then chosen in a seeded
hash order, whole copies first, the rest of a copy up to the document that
brings the pattern nearest to its flow.

The driver holds one row per pattern and per source, no documents.

Defined cases: a null text has no words; a null source is a source, last in
order; a document without sources (empty pattern) is never taken; sources
without words have target 0; rows that repeat are documents of their own; an
empty table gives no documents and no sources; columns of any name pass through,
but for those named like the two new ones, which give way; of a very long text
only the number of words counts.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = r"[^\x20\x09-\x0D]+"
#: Words of a pattern come in this many equal parts of a copy, each dearer than the one before.
PARTS = 4
#: Hash buckets of a pattern's documents; only the bucket of the cut is sorted.
BUCKETS = 4096


def word_count(text: Column) -> Column:
    """Number of words: starts of a run of non-spaces, counted without building the words."""
    runs = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD))
    return runs.cast("long")


def quotas(sizes: dict, weights: dict, total: float, most: float) -> dict:
    """Shares of ``total`` by weight; none above ``most`` times its source's
    size, the excess is shared again by weight among the others."""
    target: dict = {}
    free, rest = dict(weights), float(total)
    while free:
        unit = rest / sum(free.values())
        over = [s for s in free if unit * free[s] > most * sizes[s]]
        if not over:
            return target | {s: unit * w for s, w in free.items()}
        for s in over:
            target[s] = most * float(sizes[s])
            rest -= target[s]
            del free[s]
    return target


def min_cost_flow(patterns: list[tuple[float, list[int]]], targets: list[float], copies: int) -> list[float]:
    """Words taken of each pattern (words, sources).  Successive cheapest paths;
    the network has a node per pattern and source."""
    n_p, n_s = len(patterns), len(targets)
    src, dst = n_p + n_s, n_p + n_s + 1
    arcs: list[list] = []           # to, room, cost
    out: list[list[int]] = [[] for _ in range(dst + 1)]

    def arc(a: int, b: int, room: float, cost: float) -> None:
        for x, y, r, c in ((a, b, room, cost), (b, a, 0.0, -cost)):
            out[x].append(len(arcs))
            arcs.append([y, r, c])

    for p, (words, members) in enumerate(patterns):
        for k in range(copies * PARTS if members else 0):
            arc(src, p, words / PARTS, k)
        for s in members:
            arc(p, n_p + s, float("inf"), 0)
    for s, t in enumerate(targets):
        arc(n_p + s, dst, t, 0)
    eps = 1e-9 * max([1.0, *targets])
    while True:
        cost, via, queue, queued = [float("inf")] * (dst + 1), [-1] * (dst + 1), deque([src]), {src}
        cost[src] = 0
        while queue:
            a = queue.popleft()
            queued.discard(a)
            for k in out[a]:
                b, room, c = arcs[k]
                if room > eps and cost[a] + c < cost[b] - 1e-12:
                    cost[b], via[b] = cost[a] + c, k
                    if b not in queued:
                        queue.append(b)
                        queued.add(b)
        if via[dst] < 0:
            break
        path, b = [], dst
        while b != src:
            path.append(via[b])
            b = arcs[via[b] ^ 1][0]
        room = min(arcs[k][1] for k in path)
        for k in path:
            arcs[k][1] -= room
            arcs[k ^ 1][1] += room
    return [sum(arcs[k][1] for k in out[p] if arcs[k][0] == src) for p in range(n_p)]


def mix(docs: DataFrame, pattern: Column, size: Column, id_col: str = "doc_id", seed: int = 42,
        weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: int = 2,
        copies_col: str = "copies", size_col: str = "size") -> tuple[DataFrame, DataFrame]:
    """(documents with their number of copies, table of sources with target).

    ``weights`` repeat over the sources in code-point order, null last."""
    spark = docs.sparkSession
    through = [c for c in docs.columns if c not in (copies_col, size_col)]
    rows = (docs.select(F.struct(*[F.col(f"`{c}`") for c in through]).alias("_row"), F.col(f"`{id_col}`").alias("_id"),
                        size.cast("long").alias("_size"), F.array_sort(F.array_distinct(pattern)).alias("_pattern"))
            .withColumn("_key", F.to_json(F.struct("_pattern"))))
    stats = rows.groupBy("_key").agg(F.first("_pattern").alias("p"), F.sum("_size").alias("words")).collect()
    stats = sorted(((r["_key"], r["p"] or [], r["words"] or 0) for r in stats), key=lambda r: r[0])
    sizes: dict = {}
    for _, members, words in stats:
        for s in members:
            sizes[s] = sizes.get(s, 0) + words
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target = quotas(sizes, w, share * sum(x[2] for x in stats), most)
    at = {s: i for i, s in enumerate(names)}
    taken = min_cost_flow([(float(n), [at[s] for s in m]) for _, m, n in stats], [target[s] for s in names], most)
    sources = spark.createDataFrame(
        [(s, int(sizes[s]), float(target[s])) for s in names],
        T.StructType([T.StructField("source", T.StringType()), T.StructField("source_size", T.LongType()),
                      T.StructField("target", T.DoubleType())]))
    whole = []
    for (key, _, n), t in zip(stats, taken):
        base = min(most, int(t / n + 1e-9)) if n else 0
        whole.append((key, base, max(0.0, t - base * n) if base < most else 0.0))
    routes = spark.createDataFrame(whole, "_key string, _base int, _rest double")
    # the driver made this table: one row per pattern
    rows = (rows.withColumn("_u", F.xxhash64(F.lit(seed), F.col("_id")))
            .withColumn("_b", F.pmod(F.shiftright("_u", 20), F.lit(BUCKETS)))
            .join(F.broadcast(routes), "_key", "left"))
    part = rows.where(F.col("_rest") > 0)
    upto = Window.partitionBy("_key").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (part.groupBy("_key", "_b", "_rest").agg(F.sum("_size").alias("_n"))
            .withColumn("_before", F.coalesce(F.sum("_n").over(upto), F.lit(0)))
            .where((F.col("_before") <= F.col("_rest")) & (F.col("_rest") < F.col("_before") + F.col("_n")))
            .groupBy("_key").agg(F.max("_b").alias("_cut"), F.max("_before").alias("_at")))
    rows = rows.join(F.broadcast(cuts), "_key", "left")           # at most one row per pattern
    in_cut = F.col("_b") == F.col("_cut")
    # rows outside the cut bucket get a group of their own bucket each, so no window holds more than a bucket
    run = Window.partitionBy("_key", "_b").orderBy("_u", "_id", "_size").rowsBetween(Window.unboundedPreceding, -1)
    ran = F.coalesce(F.sum("_size").over(run), F.lit(0))
    rows = rows.withColumn("_more", F.when(F.col("_rest") <= 0, False)
                           .when(F.col("_cut").isNull() | (F.col("_b") < F.col("_cut")), True)
                           .when(in_cut, F.col("_at") + ran + F.col("_size") / 2 <= F.col("_rest")).otherwise(False))
    copies = (F.coalesce(F.col("_base"), F.lit(0)) + F.coalesce(F.col("_more"), F.lit(False)).cast("int")).cast("int")
    return rows.select(*[F.col(f"_row.`{c}`").alias(c) for c in through], F.col("_size").alias(size_col), copies.alias(copies_col)), sources
