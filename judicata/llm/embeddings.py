"""Embedding near-duplicates by a forest of random-projection trees.

Every tree splits the vectors recursively at the median of their projection on
a random direction; vectors near the split go to both sides (spill).  Leaves of
one label are compared exactly, pairs at or above the threshold are counted and
united.  A pair that shares leaves in several trees belongs to the smallest of
them, so it is counted once and no pairs are written, only counts and the edges
of a spanning forest per leaf.

Equal vectors of a label are one class before the forest sees them.  The trees
are fitted on at most ``max_sample`` classes; their depth follows the number of
vectors, and below the depth that the sample resolves a split goes through the
mean of the last node that it resolved.  Directions are a function of seed,
tree and node, so only thresholds and means are sent.  A leaf above
``block_rows`` is compared block against block in tasks of their own.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components, and vectors with a null label or id link with nothing; vectors of
different lengths link with nothing; rows that repeat an id count as one vector
and are all returned; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from judicata.llm.common import materialise
from judicata.llm.wordhash import mix
from judicata.operators.components import components

THRESHOLD = 0.93


#: Bytes of the sample that the trees are fitted on, at most, and rows a fitted node has at least.
SAMPLE_BYTES = 64 << 20
LEAST = 24


def directions(seed: int, tree: int, nodes: np.ndarray, dim: int) -> np.ndarray:
    """A unit vector for every node of a tree, always the same one: nothing of it is stored or sent."""
    key = mix(nodes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((seed * 1000 + tree) % (1 << 63)))
    counter = np.arange(1, 2 * dim + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    u = ((mix(key[:, None] + counter[None, :]) >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)
    g = np.sqrt(-2 * np.log(u[:, :dim])) * np.cos(2 * np.pi * u[:, dim:])
    return g / np.linalg.norm(g, axis=1, keepdims=True)


def _gaps(x: np.ndarray, nodes: np.ndarray, level: int, forest: dict, tree: int) -> np.ndarray:
    """Signed distance of each row to the split of its node."""
    at, back = np.unique(nodes, return_inverse=True)
    d = directions(forest["seed"], tree, at, x.shape[1])
    if level < forest["fitted"]:
        offset = forest["thresholds"][tree, at]
    else:                                   # below the fitted levels a split goes through the middle of the last fitted node
        middle = forest["centres"][tree, (at >> (level - forest["fitted"])) - (1 << forest["fitted"])]
        offset = np.einsum("ij,ij->i", middle, d)
    return np.einsum("ij,ij->i", x, d[back]) - offset[back]


def leaves(x: np.ndarray, forest: dict, tree: int, spill: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) pairs of one tree; a row within ``spill`` of a split takes both sides."""
    rows, nodes = np.arange(len(x)), np.ones(len(x), dtype=np.int64)
    for level in range(forest["depth"]):
        gap = _gaps(x[rows], nodes, level, forest, tree)
        low, high = gap < spill, gap >= -spill
        rows, nodes = np.concatenate((rows[low], rows[high])), np.concatenate((2 * nodes[low], 2 * nodes[high] + 1))
    return rows, nodes


def _fit(sample: np.ndarray, n_trees: int, depth: int, seed: int) -> dict:
    """Plain arrays of a forest: the thresholds of the levels that the sample
    resolves, and the mean of every node below them if there are deeper levels."""
    n, dim = sample.shape
    fitted = min(depth, max(0, int(math.log2(max(1, n / LEAST)))))
    forest = {"seed": seed, "depth": depth, "fitted": fitted, "thresholds": np.zeros((n_trees, 1 << fitted)),
              "centres": np.zeros((n_trees, (1 << fitted) if depth > fitted else 0, dim))}
    for tree in range(n_trees):
        nodes = np.ones(n, dtype=np.int64)
        for level in range(fitted):
            p = _gaps(sample, nodes, level, forest, tree)           # thresholds of this level are still 0
            order = np.lexsort((p, nodes))
            at, first, size = np.unique(nodes[order], return_index=True, return_counts=True)
            forest["thresholds"][tree, at] = p[order][first + size // 2]
            nodes = 2 * nodes + (p >= forest["thresholds"][tree, nodes])
        if depth > fitted:
            inner = nodes - (1 << fitted)
            np.add.at(forest["centres"][tree], inner, sample)
            forest["centres"][tree] /= np.maximum(1, np.bincount(inner, minlength=1 << fitted))[:, None]
    return forest


def unit_rows(blobs: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(blobs), dtype="<f8").reshape(len(blobs), -1)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _valid(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(vec, label, emb): usable vectors as little-endian doubles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, labels, embs = [], [], []
            for i, lab, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if i is None or lab is None or not v or None in v:
                    continue
                x = np.array(v, dtype="<f8")
                if np.isfinite(x).all() and x.any():
                    top = np.abs(x).max()       # scaled only where squares would leave the range
                    ids.append(i), labels.append(lab), embs.append((x if 1e-100 < top < 1e100 else x / top).tobytes())
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(labels, pa.string()), pa.array(embs, pa.binary())],
                                  names=["vec", "label", "emb"])

    return (vectors.select(F.col(id_col).cast("long"), F.col(label_col).cast("string"), F.col(vec_col))
            .mapInArrow(run, "vec long, label string, emb binary"))


def fit_forest(classes: DataFrame, n_trees: int, depth: int, dim_bytes: int, max_sample: int, seed: int) -> dict:
    """A forest for vectors of one length, from the classes with the smallest id hash."""
    same = classes.where(F.octet_length("emb") == dim_bytes)
    share = min(1.0, min(max_sample, SAMPLE_BYTES // dim_bytes) / max(1, same.count()))
    rows = (same.where(F.pmod(F.xxhash64(F.lit(seed), "cid"), F.lit(1_000_000)) < int(share * 1_000_000))
            .select("cid", "emb").collect())         # about max_sample rows and SAMPLE_BYTES by construction
    rows.sort(key=lambda r: r["cid"])
    sample = unit_rows([bytes(r["emb"]) for r in rows]) if rows else np.zeros((0, dim_bytes // 8))
    return _fit(sample, n_trees, depth, seed)


def compare(x: np.ndarray, y: np.ndarray, sig_x: np.ndarray, sig_y: np.ndarray, leaf: int, threshold: float,
            same: bool, step: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs at or above the threshold whose smallest common leaf is this one."""
    left, right = [], []
    for s in range(0, len(x), step):
        i, j = np.nonzero(x[s:s + step] @ y.T >= threshold)
        i += s
        if same:
            up = i < j
            i, j = i[up], j[up]
        for k in range(0, len(i), 20_000):
            a, b = i[k:k + 20_000], j[k:k + 20_000]
            sa, sb = sig_x[a], sig_y[b]
            common = ((sa[:, :, None] == sb[:, None, :]).any(axis=2)) & (sa >= 0)
            own = np.where(common, sa, np.iinfo(np.int64).max).min(axis=1) == leaf
            left.append(a[own])
            right.append(b[own])
    empty = np.zeros(0, dtype=np.int64)
    return (np.concatenate(left) if left else empty), (np.concatenate(right) if right else empty)


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n nodes over the pairs."""
    lab = np.arange(n)
    while len(i):
        before = lab.copy()
        m = np.minimum(lab[i], lab[j])
        np.minimum.at(lab, i, m)
        np.minimum.at(lab, j, m)
        lab = lab[lab]
        if (lab == before).all():
            break
    return lab


def linked_classes(classes: DataFrame, threshold: float, n_trees: int, leaf_rows: int, block_rows: int,
                   max_sample: int, seed: int) -> DataFrame:
    """(cid, root, links): what every leaf found of a class."""
    sizes = classes.groupBy(F.octet_length("emb").alias("bytes"), "label").agg(F.count("*").alias("n"))
    sizes = sizes.groupBy("bytes").agg(F.max("n").alias("n")).collect()         # a row per vector length
    depth = {r["bytes"]: min(38, max(0, math.ceil(math.log2(max(1.0, r["n"] / leaf_rows))))) for r in sizes}
    forest = {b: fit_forest(classes, n_trees, d, b, max_sample, seed) for b, d in depth.items()}
    # numbers and arrays only, as a class would be looked up in the workers; of n_trees / LEAST times SAMPLE_BYTES at most
    handle = classes.sparkSession.sparkContext.broadcast(forest)
    spill = 0.5 * math.sqrt(2 - 2 * threshold)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            embs = b.column("emb").to_pylist()
            sigs: list[list[int]] = [[] for _ in embs]
            for size in {len(e) for e in embs}:
                at = [i for i, e in enumerate(embs) if len(e) == size]
                x = unit_rows([embs[i] for i in at])
                for t in range(n_trees):
                    for r, node in zip(*leaves(x, handle.value[size], t, spill / math.sqrt(x.shape[1]))):
                        sigs[at[r]].append(t << 40 | int(node))
            yield pa.record_batch([b.column("cid"), b.column("label"), b.column("n"), b.column("emb"),
                                   pa.array([sorted(s) for s in sigs], pa.list_(pa.int64()))],
                                  names=["cid", "label", "n", "emb", "sig"])

    routed = materialise(classes.select("cid", "label", "n", "emb")
                         .mapInArrow(route, "cid long, label string, n long, emb binary, sig array<long>"))
    rows = routed.select("cid", "label", "n", "emb", "sig", F.octet_length("emb").alias("size"), F.explode("sig").alias("leaf"))
    key = ["label", "size", "leaf"]
    counts = materialise(rows.groupBy(*key).agg(F.ceil(F.count("*") / block_rows).cast("int").alias("nb")).where("nb > 1"))
    big = rows.join(counts, key, "left").withColumn("nb", F.coalesce("nb", F.lit(1)))
    big = big.withColumn("mine", F.pmod(F.xxhash64(F.lit("block"), "cid"), F.col("nb")).cast("int"))
    tasks = F.transform(F.sequence(F.lit(0), F.col("nb") - 1),
                        lambda k: F.struct(F.least(k, F.col("mine")).alias("bi"), F.greatest(k, F.col("mine")).alias("bj")))
    big = big.withColumn("task", F.explode(tasks)).select(*key, "task.bi", "task.bj", "mine", "cid", "n", "emb", "sig")

    def leaf_task(table: pa.Table) -> pa.Table:
        leaf, bi, bj = (table.column(c)[0].as_py() for c in ("leaf", "bi", "bj"))
        cid, n, mine = (table.column(c).to_numpy() for c in ("cid", "n", "mine"))
        x = unit_rows(table.column("emb").to_pylist())
        sig_list = table.column("sig").to_pylist()
        sig = np.full((len(sig_list), max(map(len, sig_list))), -1, dtype=np.int64)
        for r, s in enumerate(sig_list):
            sig[r, :len(s)] = s
        if bi == bj:
            i, j = compare(x, x, sig, sig, leaf, threshold, True)
        else:
            a, b = np.flatnonzero(mine == bi), np.flatnonzero(mine == bj)
            i, j = compare(x[a], x[b], sig[a], sig[b], leaf, threshold, False)
            i, j = a[i], b[j]
        order = np.argsort(cid, kind="stable")      # the smallest index of a group is then its smallest class
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        root = cid[order][roots(len(cid), place[i], place[j])][place]
        links = np.bincount(i, weights=n[j], minlength=len(cid)) + np.bincount(j, weights=n[i], minlength=len(cid))
        hit = links > 0
        return pa.table({"cid": pa.array(cid[hit]), "root": pa.array(root[hit]), "links": pa.array(links[hit].astype(np.int64))})

    return big.groupBy(*key, "bi", "bj").applyInArrow(leaf_task, "cid long, root long, links long")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    threshold: float = THRESHOLD, n_trees: int = 10, leaf_rows: int = 400, block_rows: int = 4096,
                    max_sample: int = 50_000, seed: int = 7) -> DataFrame:
    """One row per input row: id, n_links, component_id, kept."""
    valid = materialise(_valid(vectors, id_col, vec_col, label_col)
                        .withColumn("h1", F.xxhash64("label", "emb")).withColumn("h2", F.xxhash64("emb", "label")))
    classes = materialise(valid.groupBy("label", "h1", "h2").agg(
        F.min("vec").alias("cid"), F.count_distinct("vec").alias("n"), F.first("emb").alias("emb")))
    found = materialise(linked_classes(classes, threshold, n_trees, leaf_rows, block_rows, max_sample, seed))
    comp = components(found.select("cid", "root"), "cid", "root")
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    per_class = (classes.select("label", "h1", "h2", "cid", "n").join(links, "cid", "left")
                 .join(comp.withColumnRenamed("node", "cid"), "cid", "left")
                 .select("label", "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"),
                         F.coalesce("component", "cid").alias("component")))
    per_vec = (valid.select("vec", "label", "h1", "h2").distinct().join(materialise(per_class), ["label", "h1", "h2"])
               .groupBy("vec").agg(F.max("links").alias("links"), F.min("component").alias("component")))
    out = vectors.select(F.col(id_col)).join(per_vec, F.col(id_col) == F.col("vec"), "left")
    component = F.coalesce(F.col("component"), F.col(id_col).cast("long"))
    return out.select(F.col(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), (F.col(id_col) == component).alias("kept"))
