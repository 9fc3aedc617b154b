"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a text: densities of a fixed seed lexicon and of a lexicon learned
from labelled texts (words and word beginnings that occur mostly in texts
labelled toxic), the share of lexicon words near a second-person pronoun,
capitals and punctuation (capitals as a share of the characters that are no
white space, in texts of every length) and obfuscation (letters mixed with
digits or symbols, and lexicon words after undoing it).  Language, source and ids are no inputs.

The lexicon is learned in two halves: a labelled text is described by the
lexicon of the other half, so the trees see the precision that unseen texts
have.  A quarter of the labelled texts is kept from the trees for calibration.

Only the fit is bounded: at most about ``max_sample`` labelled texts, the ones
with the smallest id hash; every text is scored whole.

Defined cases: null and empty texts get a score as a text without words;
labels that are null or belong to no text are ignored; several labels of one id
count as toxic if one is; rows that repeat are scored one by one; columns of
any name may be kept, those of the features included; an empty table gives no
rows; long texts take time in proportion to their words; if fewer than ``MIN_CLASS`` texts of a class are
labelled, the score is a fixed rising function of the seed lexicon's density.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from judicata.llm.common import materialise

#: Common insults; they only start the lexicon, the labels give the rest.
SEED = frozenset("""
idiot moron loser stupid dumb scum trash garbage worthless pathetic disgusting clown fool jerk imbecile
dummkopf trottel abschaum wertlos widerlich blöd imbécile crétin ordure minable débile nul
estúpido imbécil basura asqueroso patético inútil
""".split())
YOU = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch sie tu te toi ton ta vous votre tú ti usted ustedes tus".split())
LEET = str.maketrans("0134578@$!|", "oieastbasil")
PREFIXES = (4, 5, 6)
EDGE = ".,;:!?\"'()[]{}«»¡¿-–…"
MIN_CLASS = 20
NEAR = 5
FEATURES = ("log_words", "seed", "learned", "learned_prefix", "hits", "near_you", "you", "capitals", "caps_words",
            "punctuation", "exclamations", "mixed", "undone")
MIXED = re.compile(r"[^\W\d_][\d@$!|*#%&]+[^\W\d_]")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def terms(text: str) -> set[str]:
    """Distinct words and, marked with a final ``*``, word beginnings."""
    words = {w.strip(EDGE) for w in text.lower().split()}
    return words | {w[:k] + "*" for w in words for k in PREFIXES if len(w) > k}


def describe(text: str, lexicon: frozenset[str]) -> list[float]:
    raw = text.split()
    n = max(1, len(raw))
    low = [w.strip(EDGE) for w in text.lower().split()]
    hits, seed, prefix = [], 0, 0
    for i, w in enumerate(low):
        s = w in SEED
        p = any(w[:k] + "*" in lexicon for k in PREFIXES if len(w) > k)
        if s or p or w in lexicon:
            hits.append(i)
            seed += s
            prefix += p
    you = np.array([i for i, w in enumerate(low) if w in YOU] if hits else [], dtype=np.int64)
    at = np.array(hits, dtype=np.int64)
    near = int((np.searchsorted(you, at + NEAR, side="right") > np.searchsorted(you, at - NEAR)).sum())
    visible = max(1, sum(map(len, raw)))
    upper = len(text) - len(text.translate(_NO_CAPS))
    mixed = [w for w in raw if not w.isalpha() and MIXED.search(w)]
    undone = 0
    for w in mixed:
        v = w.lower().translate(LEET).replace("*", "").strip(EDGE)
        undone += v in SEED or v in lexicon
    return [float(np.log1p(len(raw))), seed / n, (len(hits) - seed) / n, prefix / n, float(np.log1p(len(hits))), near / n,
            len(you) / n, upper / visible, sum(1 for w in raw if len(w) > 2 and w.isupper()) / n,
            sum(map(text.count, ".,;:!?")) / n, text.count("!") / n, len(mixed) / n, float(np.log1p(undone))]


_NO_CAPS = {c: None for c in range(ord("A"), ord("Z") + 1)} | {ord(c): None for c in "ÀÁÂÄÇÈÉÊËÌÍÎÏÑÒÓÔÖÙÚÛÜ"}


def features(rows: DataFrame, lexicons: dict[int, frozenset[str]]) -> DataFrame:
    """``_keep`` and the features of ``_scored_text``; column ``_half`` picks the lexicon (-1: all)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([describe(t.as_py() or "", lexicons[h]) for t, h in zip(b.column(1), b.column(2).to_pylist())])
            yield pa.record_batch([b.column(0), *[pa.array(c) for c in np.ascontiguousarray(x.reshape(-1, len(FEATURES)).T)]],
                                  names=["_keep", *FEATURES])

    out = T.StructType([rows.schema["_keep"], *[T.StructField(f, T.DoubleType()) for f in FEATURES]])
    return rows.select("_keep", "_scored_text", "_half").mapInArrow(run, out)


def learn_lexicon(sample: DataFrame, min_docs: int, min_ratio: float, most: int) -> dict[int, frozenset[str]]:
    """Terms by half (and -1 for both) that occur in at least ``min_docs`` toxic
    texts and ``min_ratio`` times as often as in the others; ``most`` of a half."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for b in batches:
            for text, half, toxic in zip(*(b.column(i).to_pylist() for i in range(3))):
                counts.update((t, half, toxic) for t in terms(text or "") if t)
        keys = list(counts)
        yield pa.record_batch([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
                               pa.array([k[2] for k in keys], pa.int32()), pa.array([counts[k] for k in keys], pa.int64())],
                              names=["term", "half", "toxic", "n"])

    counted = sample.select("text", "half", "toxic").mapInArrow(run, "term string, half int, toxic int, n long")
    by_term = counted.groupBy("term").agg(*[F.sum(F.when((F.col("half") == h) & (F.col("toxic") == t), F.col("n")).otherwise(0)).alias(f"n{h}{t}")
                                            for h in (0, 1) for t in (0, 1)])
    # terms that no lexicon can take are dropped before the table is read three times
    by_term = materialise(by_term.where(F.col("n01") + F.col("n11") >= min_docs))
    size = {(r["half"], r["toxic"]): r["n"] for r in sample.groupBy("half", "toxic").agg(F.count("*").alias("n")).collect()}
    found = {}
    for half, parts in ((0, (0,)), (1, (1,)), (-1, (0, 1))):
        pos, neg = (sum((F.col(f"n{h}{t}") for h in parts), F.lit(0)) for t in (1, 0))
        n_pos, n_neg = (sum(size.get((h, t), 0) for h in parts) for t in (1, 0))
        ratio = ((pos + 0.5) / (n_pos + 1)) / ((neg + 0.5) / (n_neg + 1))
        top = (by_term.where((pos >= min_docs) & (ratio >= min_ratio)).select("term", pos.alias("n"))
               .orderBy(F.desc("n"), "term").limit(most))
        found[half] = frozenset(r["term"] for r in top.collect())
    return found


class ToxicityModel:
    """Fitted lexicons, trees and calibration."""

    def __init__(self, lexicons, trees, isotonic):
        self.lexicons, self.trees, self.isotonic = lexicons, trees, isotonic

    def _raw(self, df: DataFrame) -> DataFrame:
        out = self.trees.transform(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(df))
        return out.withColumn("raw", vector_to_array("probability")[1])

    def score(self, docs: DataFrame, keep: list[str], text_col: str = "text", threshold: float = 0.3) -> DataFrame:
        """``keep`` plus score and predicted for every row."""
        # the caller's columns travel in a struct, so that no name of theirs can clash with one of a feature
        rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_keep"), F.col(text_col).alias("_scored_text"),
                           F.lit(-1).alias("_half"))
        df = features(rows, self.lexicons)
        if self.trees is None:
            s = 1 - F.exp(-20.0 * F.col("seed"))
        else:
            df = self.isotonic.transform(self._raw(df))
            s = F.col("calibrated")
        s = F.greatest(F.lit(0.0), F.least(F.lit(1.0), s))
        return (df.select("_keep", s.alias("score"))
                .select(*[F.col(f"_keep.`{c}`").alias(c) for c in keep], "score", (F.col("score") >= threshold).cast("int").alias("predicted")))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_sample: int = 20_000,
        min_docs: int = 4, min_ratio: float = 8.0, max_terms: int = 3000, rounds: int = 12, depth: int = 3,
        seed: int = 42) -> ToxicityModel:
    """Learn from labelled rows that :func:`held_out` does not hold out."""
    usable = (labels.where(F.col("toxic").isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
              .groupBy(id_col).agg(F.max("toxic").cast("int").alias("toxic"))
              .withColumn("u", F.xxhash64(F.lit(seed), id_col)))
    n = usable.count()
    scale = 1_000_000
    if n > max_sample:
        usable = usable.where(F.pmod("u", F.lit(scale)) < int(scale * max_sample / n))
    # broadcast: about max_sample rows by the line above
    sample = (docs.select(F.col(id_col), F.col(text_col).alias("text")).join(F.broadcast(usable), id_col)
              .dropDuplicates([id_col]).withColumn("txt", F.xxhash64("text")).dropDuplicates(["txt"])
              .select(id_col, "text", "toxic", F.pmod(F.shiftright("u", 20), F.lit(2)).cast("int").alias("half"),
                      F.pmod(F.shiftright("u", 24), F.lit(4)).alias("quarter")))
    sample = materialise(sample)
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if min(sizes.get(0, 0), sizes.get(1, 0)) < MIN_CLASS:
        return ToxicityModel({-1: frozenset()}, None, None)
    lexicons = learn_lexicon(sample, min_docs, min_ratio, max_terms)
    crossed = {0: lexicons[1], 1: lexicons[0]}
    # a bounded table, ordered and in one file, so that a rerun fits the same trees
    rows = sample.select(F.struct(F.col(id_col).alias("id"), "toxic", "quarter").alias("_keep"), F.col("text").alias("_scored_text"),
                         F.col("half").alias("_half"))
    x = materialise(features(rows, crossed).orderBy("_keep.id").coalesce(1).select("_keep.toxic", "_keep.quarter", *FEATURES))
    model = ToxicityModel(lexicons, None, None)
    train = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(x.where("quarter <> 0"))
    model.trees = GBTClassifier(labelCol="toxic", featuresCol="features", maxIter=rounds, maxDepth=depth, stepSize=0.3,
                                seed=seed, cacheNodeIds=False).fit(train)
    cal = model._raw(x.where("quarter = 0")).select("raw", F.col("toxic").cast("double").alias("toxic"))
    if cal.agg(F.sum("toxic")).first()[0] in (None, 0.0):
        cal = model._raw(x).select("raw", F.col("toxic").cast("double").alias("toxic"))
    model.isotonic = IsotonicRegression(labelCol="toxic", featuresCol="raw", predictionCol="calibrated").fit(cal)
    return model
