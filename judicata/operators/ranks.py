"""Exact order statistics at any size (AGG-5, AGG-6) by rank selection.

A quantile of a group lies between two ranks.  A sketch gives a bracket of values
around them, one pass counts what lies below the bracket and keeps only what lies
inside, and the bracket is refined over a histogram of its range until few
different values are left; the ranks are then read off their running counts.
Counts decide, not the sketch: a bracket that misses its ranks is opened to the whole
range.  No group is ever in one buffer: every pass is an aggregate with a map-side
phase or a filter, and a group that holds most rows is counted by all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from judicata.session import materialise

#: Rank error of the sketch is 1 / ACCURACY of a group's rows.
ACCURACY = 10_000
#: Different values of a bracket that are sorted in one window.
FEW = 100_000
#: Range buckets of one refinement.
BUCKETS = 10_000
_INF = float("inf")


def _brackets(x: DataFrame, keys: list[str], probs: tuple[float, ...], few: int, accuracy: int) -> DataFrame:
    """By group: n and, per quantile, the two ranks and a bracket of values that should hold them."""
    slack = 2.0 / accuracy
    sketch = [F.percentile_approx("v", [max(0.0, p - slack) for p in probs], accuracy).alias("lows"),
              F.percentile_approx("v", [min(1.0, p + slack) for p in probs], accuracy).alias("highs")]
    out = x.groupBy(*keys).agg(F.count("v").alias("n"), *sketch)
    small = F.col("n") <= few
    items = []
    for i, p in enumerate(probs):
        at = F.lit(p) * (F.col("n") - 1)
        items.append(F.struct(
            F.lit(i).alias("i"), F.floor(at).cast("long").alias("k0"), F.ceil(at).cast("long").alias("k1"), (at - F.floor(at)).alias("part"),
            F.when(small | F.lit(p <= slack), -_INF).otherwise(F.col("lows")[i]).alias("low"),
            F.when(small | F.lit(p >= 1 - slack), _INF).otherwise(F.col("highs")[i]).alias("high")))
    return out.select(*keys, "n", F.array(*items).alias("at"))


def _inside(x: DataFrame, brackets: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, i, under, v, w): histogram of what lies inside each bracket; what lies below it is one row."""
    hit = F.filter("at", lambda t: F.col("v") <= t["high"])
    rows = x.join(brackets.select(*keys, "at"), keys).select(*keys, "v", F.explode(hit).alias("t"))
    under = F.col("v") < F.col("t.low")
    return (rows.select(*keys, F.col("t.i").alias("i"), under.alias("under"), F.when(~under, F.col("v")).alias("v"))
            .groupBy(*keys, "i", "under", "v").agg(F.count(F.lit(1)).alias("w")))


def _wanted(brackets: DataFrame, keys: list[str]) -> DataFrame:
    return brackets.select(*keys, F.explode("at").alias("t")).select(*keys, "t.i", "t.k0", "t.k1", "t.part")


def _refine(held: DataFrame, wanted: DataFrame, keys: list[str], few: int) -> DataFrame:
    """One refinement of every bracket that still holds more than ``few`` different values."""
    part = [*keys, "i"]
    size = (held.where("NOT under").groupBy(*part).agg(F.count(F.lit(1)).alias("d"), F.min("v").alias("a"), F.max("v").alias("b"))
            .where((F.col("d") > few) & (F.col("a") < F.col("b"))))
    x = held.join(size, part, "left")
    # halves, as the range itself may be beyond the largest number
    share = (F.col("v") / 2 - F.col("a") / 2) / (F.col("b") / 2 - F.col("a") / 2)
    bucket = F.when(F.col("under") | F.col("d").isNull(), -1).otherwise(F.least(F.floor(share * BUCKETS), F.lit(BUCKETS)).cast("int"))
    x = materialise(x.select(*part, "under", "v", "w", "d", bucket.alias("bucket")))
    run = Window.partitionBy(*part).orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = (x.where("d IS NOT NULL").groupBy(*part, "bucket").agg(F.sum("w").alias("c"))
              .withColumn("upto", F.sum("c").over(run)).join(wanted, part))
    first = counts.groupBy(*part).agg(F.min(F.when(F.col("upto") > F.col("k0"), F.col("bucket"))).alias("b0"),
                                      F.min(F.when(F.col("upto") > F.col("k1"), F.col("bucket"))).alias("b1"))
    y = x.join(first, part, "left")
    below = F.col("under") | (F.col("bucket") < F.coalesce("b0", F.lit(-1)))
    # between the two buckets of the ranks there is nothing, or they are one
    kept = y.where(F.col("b1").isNull() | (F.col("bucket") <= F.col("b1")))
    return materialise(kept.select(*part, below.alias("under"), F.when(~below, F.col("v")).alias("v"), "w")
                       .groupBy(*part, "under", "v").agg(F.sum("w").alias("w")))


def _state(held: DataFrame, wanted: DataFrame, part: list[str], few: int):
    """(missed, wide): whether a bracket does not hold its ranks, and whether one holds too many values."""
    inner = F.when(~F.col("under"), F.col("v"))
    per = held.groupBy(*part).agg(F.sum(F.when(F.col("under"), F.col("w")).otherwise(0)).alias("below"), F.sum("w").alias("upto"),
                                  F.count(inner).alias("d"), F.min(inner).alias("a"), F.max(inner).alias("b"))
    return per.join(wanted, part).agg(F.bool_or((F.col("below") > F.col("k0")) | (F.col("upto") <= F.col("k1"))).alias("missed"),
                                      F.bool_or((F.col("d") > few) & (F.col("a") < F.col("b"))).alias("wide")).first()


def exact_quantiles(df: DataFrame, group, value: str | Column, probs=(0.5, 0.9), names=("median", "p90"),
                    few: int = FEW, accuracy: int = ACCURACY) -> DataFrame:
    """(group..., n, names...): exact linearly interpolated quantiles of a numeric column.

    Nulls and NaN are left out; a group of only these gives no row.  ``df`` is read twice."""
    cols = [group] if isinstance(group, str) else list(group)
    v = F.col(value) if isinstance(value, str) else value
    # a null group is a group, so joins go by a struct of the group's columns that holds no null
    key = F.struct(*[F.col(c).isNull().alias(f"n{i}") for i, c in enumerate(cols)],
                   *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"s{i}") for i, c in enumerate(cols)], F.lit(0).alias("all"))
    keys, labels = ["key"], [f"_label{i}" for i in range(len(cols))]
    x = (df.select(key.alias("key"), *[F.col(c).alias(lab) for c, lab in zip(cols, labels)], v.cast("double").alias("v"))
         .where(F.col("v").isNotNull() & ~F.isnan("v")))
    probs = tuple(probs)
    brackets = materialise(_brackets(x, [*keys, *labels], probs, few, accuracy))
    wanted = _wanted(brackets, keys)
    held = materialise(_inside(x.select(*keys, "v"), brackets, keys))
    part = [*keys, "i"]
    if _state(held, wanted, part, few).missed:
        whole = brackets.withColumn("at", F.transform("at", lambda t: t.withField("low", F.lit(-_INF)).withField("high", F.lit(_INF))))
        held = materialise(_inside(x.select(*keys, "v"), whole, keys))
    while _state(held, wanted, part, few).wide:
        held = _refine(held, wanted, keys, few)
    run = Window.partitionBy(*part).orderBy(F.desc("under"), "v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = held.withColumn("upto", F.sum("w").over(run)).join(wanted, part)
    ends = ranked.groupBy(*part, "part").agg(F.min(F.when(~F.col("under") & (F.col("upto") > F.col("k0")), F.col("v"))).alias("v0"),
                                             F.min(F.when(~F.col("under") & (F.col("upto") > F.col("k1")), F.col("v"))).alias("v1"))
    q = F.when(F.col("v0") == F.col("v1"), F.col("v0")).otherwise(F.col("v0") + (F.col("v1") - F.col("v0")) * F.col("part"))
    values = ends.groupBy(*keys).agg(*[F.max(F.when(F.col("i") == i, q)).alias(n) for i, n in enumerate(names)])
    out = brackets.join(values, keys)
    return out.select(*[F.col(lab).alias(c) for c, lab in zip(cols, labels)], "n", *names)
