"""Sharding by rendezvous (highest random weight) hashing.

Every record key is scored against every shard, ``-weight / ln(u)`` with ``u``
in (0, 1) from a 64-bit hash of key and shard number, and goes to the shard with
the highest score (the smaller number on a tie).  The score of a shard does not
depend on the others, so one more shard only takes records into itself, about
its weight's share of all, and no record moves between old shards.

Defined cases: a null key is a key like any other; rows that repeat a key go to
the same shard and get different slots; a null text has size ``overhead`` and
the CRC of no bytes; an empty table gives no rows; other columns play no part,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Sub-groups of a shard for numbering its rows; a slot's place is the sum of
#: the sub-groups before it plus its number in its own, so no task holds a shard.
SUBGROUPS = 1024


def score(key: Column, shard: int, weight: float) -> Column:
    h = F.xxhash64(key, F.lit(shard))
    u = (F.shiftrightunsigned(h, 11).cast("double") + 0.5) / float(1 << 53)
    return F.lit(-float(weight)) / F.log(u)


def rendezvous(key: Column, weights: list[float]) -> Column:
    """Struct (s, neg): the best score and the negated number of its shard."""
    if not weights or any(w <= 0 for w in weights):
        raise ValueError("one positive weight per shard is needed")
    return F.array_max(F.array(*[F.struct(score(key, i, w).alias("s"), F.lit(-i).alias("neg"))
                                 for i, w in enumerate(weights)]))


def assign(df: DataFrame, key: str, weights: list[float], grown_weight: float | None = None,
           shard: str = "shard", grown: str = "grown_shard") -> DataFrame:
    """``df`` plus the shard of each row and, with ``grown_weight``, its shard
    when one more shard of that weight is there."""
    k = F.col(key)
    df = df.withColumn("_best", rendezvous(k, weights)).withColumn(shard, (-F.col("_best.neg")).cast("int"))
    if grown_weight is not None:
        s = score(k, len(weights), grown_weight)
        df = df.withColumn(grown, F.when(s > F.col("_best.s"), F.lit(len(weights))).otherwise(F.col(shard)).cast("int"))
    return df.drop("_best")


def number_slots(df: DataFrame, key: str, order_by: list[str], shard: str = "shard", slot: str = "slot",
                 subgroups: int = SUBGROUPS) -> DataFrame:
    """Gapless numbers from 0 within each shard, in the order of a hash
    sub-group of the key and then ``order_by``.

    The table of sub-group sizes has at most shards x ``subgroups`` rows."""
    df = df.withColumn("_sub", F.pmod(F.xxhash64(F.lit("slot"), F.col(key)), F.lit(subgroups)).cast("int"))
    sizes = df.groupBy(shard, "_sub").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(shard).orderBy("_sub").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(F.col(shard), "_sub", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    w = Window.partitionBy(shard, "_sub").orderBy(*order_by)
    return (df.withColumn("_rn", F.row_number().over(w)).join(sizes, [shard, "_sub"])
            .withColumn(slot, (F.col("_before") + F.col("_rn") - 1).cast("long")).drop("_sub", "_rn", "_before"))


def shard_documents(docs: DataFrame, weights: list[float], id_col: str = "doc_id", text_col: str = "text",
                    overhead: int = 16, grown_weight: float | None = 1.0) -> DataFrame:
    rows = docs.select(F.col(id_col), (F.coalesce(F.octet_length(text_col), F.lit(0)) + overhead).cast("long").alias("size"),
                       F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_crc32"),
                       F.lit("key").alias("law"))
    rows = assign(rows, id_col, weights, grown_weight)
    return number_slots(rows, id_col, [id_col, "text_crc32", "size"])
