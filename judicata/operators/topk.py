"""Sort / limit / top-k (TOP-*).

Global top-k is ``orderBy().limit()`` (TakeOrderedAndProject: each task keeps
k rows).  Top-k per group is a rank filter, which Spark plans with a group limit
before the shuffle: every task sends at most k rows of a group.  Every ordering carries a key tie-break, so results are
deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _cols(x):
    return [x] if isinstance(x, str) else list(x)


def top_k(df: DataFrame, order, k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, group, order, k: int,
                    rank_col: str = "rank") -> DataFrame:
    """Top ``k`` rows per group by ``order`` (list of Columns incl. a tie-break)."""
    group = _cols(group)
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w).cast("bigint")).where(F.col(rank_col) <= k)


def arg_max(df: DataFrame, group, metric: str, tie: str, payload) -> DataFrame:
    """Record with the largest (numeric) metric per group, ties to the smallest
    ``tie`` (TOP-5).  An aggregate (partial per task), never a window over the group."""
    group = _cols(group)
    payload = _cols(payload)
    rec = F.struct(*[F.col(p) for p in payload])
    best = F.min_by(rec, F.struct((-F.col(metric)).alias("_m"), F.col(tie).alias("_t")))
    out = df.groupBy(*group).agg(best.alias("_b")) if group else df.agg(best.alias("_b"))
    return out.select(*group, "_b.*")


def sort_by(df: DataFrame, col: str, ascending: bool = True, tie: str | None = None) -> DataFrame:
    """Sort by any column in either direction with nulls always last, plus a
    key tie-break for a stable order (TOP-3)."""
    c = F.col(col).asc_nulls_last() if ascending else F.col(col).desc_nulls_last()
    return df.orderBy(c, *([F.col(tie).asc()] if tie else []))


def count_by(df: DataFrame, key: str, out: str = "n") -> DataFrame:
    """Count by key, descending, key as tie-break (AGG-15)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(out)).orderBy(F.col(out).desc(), F.col(key))
