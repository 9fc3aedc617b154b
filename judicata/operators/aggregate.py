"""Aggregations (AGG-*): exact quantiles, bucket histograms, rollups, reshapes.

Exact quantiles at scale: rather than hand every raw value of a group to one
``percentile`` buffer, the values are first reduced to a (group, value) ->
count histogram with an ordinary partial/final hash aggregate, and the
percentile is taken over the histogram with ``percentile(value, p, count)``.
Days and whole seconds have few distinct values, so a group holding a third
of all rows still leaves only a small histogram; the global row of a profile
comes from the same histogram (``rollup``), not from a second scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

W = "_w"


def _cols(x):
    return [x] if isinstance(x, str) else list(x)


def value_histogram(df: DataFrame, group, value: str) -> DataFrame:
    """(group..., value, _w) counts; partial aggregation happens map-side."""
    return df.groupBy(*_cols(group), value).agg(F.count(F.lit(1)).alias(W))


def quantile_aggs(value: str, probs=(0.5, 0.9), names=("median", "p90"), weight: str = W) -> list[Column]:
    """n, mean, min, max (AGG-7) and exact linear-interpolated quantiles, median and p90
    (AGG-5, AGG-6), over a histogram."""
    v, w = F.col(value), F.col(weight)
    out = [F.sum(w).alias("n"),
           F.try_divide(F.sum(v * w).cast("double"), F.sum(w).cast("double")).alias("mean"),
           F.min(v).alias("min"), F.max(v).alias("max")]
    for p, nm in zip(probs, names):
        out.append(F.percentile(v, F.lit(p), w).cast("double").alias(nm))
    return out


def quantile_profile(df: DataFrame, group: str, value: str, probs=(0.5, 0.9), names=("median", "p90"),
                     min_n: int = 0, global_label: str | None = None, approx_accuracy: int | None = None) -> DataFrame:
    """Per-group and global delay profile in one result (AGG-8; FLT-11).

    ``min_n`` applies to groups only; the global row (``group`` null, or
    ``global_label``) always appears.  Exact by default (histogram + weighted
    percentile).  ``approx_accuracy`` opts into ``percentile_approx`` over the raw
    values for continuous measures with very many distinct values: bounded
    memory per group, rank error at most about 1/accuracy of n."""
    if approx_accuracy:
        v = F.col(value)
        aggs = [F.count(v).alias("n"), F.avg(v.cast("double")).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max")]
        aggs += [F.percentile_approx(v, p, approx_accuracy).cast("double").alias(nm) for p, nm in zip(probs, names)]
        prof = df.rollup(group).agg(*aggs, F.grouping(group).alias("is_global"))
        prof = prof.where((F.col("is_global") == 1) | (F.col("n") >= min_n))
        if global_label is not None:
            prof = prof.withColumn(group, F.when(F.col("is_global") == 1, F.lit(global_label)).otherwise(F.col(group)))
        return prof
    hist = value_histogram(df, group, value)
    prof = hist.rollup(group).agg(*quantile_aggs(value, probs, names), F.grouping(group).alias("is_global"))
    prof = prof.where((F.col("is_global") == 1) | (F.col("n") >= min_n))
    if global_label is not None:
        prof = prof.withColumn(group, F.when(F.col("is_global") == 1, F.lit(global_label)).otherwise(F.col(group)))
    return prof


def bucket_label(lo, hi) -> str:
    return f"{lo}-{hi}" if hi is not None else f"{lo}+"


def bucket_counts(df: DataFrame, group, value: str, edges, weight: str | None = None) -> DataFrame:
    """Fixed-bucket histogram, long form, every bucket present (zero included).

    Buckets are ``[e_i, e_{i+1})`` and the last is open.  Counting is one
    conditional sum per bucket in a single aggregate; the long form comes from
    ``inline`` of the per-group array, so no (group x bucket) grid join is
    needed to keep empty buckets."""
    group = _cols(group)
    edges = list(edges)
    bounds = [(edges[i], edges[i + 1] if i + 1 < len(edges) else None) for i in range(len(edges))]
    v = F.col(value)
    w = F.col(weight) if weight else F.lit(1)
    aggs = []
    for i, (lo, hi) in enumerate(bounds):
        cond = (v >= lo) if hi is None else ((v >= lo) & (v < hi))
        aggs.append(F.sum(F.when(cond, w).otherwise(F.lit(0))).cast("bigint").alias(f"_b{i}"))
    wide = df.groupBy(*group).agg(*aggs)
    structs = [F.struct(F.lit(i).alias("bucket"), F.lit(bucket_label(lo, hi)).alias("rango"),
                        F.lit(lo).cast("int").alias("desde"), F.lit(hi).cast("int").alias("hasta"),
                        F.col(f"_b{i}").alias("n")) for i, (lo, hi) in enumerate(bounds)]
    return wide.select(*group, F.inline(F.array(*structs)))


def weighted_mean(value, weight) -> Column:
    """sum(value*weight)/sum(weight), null when the weights sum to zero (AGG-13)."""
    v = F.col(value) if isinstance(value, str) else value
    w = F.col(weight) if isinstance(weight, str) else weight
    return F.try_divide(F.sum(v.cast("double") * w), F.sum(w).cast("double"))


def column_totals_long(df: DataFrame, by, cols, name: str = "medida", value: str = "valor",
                       cast: str | None = None) -> DataFrame:
    """Column-wise totals turned into rows (AGG-11): one aggregate pass, then unpivot.
    ``cast`` gives all totals one type (unpivot needs a common type)."""
    by = _cols(by)
    wide = df.groupBy(*by).agg(*[(F.sum(c).cast(cast) if cast else F.sum(c)).alias(c) for c in cols])
    return wide.unpivot(by, list(cols), name, value)


def wide_to_long(df: DataFrame, ids, value_cols, name: str, value: str, keep_positive: bool = True) -> DataFrame:
    """Unpivot a wide sheet; null / negative / junk cells are ignored one by one (AGG-12)."""
    ids = _cols(ids)
    long = df.unpivot(ids, list(value_cols), name, value)
    long = long.withColumn(value, F.trim(F.col(value).cast("string")).try_cast("double"))
    if keep_positive:
        long = long.where(F.col(value) >= 0)
    return long.where(F.col(value).isNotNull())


def breakdown(df: DataFrame, dims, aggs, dim_name: str = "dimension", value_name: str = "valor") -> DataFrame:
    """Breakdown of one snapshot by several dimensions in one pass (AGG-10).

    ``groupingSets`` expands each input row once per dimension inside one
    aggregate; the output is long: (dimension, valor, aggs...)."""
    dims = list(dims)
    g = df.groupingSets([[d] for d in dims], *dims).agg(*aggs, F.grouping_id(*dims).alias("_gid"))
    n = len(dims)
    name = None
    value = None
    for i, d in enumerate(dims):
        gid = ((1 << n) - 1) ^ (1 << (n - 1 - i))
        cond = F.col("_gid") == gid
        name = F.when(cond, F.lit(d)) if name is None else name.when(cond, F.lit(d))
        value = F.when(cond, F.col(d).cast("string")) if value is None else value.when(cond, F.col(d).cast("string"))
    return g.select(name.alias(dim_name), value.alias(value_name),
                    *[c for c in g.columns if c not in dims and c != "_gid"])


def exact_slope(y, x) -> Column:
    """Least-squares slope of integer series from exact integer sums:
    (n*Sxy - Sx*Sy) / (n*Sxx - Sx^2).  One final division, so a flat series
    gives exactly 0 and the value does not depend on summation order (unlike
    ``regr_slope``'s floating-point updates).  Usable as an aggregate or over a
    window."""
    yc = (F.col(y) if isinstance(y, str) else y).cast("bigint")
    xc = (F.col(x) if isinstance(x, str) else x).cast("bigint")
    n = F.count(F.lit(1))
    num = n * F.sum(xc * yc) - F.sum(xc) * F.sum(yc)
    den = n * F.sum(xc * xc) - F.sum(xc) * F.sum(xc)
    return F.try_divide(num.cast("double"), den.cast("double"))


def exact_slope_over(y, x, window) -> Column:
    """:func:`exact_slope` evaluated over a window specification."""
    yc = (F.col(y) if isinstance(y, str) else y).cast("bigint")
    xc = (F.col(x) if isinstance(x, str) else x).cast("bigint")
    n = F.count(F.lit(1)).over(window)
    sx, sy = F.sum(xc).over(window), F.sum(yc).over(window)
    num = n * F.sum(xc * yc).over(window) - sx * sy
    den = n * F.sum(xc * xc).over(window) - sx * sx
    return F.try_divide(num.cast("double"), den.cast("double"))
