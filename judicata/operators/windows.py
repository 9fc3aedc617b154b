"""Window operators (WIN-*) and skew-safe sequence helpers.

Windows partitioned by a raw key put a hot key (a third of all rows) into one
task.  The sequence helpers here split every key into time buckets: the work
inside a bucket is an ordinary window over ``(key, bucket)``, and the only
cross-bucket information (the first event of the next bucket, or the events
within ``width`` before a bucket starts) is carried by a small per-bucket
table or by a bounded halo copy.  Results are exact for any bucket size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from judicata.operators.aggregate import exact_slope_over

UNB = Window.unboundedPreceding


def _cols(x):
    return [x] if isinstance(x, str) else list(x)


def micros(ts) -> Column:
    """Microseconds since 1970-01-01 00:00 of a timestamp_ntz column, independent
    of the session time zone (a wall-clock difference, no zone conversion)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)


# ---------------------------------------------------------------- sequences

def next_in_sequence(df: DataFrame, key, t: str, tie: str, carry: dict[str, str],
                     bucket_micros: int = 3_600_000_000) -> DataFrame:
    """Attach the next row of the same key in (t, tie) order, skew-safe.

    ``t`` is a long (e.g. microseconds); ``carry`` maps output names to the
    columns of the next row to attach (e.g. ``{"next_ts": "ts"}``).  Within a
    (key, bucket) the next row is ``lead``; the last row of a bucket takes the
    head of the key's next non-empty bucket from a one-row-per-bucket table."""
    key = _cols(key)
    b = F.floor(F.col(t) / F.lit(bucket_micros)).cast("long")
    x = df.withColumn("_b", b)
    w = Window.partitionBy(*key, "_b").orderBy(t, tie)
    x = x.withColumns({k: F.lead(v).over(w) for k, v in carry.items()})
    x = x.withColumn("_has_next", F.lead(F.lit(True)).over(w))
    # first row of each bucket; (t, tie) is unique, so min_by is deterministic
    head = F.min_by(F.struct(F.col(t).alias("_t"), F.col(tie).alias("_tie"),
                             *[F.col(v).alias(f"_h_{k}") for k, v in carry.items()]),
                    F.struct(F.col(t), F.col(tie)))
    heads = x.groupBy(*key, "_b").agg(head.alias("_head"))
    wb = Window.partitionBy(*key).orderBy("_b")
    heads = heads.select(*key, "_b", F.lead("_head").over(wb).alias("_nh"))
    x = x.join(heads, on=key + ["_b"], how="left")
    x = x.withColumns({k: F.when(F.col("_has_next"), F.col(k)).otherwise(F.col(f"_nh._h_{k}"))
                       for k in carry})
    return x.drop("_b", "_nh", "_has_next")


def trailing_count(df: DataFrame, key, t: str, width: int, bucket: int, out: str = "n_trailing") -> DataFrame:
    """Rows of the same key with t in [t - width, t] (range frame, peers included).

    Skew-safe via halo buckets: every row lives in its bucket ``floor(t/bucket)``
    and, when it lies within ``width`` of the next bucket's start, also as a halo
    copy there.  Requires ``width <= bucket``; halo volume is about width/bucket."""
    if width > bucket:
        raise ValueError("width must not exceed bucket")
    key = _cols(key)
    tt = F.col(t)
    b = F.floor(tt / F.lit(bucket)).cast("long")
    near_next = tt >= (b + 1) * F.lit(bucket) - F.lit(width)
    x = df.withColumn("_home", b).withColumn(
        "_b", F.explode(F.when(near_next, F.array(b, b + 1)).otherwise(F.array(b))))
    w = Window.partitionBy(*key, "_b").orderBy(tt).rangeBetween(-width, 0)
    x = x.withColumn(out, F.count(F.lit(1)).over(w))
    return x.where(F.col("_b") == F.col("_home")).drop("_b", "_home")


# ------------------------------------------------------------- series (small)

def clamped_stock(df: DataFrame, key, order: str, inflow: str, outflow: str, p0: float = 0,
                  out: str = "stock") -> DataFrame:
    """pend_t = max(0, pend_{t-1} + in_t - out_t) without a loop (WIN-3).

    With S_t = p0 + running sum(in - out): pend_t = S_t - least(0, running min S).
    Input is an aggregated series (one row per key and period)."""
    key = _cols(key)
    w = Window.partitionBy(*key).orderBy(order).rowsBetween(UNB, 0)
    x = df.withColumn("_s", F.lit(p0) + F.sum(F.col(inflow) - F.col(outflow)).over(w))
    x = x.withColumn(out, F.col("_s") - F.least(F.lit(0), F.min("_s").over(w)))
    return x.drop("_s")


def rank_desc(df: DataFrame, metric: str, tie: str, out: str = "ranking", partition=None) -> DataFrame:
    """1 = largest metric, ties broken by ``tie`` ascending (WIN-2)."""
    w = Window.orderBy(F.col(metric).desc_nulls_last(), F.col(tie).asc())
    if partition:
        w = Window.partitionBy(*_cols(partition)).orderBy(F.col(metric).desc_nulls_last(), F.col(tie).asc())
    return df.withColumn(out, F.row_number().over(w).cast("bigint"))


def scalars(df: DataFrame, **aggs: Column) -> Column:
    """Several aggregates of ``df`` as ONE struct-valued scalar subquery (one
    extra job instead of one per value).  Attach it once with
    :func:`with_scalars` and read fields from that column: every direct reuse of
    the returned expression would be planned as a separate subquery."""
    return df.select(F.struct(*[a.alias(k) for k, a in aggs.items()])).scalar()


def with_scalars(df: DataFrame, name: str, source: DataFrame | None = None, bounded: bool = False,
                 **aggs: Column) -> DataFrame:
    """``df`` plus a struct column ``name`` holding aggregates of ``source``
    (default ``df``) computed by a single scalar subquery.

    ``bounded=True`` is for dimension-sized inputs only (one row per court or
    department, a fixed territorial domain): the aggregates are then a window
    over the whole (tiny) frame, which avoids re-running the frame's upstream
    joins for the subquery."""
    if bounded and source is None:
        w = Window.partitionBy()
        return df.withColumn(name, F.struct(*[a.over(w).alias(k) for k, a in aggs.items()]))
    return df.withColumn(name, scalars(source if source is not None else df, **aggs))


def minmax_class(df: DataFrame, metric: str, out: str = "clase",
                 labels=("bajo", "medio", "alto"), cuts=(0.33, 0.66), bounded: bool = False) -> DataFrame:
    """Equal-width tercile class of a min-max scaled metric (WIN-7), not ``ntile``.

    min and max come from one scalar subquery: no single-partition window, no cross join."""
    x = with_scalars(df, "_mm", bounded=bounded, mn=F.min(metric), mx=F.max(metric))
    mn, mx = F.col("_mm.mn"), F.col("_mm.mx")
    rng = mx - mn
    t = (F.col(metric) - mn) / F.when(rng == 0, F.lit(1.0)).otherwise(rng)
    return x.withColumn(out, F.when(t < cuts[0], labels[0]).when(t < cuts[1], labels[1]).otherwise(labels[2])).drop("_mm")


def share_of_max(df: DataFrame, metric: str, out: str, bounded: bool = False) -> DataFrame:
    """metric / max(metric) over all rows (WIN-8), max as a scalar subquery
    (or a whole-frame window for dimension-sized inputs, see :func:`with_scalars`)."""
    x = with_scalars(df, "_mx", bounded=bounded, mx=F.max(metric))
    return x.withColumn(out, F.try_divide(F.col(metric).cast("double"), F.col("_mx.mx").cast("double"))).drop("_mx")


def year_over_year(df: DataFrame, key, year: str, value: str) -> DataFrame:
    """Previous value, change, percent change and per-key trend slope (WIN-9)."""
    key = _cols(key)
    w = Window.partitionBy(*key).orderBy(year)
    wk = Window.partitionBy(*key)
    prev = F.lag(value).over(w)
    return (df.withColumn("prev", prev)
              .withColumn("delta", F.col(value) - F.col("prev"))
              .withColumn("pct_change", F.try_divide((F.col(value) - F.col("prev")).cast("double") * 100.0,
                                                     F.col("prev").cast("double")))
              .withColumn("slope", exact_slope_over(value, year, wk)))


def peer_benchmark(df: DataFrame, peer, metric: str) -> DataFrame:
    """z-score and percent rank within a peer group (WIN-10)."""
    peer = _cols(peer)
    wp = Window.partitionBy(*peer)
    wo = Window.partitionBy(*peer).orderBy(metric)
    return (df.withColumn("peer_mean", F.avg(metric).over(wp))
              .withColumn("peer_sd", F.stddev_samp(metric).over(wp))
              .withColumn("z", F.try_divide(F.col(metric) - F.col("peer_mean"), F.col("peer_sd")))
              .withColumn("pct_rank", F.percent_rank().over(wo)))


def iqr_outliers(df: DataFrame, group, metric: str, k: float = 1.5) -> DataFrame:
    """IQR fences per group joined back; flag outside [q1-k*iqr, q3+k*iqr] (WIN-11).

    Quartiles are an aggregate (one row per group), joined back on the group."""
    group = _cols(group)
    q = df.groupBy(*group).agg(F.percentile(metric, 0.25).alias("q1"), F.percentile(metric, 0.75).alias("q3"))
    x = df.join(q, on=group, how="left")
    iqr = F.col("q3") - F.col("q1")
    return x.withColumn("is_outlier", (F.col(metric) < F.col("q1") - k * iqr) | (F.col(metric) > F.col("q3") + k * iqr))


def seasonal_index(df: DataFrame, key, month: str, value: str) -> DataFrame:
    """Average of a calendar month over the average of all periods, per key (WIN-12).

    Input: one row per (key, period) with its ``month`` and ``value``."""
    key = _cols(key)
    per_month = df.groupBy(*key, month).agg(F.avg(F.col(value).cast("double")).alias("avg_month"),
                                           F.count(F.lit(1)).alias("n_periods"))
    overall = df.groupBy(*key).agg(F.avg(F.col(value).cast("double")).alias("avg_all"))
    return per_month.join(overall, on=key, how="inner").withColumn(
        "indice", F.try_divide(F.col("avg_month"), F.col("avg_all")))


def deseasonalise(df: DataFrame, key, period: str, value: str, season: int = 12) -> DataFrame:
    """Series adjusted for the season (WIN-12): trend, seasonal index and adjusted value of every period.

    ``period`` numbers the periods without gaps (e.g. year * 12 + month), one row per key and
    period; periods may be missing.  The trend is the centred moving average over one
    season, its two outer periods counting half, over the periods that are there.  The
    index of a period of the season is the mean of value / trend, scaled to a mean of 1 over the
    season's periods; the adjusted value is the value over the index."""
    key = _cols(key)
    w = Window.partitionBy(*key).orderBy(period)
    half = season // 2
    v = F.col(value).cast("double")

    def span(a, b, agg):
        return F.coalesce(agg.over(w.rangeBetween(a, b)), F.lit(0.0))

    total = span(-half + 1, half - 1, F.sum(v)) + 0.5 * (span(-half, -half, F.sum(v)) + span(half, half, F.sum(v)))
    weight = span(-half + 1, half - 1, F.count(v)) + 0.5 * (span(-half, -half, F.count(v)) + span(half, half, F.count(v)))
    x = df.withColumn("tendencia", F.try_divide(total, weight)).withColumn("_season", F.col(period) % season)
    raw = x.groupBy(*key, "_season").agg(F.avg(F.try_divide(v, F.col("tendencia"))).alias("_raw"))
    level = raw.groupBy(*key).agg(F.avg("_raw").alias("_level"))
    out = x.join(raw, [*key, "_season"]).join(level, key).withColumn("indice", F.try_divide(F.col("_raw"), F.col("_level")))
    return out.withColumn("ajustado", F.try_divide(v, F.col("indice"))).drop("_raw", "_level", "_season")
