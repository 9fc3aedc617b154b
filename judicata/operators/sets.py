"""Set operations and de-duplication (SET-*)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _cols(x):
    return [x] if isinstance(x, str) else list(x)


def dedup_first(df: DataFrame, key, order, count_col: str | None = "n_copies") -> DataFrame:
    """Collapse duplicates on ``key`` keeping the first row in ``order`` (SET-4).

    The kept row is ``min(struct(order..., rest...))``, an aggregate with a
    partial (map-side) phase: a key with a third of all rows is reduced inside
    every task before the shuffle, never gathered into one window partition.
    Fully identical rows are interchangeable, so the result is deterministic."""
    key = _cols(key)
    order = _cols(order)
    rest = [c for c in df.columns if c not in key and c not in order]
    if not order + rest:
        return df.groupBy(*key).agg(F.count(F.lit(1)).alias(count_col)) if count_col else df.select(*key).distinct()
    rec = F.struct(*[F.col(c) for c in order + rest])
    aggs = [F.min(rec).alias("_r")]
    if count_col:
        aggs.append(F.count(F.lit(1)).alias(count_col))
    out = df.groupBy(*key).agg(*aggs)
    cols = [*key, *[F.col(f"_r.{c}").alias(c) for c in order + rest]]
    if count_col:
        cols.append(F.col(count_col))
    return out.select(*cols)


def union_shapes(parts: list[tuple[str, DataFrame, dict]], label: str = "etiqueta") -> DataFrame:
    """Union of differently shaped results projected to one schema (SET-2).

    Each part is (prefix, frame, {output column: source column}); the ``label``
    column gets ``prefix: value`` of the part's ``label`` source column."""
    out = None
    for prefix, df, mapping in parts:
        cols = []
        for o, src in mapping.items():
            c = F.col(src)
            if o == label:
                c = F.concat(F.lit(f"{prefix}: "), c.cast("string"))
            cols.append(c.alias(o))
        p = df.select(*cols)
        out = p if out is None else out.unionByName(p, allowMissingColumns=True)
    return out


def duplicate_feeds(totals: DataFrame, dataset: str, period: str, total: str) -> DataFrame:
    """Pairs of datasets reporting the identical total for the same period (SET-8).

    ``totals`` is read once: the names with one total in a period, as many as there are datasets at
    most, are brought together and paired."""
    same = (totals.groupBy(period, total).agg(F.array_sort(F.collect_set(dataset)).alias("_d")).where(F.size("_d") > 1)
            .select(period, total, "_d", F.posexplode("_d").alias("_i", "dataset_a")))
    later = same.select(period, total, "dataset_a", F.explode(F.slice("_d", F.col("_i") + 2, F.size("_d"))).alias("dataset_b"))
    return later
