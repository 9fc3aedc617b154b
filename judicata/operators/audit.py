"""Quality audits (AUD-3, AUD-5, AUD-6, JN-11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _cols(x):
    return [x] if isinstance(x, str) else list(x)


def pk_profile(df: DataFrame, pk, name: str) -> DataFrame:
    """(tabla, n_rows, n_keys, n_dup_keys, n_dup_rows) for a declared primary key."""
    pk = _cols(pk)
    per = df.groupBy(*pk).agg(F.count(F.lit(1)).alias("_c"))
    return per.agg(F.lit(name).alias("tabla"),
                   F.sum("_c").cast("bigint").alias("n_rows"),
                   F.count(F.lit(1)).alias("n_keys"),
                   F.count_if(F.col("_c") > 1).alias("n_dup_keys"),
                   F.coalesce(F.sum(F.when(F.col("_c") > 1, F.col("_c"))), F.lit(0)).cast("bigint").alias("n_dup_rows"))


def fk_orphans(child: DataFrame, fk, parent: DataFrame, pk, name: str) -> DataFrame:
    """(fk, n_child, n_orphans): child rows whose key has no parent.  Children are
    counted by key before the join, so a hot key is one row of it."""
    fk, pk = _cols(fk), _cols(pk)
    p = parent.select(*[F.col(a).alias(b) for a, b in zip(pk, fk)]).distinct().withColumn("_hit", F.lit(True))
    keys = child.groupBy(*fk).agg(F.count(F.lit(1)).alias("_n")).join(p, on=fk, how="left")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return keys.agg(F.lit(name).alias("fk"), total(F.col("_n")).alias("n_child"),
                    total(F.when(F.col("_hit").isNull(), F.col("_n"))).alias("n_orphans"))


def conservation(rollups: dict[str, DataFrame], measure: str, reference: str) -> DataFrame:
    """Totals of one measure over different rollups and whether each equals ``reference``'s."""
    parts = [df.agg(F.lit(name).alias("rollup"), F.sum(measure).cast("bigint").alias("total"))
             for name, df in rollups.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    ref = rollups[reference].select(F.sum(measure).cast("bigint")).scalar()
    return out.withColumn("cuadra", F.col("total") == ref)


def conservation_by(df: DataFrame, dims: list[str], measure: str, total: str = "nacional") -> DataFrame:
    """:func:`conservation` of the rollups by each dimension and the grand total in one pass:
    the finest totals are added up by grouping sets, and a row a rollup is compared with the grand total."""
    fine = df.groupBy(*dims).agg(F.sum(measure).cast("bigint").alias("_v"))
    sets = fine.groupingSets([[d] for d in dims] + [[]], *dims).agg(F.sum("_v").alias("_v"), F.grouping_id(*dims).alias("_g"))
    name = F.lit(total)
    for i, d in enumerate(dims):
        name = F.when(F.col("_g") == ((1 << len(dims)) - 1) ^ (1 << (len(dims) - 1 - i)), F.lit(d)).otherwise(name)
    rollups = sets.groupBy(name.alias("rollup")).agg(F.sum("_v").cast("bigint").alias("total"))
    rows = rollups.agg(F.collect_list(F.struct("rollup", "total")).alias("_r"),
                       F.max(F.when(F.col("rollup") == total, F.col("total"))).alias("_ref"))             # a row a dimension
    return rows.select("_ref", F.inline("_r")).select("rollup", "total", (F.col("total") == F.col("_ref")).alias("cuadra"))


def identity_violations(df: DataFrame, checks: dict[str, tuple]) -> DataFrame:
    """Arithmetic identities (AUD-2), e.g. ``{"ingresos": (sin + con, t + e)}``:
    rows where |lhs - rhs| > 0, per identity, in one pass."""
    aggs = [F.count_if(F.abs(lhs - rhs) > 0).alias(name) for name, (lhs, rhs) in checks.items()]
    return df.agg(*aggs).unpivot([], list(checks), "identidad", "violaciones")


def magnitude_check(actual: DataFrame, reference: DataFrame, key: str, value: str, band: float = 10.0) -> DataFrame:
    """Order-of-magnitude check against reference values (AUD-4): flagged when the
    ratio actual/reference falls outside [1/band, band]."""
    x = actual.join(reference.withColumnRenamed(value, "_ref"), key, "left")
    r = F.try_divide(F.col(value).cast("double"), F.col("_ref").cast("double"))
    return x.withColumn("ratio", r).withColumn("fuera_de_banda", (r > band) | (r < 1.0 / band))


def standard_gap(df: DataFrame, standards: DataFrame, key: str, measure: str, standard: str = "estandar") -> DataFrame:
    """Resolved minus the standard of the organ type (JN-14); organs without a standard keep null."""
    return df.join(standards, key, "left").withColumn("brecha", F.col(measure) - F.col(standard))


def crosswalk(df: DataFrame, xwalk: DataFrame, code: str, to: str) -> tuple[DataFrame, DataFrame]:
    """Territory code crosswalk (JN-15): (mapped rows via left join, uncovered codes via anti join)."""
    mapped = df.join(xwalk.select(code, to), code, "left")
    uncovered = df.select(code).distinct().join(xwalk.select(code), code, "left_anti")
    return mapped, uncovered
