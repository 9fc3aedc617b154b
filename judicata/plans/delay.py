"""Case-level delay family (JOB-5, JOB-6): in/out, delay profile, histogram,
event de-duplication, bad-row audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from judicata.operators import aggregate as A
from judicata.operators import clean as C
from judicata.operators import sets as S
from judicata.operators.match import DELAY_EDGES
from judicata.plans import register
from judicata.plans.common import CASE_LINES_SQL, case_lines
from judicata.tables import Tables


# ----------------------------------------------------------------- yearly_in_out
@register("yearly_in_out", sql="""
WITH i AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS anio, COUNT(*) AS ingresados FROM orders GROUP BY 1),
     p AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS anio, COUNT(*) AS publicados FROM lineitem
           WHERE l_linestatus = 'F' GROUP BY 1)
SELECT COALESCE(i.anio, p.anio) AS anio, COALESCE(ingresados, 0) AS ingresados, COALESCE(publicados, 0) AS publicados
FROM i FULL OUTER JOIN p ON i.anio = p.anio
""")
def yearly_in_out(spark, sf):
    """Cases filed and resolutions published per year (AGG-4), full outer merge with zeros (JN-5, PRJ-12)."""
    t = Tables(spark, sf)
    i = t.orders("o_orderdate").groupBy(F.year("o_orderdate").cast("int").alias("anio")).agg(
        F.count(F.lit(1)).alias("ingresados"))
    p = (t.lineitem("l_shipdate", "l_linestatus").where(F.col("l_linestatus") == "F")
         .groupBy(F.year("l_shipdate").cast("int").alias("anio")).agg(F.count(F.lit(1)).alias("publicados")))
    j = i.join(p, "anio", "full_outer")
    return j.select("anio", F.coalesce("ingresados", F.lit(0)).alias("ingresados"),
                    F.coalesce("publicados", F.lit(0)).alias("publicados"))


# ----------------------------------------------------------------- delay_profile
@register("delay_profile", sql=f"""
WITH {CASE_LINES_SQL}
SELECT CASE WHEN GROUPING(tipo) = 1 THEN 'TOTAL' ELSE tipo END AS tipo,
       COUNT(*) FILTER (WHERE dias >= 0) AS n,
       avg(dias) FILTER (WHERE dias >= 0) AS mean,
       min(dias) FILTER (WHERE dias >= 0) AS min,
       max(dias) FILTER (WHERE dias >= 0) AS max,
       quantile_cont(dias, 0.5) FILTER (WHERE dias >= 0) AS median,
       quantile_cont(dias, 0.9) FILTER (WHERE dias >= 0) AS p90,
       COUNT(*) FILTER (WHERE dias < 0) AS n_negativos,
       CAST(GROUPING(tipo) AS INTEGER) AS is_global
FROM case_lines GROUP BY ROLLUP (tipo)
HAVING GROUPING(tipo) = 1 OR COUNT(*) FILTER (WHERE dias >= 0) >= 30
""")
def delay_profile(spark, sf):
    """Delay in days from case microdata (PRJ-15, FLT-4): n, mean, min, max, exact
    median and p90 per process type with n >= 30, plus the global row (AGG-5..8, FLT-11).

    Exact quantiles come from a (type, days) histogram: partial aggregation
    shrinks a hot type before the shuffle, and the global row is a rollup of
    the histogram, not a second pass over the cases."""
    h = A.value_histogram(case_lines(spark, sf), "tipo", "dias")
    ok = F.col("dias") >= 0
    v = F.when(ok, F.col("dias"))
    w = F.col("_w")
    prof = h.rollup("tipo").agg(
        F.sum(F.when(ok, w).otherwise(0)).cast("bigint").alias("n"),
        F.try_divide(F.sum(F.when(ok, F.col("dias") * w)).cast("double"),
                     F.sum(F.when(ok, w)).cast("double")).alias("mean"),
        F.min(v).alias("min"), F.max(v).alias("max"),
        F.percentile(v, F.lit(0.5), w).cast("double").alias("median"),
        F.percentile(v, F.lit(0.9), w).cast("double").alias("p90"),
        F.sum(F.when(~ok, w).otherwise(0)).cast("bigint").alias("n_negativos"),
        F.grouping("tipo").cast("int").alias("is_global"))
    prof = prof.where((F.col("is_global") == 1) | (F.col("n") >= 30))
    return prof.withColumn("tipo", F.when(F.col("is_global") == 1, F.lit("TOTAL")).otherwise(F.col("tipo")))


# ----------------------------------------------------------------- delay_histogram
_BUCKETS_SQL = ", ".join(
    f"({i}, '{lo}-{DELAY_EDGES[i + 1]}', {lo}, {DELAY_EDGES[i + 1]})" if i + 1 < len(DELAY_EDGES)
    else f"({i}, '{lo}+', {lo}, NULL)" for i, lo in enumerate(DELAY_EDGES))


@register("delay_histogram", sql=f"""
WITH {CASE_LINES_SQL},
v AS (SELECT tipo, dias FROM case_lines WHERE dias >= 0),
b AS (SELECT * FROM (VALUES {_BUCKETS_SQL}) t(bucket, rango, desde, hasta)),
t AS (SELECT DISTINCT tipo FROM v)
SELECT t.tipo, b.bucket, b.rango, b.desde, b.hasta, COUNT(v.dias) AS n
FROM t CROSS JOIN b
LEFT JOIN v ON v.tipo = t.tipo AND v.dias >= b.desde AND (b.hasta IS NULL OR v.dias < b.hasta)
GROUP BY t.tipo, b.bucket, b.rango, b.desde, b.hasta
""")
def delay_histogram(spark, sf):
    """Fixed-bucket delay histogram per process type; empty buckets kept with 0 (JN-6, AGG-9)."""
    cl = case_lines(spark, sf).where(F.col("dias") >= 0)
    h = A.value_histogram(cl, "tipo", "dias")
    return A.bucket_counts(h, "tipo", "dias", DELAY_EDGES, weight="_w")


# ----------------------------------------------------------------- event_dedup
_LI = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
       "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


@register("event_dedup", sql="""
SELECT * EXCLUDE (rn) FROM (
  SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice,
         l_discount, l_tax, l_returnflag, l_linestatus,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                            ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                                     l_discount, l_tax, l_returnflag, l_linestatus) AS rn,
         COUNT(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n_copies
  FROM lineitem) WHERE rn = 1
""")
def event_dedup(spark, sf):
    """Collapse per-party duplicate rows of one ruling to one event, keeping a
    deterministic first row (SET-4)."""
    li = Tables(spark, sf).lineitem(*_LI)
    return S.dedup_first(li, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"])


# ----------------------------------------------------------------- bad_row_audit
@register("bad_row_audit", sql="""
WITH x AS (SELECT nullif(l_quantity, 50.0) - 5.0 AS medida,
                  nullif(CAST(year(l_shipdate) AS INTEGER), 1998) AS anio FROM lineitem),
m AS (SELECT *, COALESCE(medida < 0, false) AS neg, anio IS NULL AS anio_nulo,
             COALESCE(NOT (anio BETWEEN 1995 AND 2000), false) AS fuera FROM x),
b AS (SELECT *, neg OR anio_nulo OR fuera AS bad FROM m)
SELECT * FROM (VALUES (0, 'read', (SELECT COUNT(*) FROM b)),
                      (1, 'negativos', (SELECT COUNT(*) FROM b WHERE neg)),
                      (2, 'anio_nulo', (SELECT COUNT(*) FROM b WHERE anio_nulo)),
                      (3, 'anio_fuera_rango', (SELECT COUNT(*) FROM b WHERE fuera)),
                      (4, 'descartadas', (SELECT COUNT(*) FROM b WHERE bad)),
                      (5, 'validas', (SELECT COUNT(*) FROM b WHERE NOT bad)),
                      (6, 'medida_nula_conservada', (SELECT COUNT(*) FROM b WHERE medida IS NULL AND NOT bad)))
     t(ord, rule, n)
""")
def bad_row_audit(spark, sf):
    """Bad-row mask with injected nulls (FLT-1/2, TRAP-2): a null measure is
    kept, a null or out-of-range year is dropped; counts per rule in one pass."""
    li = Tables(spark, sf).lineitem("l_quantity", "l_shipdate")
    x = li.select((F.nullif(F.col("l_quantity"), F.lit(50.0)) - F.lit(5.0)).alias("medida"),
                  F.nullif(F.year("l_shipdate").cast("int"), F.lit(1998)).alias("anio"))
    bad = C.bad_row_mask(["medida"], "anio", 1995, 2000)
    rules = {
        "negativos": F.col("medida") < 0,
        "anio_nulo": F.col("anio").isNull(),
        "anio_fuera_rango": ~F.col("anio").between(1995, 2000),
        "descartadas": bad,
        "validas": ~bad,
        "medida_nula_conservada": F.col("medida").isNull() & ~bad,
    }
    return C.rule_counts(x, rules)
