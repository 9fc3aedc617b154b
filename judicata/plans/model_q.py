"""Model family: delay model metrics (ML-1..6), drift (ML-11), priority index (ML-12)."""

from __future__ import annotations

from pyspark.sql import functions as F

from judicata.functions.dates import month_of_yyyymm
from judicata.ml import delay_model as DM
from judicata.operators import windows as WN
from judicata.plans import register
from judicata.plans.common import CASE_LINES_SQL, CASES_SQL, case_lines, cases, flow_aggs
from judicata.session import materialise
from judicata.tables import Tables

CAT = ["tipo", "especialidad", "corte", "l_returnflag", "l_linestatus"]
NUM = ["mes_anio"]


def _fitted(spark, sf):
    """(model, hold-out predictions, metrics); the features are written once for the passes of the fit."""
    return DM.fit_and_score(materialise(_features(spark, sf)), ["o_orderkey", "l_linenumber"], CAT, NUM, "dias")


@register("delay_model_metrics")
def delay_model_metrics(spark, sf):
    """Hold-out metrics of the gradient-boosted delay model (ML-2..5)."""
    return _fitted(spark, sf)[2]


@register("delay_model_by_type")
def delay_model_by_type(spark, sf):
    """Real vs. predicted median delay per process type on hold-out rows only
    (ML-6; training rows are excluded on purpose, TRAP-8)."""
    return DM.median_by_group(_fitted(spark, sf)[1], "tipo", "dias")


def _features(spark, sf):
    t = Tables(spark, sf)
    c = cases(spark, sf)
    li = t.lineitem("l_orderkey", "l_linenumber", "l_shipdate", "l_returnflag", "l_linestatus")
    x = c.join(li, c.o_orderkey == li.l_orderkey)
    x = x.withColumn("dias", F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate")))
    x = x.where(F.col("dias").between(1, 998))
    yyyymm = F.year("o_orderdate") * 100 + F.month("o_orderdate")
    x = x.withColumn("mes_anio", month_of_yyyymm(yyyymm).cast("double"))
    return x.select("o_orderkey", "l_linenumber", *CAT, *NUM, F.col("dias").cast("double").alias("dias"))


BUCKET_WIDTH = 50_000.0
N_BUCKETS = 10
SPLIT_YEAR = 1998


@register("drift_psi", sql=f"""
WITH b AS (SELECT CAST(least(floor(o_totalprice / {BUCKET_WIDTH}), {N_BUCKETS - 1}) AS INTEGER) AS bucket,
                  year(o_orderdate) < {SPLIT_YEAR} AS antes FROM orders),
c AS (SELECT bucket, COUNT(*) FILTER (WHERE antes) AS n_a, COUNT(*) FILTER (WHERE NOT antes) AS n_b FROM b GROUP BY bucket),
s AS (SELECT *, n_a::DOUBLE / (SELECT sum(n_a) FROM c)::DOUBLE AS share_a,
                n_b::DOUBLE / (SELECT sum(n_b) FROM c)::DOUBLE AS share_b FROM c),
p AS (SELECT *, CASE WHEN share_a > 0 AND share_b > 0 THEN (share_a - share_b) * ln(share_a / share_b) END AS psi_i FROM s)
SELECT *, (SELECT sum(psi_i) FROM p) AS psi_total FROM p
""")
def drift_psi(spark, sf):
    """Population stability of the case-value distribution before vs. after a year (ML-11)."""
    o = Tables(spark, sf).orders("o_totalprice", "o_orderdate")
    b = o.select(F.least(F.floor(F.col("o_totalprice") / BUCKET_WIDTH), F.lit(N_BUCKETS - 1)).cast("int").alias("bucket"),
                 (F.year("o_orderdate") < SPLIT_YEAR).alias("antes"))
    c = b.groupBy("bucket").agg(F.count_if(F.col("antes")).alias("n_a"), F.count_if(~F.col("antes")).alias("n_b"))
    return DM.psi(c, "bucket", "n_a", "n_b")


# Weights of the priority index components.
WEIGHTS = {"carga": 0.4, "atraso": 0.3, "demora": 0.3}


@register("priority_index", sql=f"""
WITH {CASE_LINES_SQL},
f AS (SELECT corte, COUNT(*) AS ingresos, COUNT(*) FILTER (WHERE estado IN ('O', 'P')) AS pendientes FROM cases GROUP BY corte),
j AS (SELECT n.n_name AS corte, COUNT(*) AS jueces FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey GROUP BY 1),
d AS (SELECT corte, avg(dias) AS demora FROM case_lines WHERE dias >= 0 GROUP BY corte),
m AS (SELECT f.corte, f.ingresos::DOUBLE / NULLIF(j.jueces, 0)::DOUBLE AS carga,
             f.pendientes::DOUBLE / NULLIF(f.ingresos, 0)::DOUBLE AS atraso, d.demora
      FROM f JOIN j ON f.corte = j.corte JOIN d ON f.corte = d.corte),
s AS (SELECT min(carga) a0, max(carga) a1, min(atraso) b0, max(atraso) b1, min(demora) c0, max(demora) c1 FROM m),
x AS (SELECT m.*,
        {WEIGHTS['carga']} * (carga - a0) / CASE WHEN a1 - a0 = 0 THEN 1.0 ELSE a1 - a0 END
      + {WEIGHTS['atraso']} * (atraso - b0) / CASE WHEN b1 - b0 = 0 THEN 1.0 ELSE b1 - b0 END
      + {WEIGHTS['demora']} * (demora - c0) / CASE WHEN c1 - c0 = 0 THEN 1.0 ELSE c1 - c0 END AS indice
      FROM m, s)
SELECT corte, carga, atraso, demora, indice, row_number() OVER (ORDER BY indice DESC, corte) AS prioridad FROM x
""")
def priority_index(spark, sf):
    """Investment-priority index per court: min-max scaled load per judge,
    pending share and mean delay, weighted and ranked (ML-12).  Inputs are
    one row per court (a fixed domain), so the final ordering is bounded."""
    t = Tables(spark, sf)
    f = cases(spark, sf).groupBy("corte").agg(*flow_aggs())
    n = t.nation("n_nationkey", "n_name")
    j = (t.supplier("s_nationkey").join(F.broadcast(n), F.col("s_nationkey") == n.n_nationkey)
         .groupBy(F.col("n_name").alias("corte")).agg(F.count(F.lit(1)).alias("jueces")))
    d = case_lines(spark, sf).where(F.col("dias") >= 0).groupBy("corte").agg(F.avg("dias").alias("demora"))
    m = f.join(j, "corte").join(d, "corte").select(
        "corte", F.try_divide(F.col("ingresos").cast("double"), F.col("jueces").cast("double")).alias("carga"),
        F.try_divide(F.col("pendientes").cast("double"), F.col("ingresos").cast("double")).alias("atraso"), "demora")
    idx = None
    m = WN.with_scalars(m, "_mm", bounded=True,       # one row per court
                        **{f"{c}_{k}": f(c) for c in WEIGHTS for k, f in (("lo", F.min), ("hi", F.max))})
    for col, w in WEIGHTS.items():
        lo, hi = F.col(f"_mm.{col}_lo"), F.col(f"_mm.{col}_hi")
        rng = hi - lo
        term = F.lit(w) * (F.col(col) - lo) / F.when(rng == 0, F.lit(1.0)).otherwise(rng)
        idx = term if idx is None else idx + term
    m = m.withColumn("indice", idx).drop("_mm")
    return WN.rank_desc(m, "indice", "corte", out="prioridad")


# ----------------------------------------------------------------- workload_forecast (ML-9)
@register("workload_forecast", sql=f"""
WITH {CASES_SQL},
m AS (SELECT corte, anio, mes, COUNT(*) AS n FROM cases GROUP BY 1, 2, 3),
full_years AS (SELECT anio FROM (SELECT anio, COUNT(DISTINCT mes) AS k FROM cases GROUP BY anio) WHERE k = 12),
last AS (SELECT max(anio) AS l FROM full_years),
y AS (SELECT corte, anio, sum(n) AS total FROM m WHERE anio IN (SELECT anio FROM full_years) GROUP BY 1, 2),
s AS (SELECT corte, (COUNT(*) * sum(anio * total) - sum(anio) * sum(total))::DOUBLE
                    / NULLIF(COUNT(*) * sum(anio * anio) - sum(anio) * sum(anio), 0)::DOUBLE AS pendiente
      FROM y GROUP BY corte)
SELECT m.corte, m.mes, m.n AS base, s.pendiente, m.n + s.pendiente / 12.0 AS pronostico
FROM m JOIN s ON m.corte = s.corte WHERE m.anio = (SELECT l FROM last)
""")
def workload_forecast(spark, sf):
    """Next-year monthly filings per court: seasonal naive (same month of the last
    complete year, FLT-14) plus a twelfth of the yearly linear trend (ML-9)."""
    c = cases(spark, sf)
    m = c.groupBy("corte", "anio", "mes").agg(F.count(F.lit(1)).alias("n"))
    full = c.groupBy("anio").agg(F.count_distinct("mes").alias("k")).where(F.col("k") == 12).select("anio")
    last = full.select(F.max("anio")).scalar()
    y = m.join(full, "anio", "left_semi").groupBy("corte", "anio").agg(F.sum("n").alias("total"))
    from judicata.operators.aggregate import exact_slope
    s = y.groupBy("corte").agg(exact_slope("total", "anio").alias("pendiente"))
    x = m.where(F.col("anio") == last).join(s, "corte", "inner")
    return x.select("corte", "mes", F.col("n").alias("base"), "pendiente",
                    (F.col("n") + F.col("pendiente") / 12.0).alias("pronostico"))


# ----------------------------------------------------------------- weighted_rates (ML-13)
@register("weighted_rates", sql="""
SELECT r.r_name AS departamento, COUNT(*) AS n, sum(l.l_quantity) AS peso_total,
       sum(l.l_quantity * CASE WHEN l.l_returnflag = 'R' THEN 1.0 ELSE 0.0 END) / sum(l.l_quantity) AS tasa_ponderada,
       avg(CASE WHEN l.l_returnflag = 'R' THEN 1.0 ELSE 0.0 END) AS tasa_simple
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY r.r_name
""")
def weighted_rates(spark, sf):
    """Survey-style rates with expansion factors: sum(w*x)/sum(w) next to the
    unweighted rate, per department (ML-13)."""
    from judicata.operators.aggregate import weighted_mean
    t = Tables(spark, sf)
    n = t.nation("n_nationkey", "n_regionkey")
    r = t.region("r_regionkey", "r_name")
    terr = F.broadcast(n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name"))
    li = t.lineitem("l_suppkey", "l_quantity", "l_returnflag")
    s = t.supplier("s_suppkey", "s_nationkey")
    x = li.join(s, li.l_suppkey == s.s_suppkey).join(terr, F.col("s_nationkey") == F.col("n_nationkey"))
    flag = F.when(F.col("l_returnflag") == "R", F.lit(1.0)).otherwise(F.lit(0.0))
    return x.groupBy(F.col("r_name").alias("departamento")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("peso_total"),
        weighted_mean(flag, "l_quantity").alias("tasa_ponderada"), F.avg(flag).alias("tasa_simple"))


# ----------------------------------------------------------------- risk_labels (ML-8)
@register("risk_labels", sql=f"""
WITH {CASE_LINES_SQL},
v AS (SELECT tipo, dias FROM case_lines WHERE dias BETWEEN 1 AND 998),
q AS (SELECT quantile_cont(dias, 0.75) AS p75 FROM v)
SELECT tipo, COUNT(*) AS n, COUNT(*) FILTER (WHERE dias > (SELECT p75 FROM q)) AS n_riesgo,
       (COUNT(*) FILTER (WHERE dias > (SELECT p75 FROM q)))::DOUBLE / COUNT(*)::DOUBLE AS proporcion_riesgo,
       (SELECT p75 FROM q) AS umbral
FROM v GROUP BY tipo
""")
def risk_labels(spark, sf):
    """Risk label = delay above the p75 of valid delays (ML-8): the threshold and the
    counts come from one (type, days) histogram, written once."""
    v = case_lines(spark, sf).where(F.col("dias").between(1, 998)).select("tipo", "dias")
    h = materialise(v.groupBy("tipo", "dias").agg(F.count(F.lit(1)).alias("_w")))
    x = WN.with_scalars(h, "_q", p75=F.percentile("dias", F.lit(0.75), F.col("_w")).cast("double"))
    out = x.groupBy("tipo").agg(F.sum("_w").cast("bigint").alias("n"),
                                F.coalesce(F.sum(F.when(F.col("dias") > F.col("_q.p75"), F.col("_w"))), F.lit(0)).cast("bigint").alias("n_riesgo"),
                                F.first("_q.p75").alias("umbral"))
    return out.withColumn("proporcion_riesgo", F.col("n_riesgo").cast("double") / F.col("n").cast("double"))
