"""Court workload family (JOB-1/3/15): flows, indicators, rankings, rollups, cube."""

from __future__ import annotations

from pyspark.sql import functions as F

from judicata.functions import metrics as M
from judicata.functions.classify import alert_level
from judicata.functions.dates import age_days
from judicata.operators import aggregate as A
from judicata.operators import audit as AU
from judicata.operators import clean as C
from judicata.operators import windows as WN
from judicata.plans import register
from judicata.plans.common import (AS_OF, CASE_LINES_SQL, CASES_SQL, FLOW_SQL, IND_SQL, case_lines, cases,
                                   dim, flow_aggs, flow_sums, with_indicators)
from judicata.tables import Tables


# ----------------------------------------------------------------- workload_by_court
@register("workload_by_court", sql=f"""
WITH {CASES_SQL},
f AS (SELECT corte, anio, {FLOW_SQL} FROM cases GROUP BY corte, anio)
SELECT corte, anio, ingresos, resueltos, pendientes, {IND_SQL} FROM f
""")
def workload_by_court(spark, sf):
    """Flows and IND-1/2/3/6 per court and year (AGG-2, JN-1); pendientes is the backlog stock (IND-16)."""
    return with_indicators(cases(spark, sf).groupBy("corte", "anio").agg(*flow_aggs()))


# ----------------------------------------------------------------- workload_national
@register("workload_national", sql=f"""
WITH {CASE_LINES_SQL},
f AS (SELECT {FLOW_SQL} FROM cases),
d AS (SELECT corte, avg(dias) AS demora FROM case_lines WHERE dias >= 0 GROUP BY corte),
i AS (SELECT corte, COUNT(*) AS ing FROM cases GROUP BY corte),
w AS (SELECT sum(d.demora * i.ing) / sum(i.ing)::DOUBLE AS demora_ponderada,
             avg(d.demora) AS demora_simple FROM d JOIN i ON d.corte = i.corte)
SELECT ingresos, resueltos, pendientes, {IND_SQL}, w.demora_ponderada, w.demora_simple FROM f, w
""")
def workload_national(spark, sf):
    """National KPIs (AGG-1) with the ingresos-weighted and plain mean court delay (AGG-13/14)."""
    # one pass over the cases: national totals are sums of the per-court flows
    per_court = cases(spark, sf).groupBy("corte").agg(*flow_aggs())
    d = (case_lines(spark, sf).where(F.col("dias") >= 0)
         .groupBy("corte").agg(F.avg("dias").alias("demora")))
    x = per_court.join(d, "corte", "left")
    weight = F.when(F.col("demora").isNotNull(), F.col("ingresos"))
    nat = x.agg(*flow_sums(), A.weighted_mean(F.col("demora"), weight).alias("demora_ponderada"), F.avg("demora").alias("demora_simple"))
    nat = with_indicators(nat)
    return nat.select(*[c for c in nat.columns if not c.startswith("demora")], "demora_ponderada", "demora_simple")


# ----------------------------------------------------------------- court_ranking
@register("court_ranking", sql=f"""
WITH {CASES_SQL},
c AS (SELECT corte, {FLOW_SQL} FROM cases GROUP BY corte),
m AS (SELECT *, (pendientes + ingresos)::DOUBLE / NULLIF(resueltos, 0)::DOUBLE AS congestion FROM c),
s AS (SELECT min(congestion) AS mn, max(congestion) AS mx, max(ingresos) AS mi FROM m)
SELECT corte, ingresos, resueltos, pendientes, congestion,
       row_number() OVER (ORDER BY congestion DESC NULLS LAST, corte) AS ranking,
       CASE WHEN (congestion - s.mn) / (CASE WHEN s.mx - s.mn = 0 THEN 1.0 ELSE s.mx - s.mn END) < 0.33 THEN 'bajo'
            WHEN (congestion - s.mn) / (CASE WHEN s.mx - s.mn = 0 THEN 1.0 ELSE s.mx - s.mn END) < 0.66 THEN 'medio'
            ELSE 'alto' END AS clase,
       ingresos::DOUBLE / s.mi::DOUBLE AS barra
FROM m, s
""")
def court_ranking(spark, sf):
    """Rank by congestion (WIN-2), equal-width tercile class (WIN-7), share of max (WIN-8).

    The window has no partition key on purpose: its input is one row per court
    (a fixed territorial domain), so a single ordering task is bounded."""
    c = cases(spark, sf).groupBy("corte").agg(*flow_aggs())
    c = c.withColumn("congestion", M.congestion("pendientes", "ingresos", "resueltos"))
    c = WN.rank_desc(c, "congestion", "corte", out="ranking")
    c = WN.minmax_class(c, "congestion", out="clase", bounded=True)      # one row per court
    return WN.share_of_max(c, "ingresos", out="barra", bounded=True)


# ----------------------------------------------------------------- department_rollup
@register("department_rollup", sql=f"""
WITH {CASE_LINES_SQL},
cc AS (SELECT corte, n_regionkey, {FLOW_SQL} FROM cases GROUP BY corte, n_regionkey),
dd AS (SELECT corte, avg(dias) AS demora FROM case_lines WHERE dias >= 0 GROUP BY corte),
j AS (SELECT cc.*, dd.demora FROM cc JOIN dd ON cc.corte = dd.corte)
SELECT r.r_name AS departamento, COUNT(*) AS n_cortes,
       sum(ingresos)::BIGINT AS ingresos, sum(resueltos)::BIGINT AS resueltos, sum(pendientes)::BIGINT AS pendientes,
       avg(demora) AS demora_simple,
       sum(demora * ingresos) / sum(ingresos)::DOUBLE AS demora_ponderada,
       (sum(pendientes) + sum(ingresos))::DOUBLE / NULLIF(sum(resueltos), 0)::DOUBLE AS congestion
FROM j JOIN region r ON j.n_regionkey = r.r_regionkey
GROUP BY r.r_name
""")
def department_rollup(spark, sf):
    """Court -> department rollup: sums, plain and weighted mean delay (AGG-14, JN-2 inner)."""
    c = cases(spark, sf).groupBy("corte", "n_regionkey").agg(*flow_aggs())
    d = case_lines(spark, sf).where(F.col("dias") >= 0).groupBy("corte").agg(F.avg("dias").alias("demora"))
    j = c.join(d, "corte", "inner")
    r = dim(Tables(spark, sf).region("r_regionkey", "r_name"))
    j = j.join(r, j.n_regionkey == r.r_regionkey, "inner")
    out = j.groupBy(F.col("r_name").alias("departamento")).agg(
        F.count(F.lit(1)).alias("n_cortes"), *flow_sums(),
        F.avg("demora").alias("demora_simple"),
        A.weighted_mean("demora", "ingresos").alias("demora_ponderada"))
    return out.withColumn("congestion", M.congestion("pendientes", "ingresos", "resueltos"))


# ----------------------------------------------------------------- cube_court_type_year
@register("cube_court_type_year", sql=f"""
WITH {CASES_SQL}
SELECT corte, tipo, anio, {FLOW_SQL}, CAST(GROUPING(corte, tipo, anio) AS INTEGER) AS nivel
FROM cases GROUP BY CUBE (corte, tipo, anio)
""")
def cube_court_type_year(spark, sf):
    """Cube court x process type x year (AGG-22).

    Pre-aggregated at the finest grain first (partial aggregation map-side),
    so the 8-way Expand of the cube runs over (court, type, year) rows, not
    over raw cases."""
    fine = cases(spark, sf).groupBy("corte", "tipo", "anio").agg(*flow_aggs())
    return fine.cube("corte", "tipo", "anio").agg(
        *flow_sums(), F.grouping_id("corte", "tipo", "anio").cast("int").alias("nivel"))


# ----------------------------------------------------------------- breakdown_sets
@register("breakdown_sets", sql=f"""
WITH {CASES_SQL},
last AS (SELECT * FROM cases WHERE anio = (SELECT max(anio) FROM cases)),
g AS (SELECT corte, especialidad, estado, tipo, COUNT(*) AS n,
             GROUPING(corte, especialidad, estado, tipo) AS gid
      FROM last GROUP BY GROUPING SETS ((corte), (especialidad), (estado), (tipo)))
SELECT CASE gid WHEN 7 THEN 'corte' WHEN 11 THEN 'especialidad' WHEN 13 THEN 'estado' ELSE 'tipo' END AS dimension,
       CASE gid WHEN 7 THEN corte WHEN 11 THEN especialidad WHEN 13 THEN estado ELSE tipo END AS valor,
       n
FROM g
""")
def breakdown_sets(spark, sf):
    """Latest-year snapshot broken down by four dimensions in one pass (FLT-7, AGG-10)."""
    c = C.latest_only(cases(spark, sf), "anio")
    dims = ["corte", "especialidad", "estado", "tipo"]
    fine = c.groupBy(*dims).agg(F.count(F.lit(1)).alias("n"))   # pre-aggregate, then Expand
    return A.breakdown(fine, dims, [F.sum("n").cast("bigint").alias("n")])


# ----------------------------------------------------------------- snapshot_last_month
@register("snapshot_last_month", sql=f"""
WITH {CASES_SQL},
m AS (SELECT anio, mes, corte, COUNT(*) FILTER (WHERE estado IN ('O', 'P')) AS stock FROM cases GROUP BY anio, mes, corte),
x AS (SELECT anio, max(mes) AS mes FROM m GROUP BY anio)
SELECT m.anio, m.mes, m.corte, m.stock FROM m JOIN x ON m.anio = x.anio AND m.mes = x.mes
""")
def snapshot_last_month(spark, sf):
    """Stock measure kept only for the last reported month of each year (FLT-8, WIN-1):
    summing months would double count a headcount."""
    m = cases(spark, sf).groupBy("anio", "mes", "corte").agg(
        F.count_if(F.col("estado").isin("O", "P")).alias("stock"))
    return C.keep_latest_within(m, "anio", "mes")


# ----------------------------------------------------------------- pending_age
@register("pending_age", sql=f"""
WITH {CASES_SQL},
p AS (SELECT corte, CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '{AS_OF}') AS INTEGER) AS edad
      FROM cases WHERE estado IN ('O', 'P'))
SELECT corte, COUNT(*) AS n_pendientes, avg(edad) AS edad_media,
       quantile_cont(edad, 0.5) AS edad_mediana, quantile_cont(edad, 0.9) AS edad_p90,
       COUNT(*) FILTER (WHERE edad > 1000) AS n_critico,
       COUNT(*) FILTER (WHERE edad > 500 AND edad <= 1000) AS n_riesgo,
       COUNT(*) FILTER (WHERE edad <= 500) AS n_normal
FROM p GROUP BY corte
""")
def pending_age(spark, sf):
    """Age of pending cases at a fixed as-of date (IND-15) with alert levels (PRJ-18)."""
    p = cases(spark, sf).where(F.col("estado").isin("O", "P")).withColumn("edad", age_days("o_orderdate", AS_OF))
    p = p.withColumn("nivel", alert_level("edad"))
    hist = p.groupBy("corte", "edad", "nivel").agg(F.count(F.lit(1)).alias("_w"))
    return hist.groupBy("corte").agg(
        F.sum("_w").cast("bigint").alias("n_pendientes"),
        (F.sum(F.col("edad") * F.col("_w")) / F.sum("_w")).alias("edad_media"),
        F.percentile("edad", F.lit(0.5), F.col("_w")).cast("double").alias("edad_mediana"),
        F.percentile("edad", F.lit(0.9), F.col("_w")).cast("double").alias("edad_p90"),
        F.sum(F.when(F.col("nivel") == "Critico", F.col("_w")).otherwise(0)).cast("bigint").alias("n_critico"),
        F.sum(F.when(F.col("nivel") == "Riesgo", F.col("_w")).otherwise(0)).cast("bigint").alias("n_riesgo"),
        F.sum(F.when(F.col("nivel") == "Normal", F.col("_w")).otherwise(0)).cast("bigint").alias("n_normal"))


# ----------------------------------------------------------------- conservation
@register("conservation", sql=f"""
WITH {CASES_SQL},
t AS (SELECT 'corte' AS rollup, sum(n)::BIGINT AS total FROM (SELECT corte, COUNT(*) n FROM cases GROUP BY corte)
      UNION ALL SELECT 'especialidad', sum(n)::BIGINT FROM (SELECT especialidad, COUNT(*) n FROM cases GROUP BY especialidad)
      UNION ALL SELECT 'anio', sum(n)::BIGINT FROM (SELECT anio, COUNT(*) n FROM cases GROUP BY anio)
      UNION ALL SELECT 'nacional', COUNT(*)::BIGINT FROM cases)
SELECT rollup, total, total = (SELECT COUNT(*) FROM cases) AS cuadra FROM t
""")
def conservation(spark, sf):
    """Rollups of one measure over different dimensions sum to the national total (AUD-3)."""
    c = cases(spark, sf)
    return AU.conservation_by(c.withColumn("uno", F.lit(1)), ["corte", "especialidad", "anio"], "uno")


# ----------------------------------------------------------------- indicator_panel
def _judges_per_court(spark, sf):
    t = Tables(spark, sf)
    n = dim(t.nation("n_nationkey", "n_name"))
    return (t.supplier("s_nationkey").join(n, F.col("s_nationkey") == n.n_nationkey)
            .groupBy(F.col("n_name").alias("corte")).agg(F.count(F.lit(1)).alias("jueces")))


_JUDGES_SQL = """j AS (SELECT n.n_name AS corte, COUNT(*) AS jueces FROM supplier s
                       JOIN nation n ON s.s_nationkey = n.n_nationkey GROUP BY n.n_name)"""


@register("indicator_panel", sql=f"""
WITH {CASES_SQL}, {_JUDGES_SQL},
f AS (SELECT corte, anio, {FLOW_SQL}, COUNT(*) FILTER (WHERE estado = 'P') AS provisionales FROM cases GROUP BY corte, anio)
SELECT f.corte, f.anio, ingresos, resueltos, pendientes, j.jueces,
       pendientes + ingresos AS carga,
       100.0 * pendientes::DOUBLE / NULLIF(pendientes + ingresos, 0)::DOUBLE AS tasa_pendiente,
       365.0 * pendientes::DOUBLE / NULLIF(resueltos, 0)::DOUBLE AS tiempo_disposicion,
       resueltos::DOUBLE / NULLIF(j.jueces, 0)::DOUBLE AS productividad,
       ingresos::DOUBLE / NULLIF(j.jueces, 0)::DOUBLE AS carga_por_juez,
       resueltos::DOUBLE / NULLIF(ingresos, 0)::DOUBLE AS proporcion_resuelta,
       provisionales::DOUBLE / NULLIF(pendientes, 0)::DOUBLE AS proporcion_provisional
FROM f JOIN j ON f.corte = j.corte
""")
def indicator_panel(spark, sf):
    """Indicator panel per court and year (IND-4, 7, 8, 9, 10, 13, 18)."""
    f = cases(spark, sf).groupBy("corte", "anio").agg(
        *flow_aggs(), F.count_if(F.col("estado") == "P").alias("provisionales"))
    x = f.join(_judges_per_court(spark, sf), "corte", "inner")
    x = x.withColumn("carga", M.caseload("pendientes", "ingresos"))
    return x.select(
        "corte", "anio", "ingresos", "resueltos", "pendientes", "jueces", "carga",
        M.pending_rate_pct("pendientes", "carga").alias("tasa_pendiente"),
        M.disposition_time("pendientes", "resueltos").alias("tiempo_disposicion"),
        M.productivity("resueltos", "jueces").alias("productividad"),
        M.load_per_judge("ingresos", "jueces").alias("carga_por_juez"),
        M.share("resueltos", "ingresos").alias("proporcion_resuelta"),
        M.share("provisionales", "pendientes").alias("proporcion_provisional"))


# ----------------------------------------------------------------- case_judge_star
@register("case_judge_star", sql="""
SELECT rc.r_name AS depto_caso, rj.r_name AS depto_juez, COUNT(*) AS n_lineas,
       CAST(sum(CAST(l.l_extendedprice AS DECIMAL(8, 2))) AS DOUBLE) AS monto
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation nc ON c.c_nationkey = nc.n_nationkey JOIN region rc ON nc.n_regionkey = rc.r_regionkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation nj ON s.s_nationkey = nj.n_nationkey JOIN region rj ON nj.n_regionkey = rj.r_regionkey
GROUP BY 1, 2
""")
def case_judge_star(spark, sf):
    """Star join of case lines to the case's department and to the judge's
    department through two aliased uses of the territory dimension (JN-8)."""
    t = Tables(spark, sf)
    n = t.nation("n_nationkey", "n_regionkey")
    r = t.region("r_regionkey", "r_name")
    terr = dim(n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name"))
    tc = terr.select(F.col("n_nationkey").alias("nk_c"), F.col("r_name").alias("depto_caso"))
    tj = terr.select(F.col("n_nationkey").alias("nk_j"), F.col("r_name").alias("depto_juez"))
    li = t.lineitem("l_orderkey", "l_suppkey", "l_extendedprice")
    o = t.orders("o_orderkey", "o_custkey")
    c = t.customer("c_custkey", "c_nationkey")
    s = t.supplier("s_suppkey", "s_nationkey")
    x = (li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)
         .join(tc, F.col("c_nationkey") == F.col("nk_c")).join(s, li.l_suppkey == s.s_suppkey)
         .join(tj, F.col("s_nationkey") == F.col("nk_j")))
    # money is summed as exact cents (decimal): the total does not depend on summation order
    return x.groupBy("depto_caso", "depto_juez").agg(
        F.count(F.lit(1)).alias("n_lineas"),
        F.sum(F.col("l_extendedprice").cast("decimal(8,2)")).cast("double").alias("monto"))


# ----------------------------------------------------------------- department_share / year_overlay
_DEPT_SQL = f"""{CASES_SQL},
dep AS (SELECT r.r_name AS departamento, cases.anio FROM cases JOIN region r ON cases.n_regionkey = r.r_regionkey)"""


def _dept_cases(spark, sf):
    r = dim(Tables(spark, sf).region("r_regionkey", "r_name"))
    c = cases(spark, sf)
    return c.join(r, c.n_regionkey == r.r_regionkey).select(F.col("r_name").alias("departamento"), "anio")


@register("department_share", sql=f"""
WITH {_DEPT_SQL},
d AS (SELECT departamento, COUNT(*) AS n FROM dep GROUP BY departamento)
SELECT departamento, n, 100.0 * n::DOUBLE / (SELECT sum(n) FROM d)::DOUBLE AS porcentaje FROM d
""")
def department_share(spark, sf):
    """Share of the national total per department (JN-12); the total is a scalar subquery."""
    d = _dept_cases(spark, sf).groupBy("departamento").agg(F.count(F.lit(1)).alias("n"))
    total = d.select(F.sum("n")).scalar()
    return d.withColumn("porcentaje", F.col("n").cast("double") * 100.0 / total.cast("double"))


OVERLAY_YEAR = 1998
OVERLAY_SILENT = "ASIA"        # a department that did not report that year


@register("year_overlay", sql=f"""
WITH {_DEPT_SQL},
y AS (SELECT departamento, COUNT(*) AS n FROM dep WHERE anio = {OVERLAY_YEAR} AND departamento <> '{OVERLAY_SILENT}' GROUP BY departamento),
a AS (SELECT departamento, COUNT(*) AS n FROM dep GROUP BY departamento)
SELECT r.r_name AS departamento, COALESCE(y.n, a.n) AS valor,
       CASE WHEN y.n IS NOT NULL THEN 'anio' WHEN a.n IS NOT NULL THEN 'todos' END AS base
FROM region r LEFT JOIN y ON r.r_name = y.departamento LEFT JOIN a ON r.r_name = a.departamento
""")
def year_overlay(spark, sf):
    """Map overlay: each department's value for the selected year, falling back
    to its all-years total when the year is missing (JN-13)."""
    d = _dept_cases(spark, sf)
    y = d.where((F.col("anio") == OVERLAY_YEAR) & (F.col("departamento") != OVERLAY_SILENT)).groupBy("departamento").agg(F.count(F.lit(1)).alias("n_y"))
    a = d.groupBy("departamento").agg(F.count(F.lit(1)).alias("n_a"))
    r = dim(Tables(spark, sf).region("r_name")).select(F.col("r_name").alias("departamento"))
    x = r.join(y, "departamento", "left").join(a, "departamento", "left")
    return x.select("departamento", F.coalesce("n_y", "n_a").alias("valor"),
                    F.when(F.col("n_y").isNotNull(), "anio").when(F.col("n_a").isNotNull(), "todos").alias("base"))
