"""The dataset jobs (JOB-1..8, 10..12, 15) over the driver tables.

Every query projects driver tables to a job's own column names, as text with
blanks, junk, negative values and years out of range, and returns one output of
the job in :mod:`judicata.jobs`.  The projections are written once, in SQL that
both engines read; the oracles state the rules of the job on their own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from judicata import jobs as J
from judicata.functions.dates import MONTHS
from judicata.functions.text import MISSING_KEY
from judicata.operators.match import CRIME_TITLES
from judicata.plans import register
from judicata.plans.common import dim
from judicata.plans.text_q import _letters_sql
from judicata.tables import Tables

DAY = "CAST(day(o_orderdate) AS STRING)"
MONTH = "CAST(month(o_orderdate) AS STRING)"
SHIFTED = "(year(o_orderdate) + CASE WHEN o_orderkey % 53 = 0 THEN 17 ELSE 20 END)"
YEAR = f"CASE WHEN o_orderkey % 97 = 0 THEN 'x' WHEN o_orderkey % 89 = 0 THEN NULL ELSE CAST({SHIFTED} AS STRING) END"
DMY = f"CASE WHEN o_orderkey % 7 = 0 THEN ' ' ELSE concat({DAY}, '/', {MONTH}, '/', CAST({SHIFTED} AS STRING)) END"
PLACE = "CASE WHEN o_orderkey % 43 = 0 THEN ' ' ELSE concat(' ', n_name, ' ') END"


def amount(expr: str, junk: int = 31, negative: int = 101) -> str:
    """Text of a number, with junk and negative values now and then."""
    return (f"CASE WHEN o_orderkey % {junk} = 0 THEN 'n/d' WHEN o_orderkey % {negative} = 0 THEN '-1' "
            f"ELSE concat(' ', CAST({expr} AS STRING)) END")


def _items(cols: dict[str, str], quote: str) -> list[str]:
    return [f"{e} AS {quote}{k}{quote}" for k, e in cols.items()]


def orders_as(spark, sf, cols: dict[str, str]) -> DataFrame:
    t = Tables(spark, sf)
    o = t.orders("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    c = t.customer("c_custkey", "c_nationkey", "c_mktsegment")
    n = dim(t.nation("n_nationkey", "n_name", "n_regionkey"))
    x = o.join(c, o.o_custkey == c.c_custkey, "left").join(n, c.c_nationkey == n.n_nationkey, "left")
    return x.selectExpr(*_items(cols, "`"))


def orders_sql(cols: dict[str, str], name: str = "raw") -> str:
    return f"""{name} AS (SELECT {", ".join(_items(cols, '"'))} FROM orders
  LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey)"""


def num(c: str) -> str:
    return f"TRY_CAST(trim({c}) AS DOUBLE)"


def num0(c: str) -> str:
    return f"COALESCE({num(c)}, 0)"


def int_year(c: str) -> str:
    return f"CAST(trunc({num(c)}) AS INTEGER)"


def key(c: str) -> str:
    return f"CASE WHEN COALESCE(trim({c}), '') = '' THEN '{MISSING_KEY}' ELSE trim({c}) END"


def day_first(c: str) -> str:
    return f"CAST(try_strptime(trim({c}), '%d/%m/%Y') AS DATE)"


def rules(*pairs: tuple[str, str]) -> str:
    """(ord, rule, n) rows of counts over ``x``."""
    return " UNION ALL ".join(f"SELECT {i} AS ord, '{r}' AS rule, COUNT(*) FILTER ({w}) AS n FROM x" for i, (r, w) in enumerate(pairs))


CLEARANCE = "100.0::DOUBLE * {0} / NULLIF({1}, 0)::DOUBLE AS clearance"

# ------------------------------------------------------------------ JOB-1
WORKLOAD = {
    "ANIO": YEAR,
    "MES": "CASE " + " ".join(f"WHEN month(o_orderdate) = {i} THEN ' {m.title()}'" for i, m in enumerate(MONTHS, 1)) + " END",
    "DISTRITO_JUDICIAL": PLACE, "ESPEC_EXP": "c_mktsegment",
    "INGRESO_SIN": amount("1 + o_orderkey % 7"), "INGRESO_CON": amount("o_orderkey % 3", 29, 103),
    "RESUELTO": amount("CASE WHEN o_orderstatus = 'F' THEN 5 ELSE 0 END", 37, 107),
    "PENDIENTE": "CASE WHEN month(o_orderdate) = 1 THEN CAST(o_orderkey % 11 AS STRING) ELSE '0' END"}
WORKLOAD_SQL = f"""WITH {orders_sql(WORKLOAD)},
x AS (SELECT {int_year('raw."ANIO"')} AS anio,
  COALESCE(list_position({MONTHS}, upper(trim("MES"))), 0) AS mes_n, {key('raw."DISTRITO_JUDICIAL"')} AS distrito_judicial,
  {key('"ESPEC_EXP"')} AS especialidad, {num0('"INGRESO_SIN"')} + {num0('"INGRESO_CON"')} AS ingresos,
  {num0('"RESUELTO"')} AS resueltos, {num0('"PENDIENTE"')} AS pendientes FROM raw),
y AS (SELECT *, ingresos < 0 OR resueltos < 0 OR pendientes < 0 AS neg, anio IS NULL OR anio NOT BETWEEN 2015 AND 2026 AS out FROM x),
v AS (SELECT * FROM y WHERE NOT neg AND NOT out)"""
WORKLOAD_SUMS = ", ".join(f"CAST(SUM({c}) AS BIGINT) AS {c}" for c in ("ingresos", "resueltos", "pendientes"))
CONGESTION = "(pendientes + ingresos)::DOUBLE / NULLIF(resueltos, 0)::DOUBLE AS congestion"


def _workload(spark, sf):
    return J.court_workload(orders_as(spark, sf, WORKLOAD))


@register("job_workload_national", sql=f"""{WORKLOAD_SQL}, g AS (SELECT {WORKLOAD_SUMS} FROM v)
SELECT *, {CLEARANCE.format('resueltos', 'ingresos')}, {CONGESTION} FROM g""")
def job_workload_national(spark, sf):
    """Court workload, national sums and indicators (JOB-1)."""
    return _workload(spark, sf)["nacional"]


@register("job_workload_district", sql=f"""{WORKLOAD_SQL}, g AS (SELECT distrito_judicial, {WORKLOAD_SUMS} FROM v GROUP BY 1)
SELECT *, {CLEARANCE.format('resueltos', 'ingresos')}, {CONGESTION} FROM g""")
def job_workload_district(spark, sf):
    """Court workload by district (JOB-1)."""
    return _workload(spark, sf)["por_distrito"]


@register("job_workload_speciality", sql=f"""{WORKLOAD_SQL}, g AS (SELECT especialidad, {WORKLOAD_SUMS} FROM v GROUP BY 1)
SELECT *, {CLEARANCE.format('resueltos', 'ingresos')} FROM g""")
def job_workload_speciality(spark, sf):
    """Court workload by speciality (JOB-1)."""
    return _workload(spark, sf)["por_especialidad"]


@register("job_workload_audit", sql=WORKLOAD_SQL.replace("x AS (", "x0 AS (").replace("FROM x)", "FROM x0)").replace("y AS (", "x AS (")
          .replace("FROM y ", "FROM x ") + "\n" + rules(("leidas", "true"), ("negativos", "neg"), ("anio_invalido", "out"),
                                                        ("descartadas", "neg OR out"), ("validas", "NOT neg AND NOT out")))
def job_workload_audit(spark, sf):
    """Rows of the court workload read, dropped by rule and kept (JOB-1, AUD-1)."""
    return _workload(spark, sf)["audit"]


@register("job_workload_meta", sql=f"""{WORKLOAD_SQL}
SELECT 'Poder Judicial (datos abiertos)' AS fuente, 'Nacional, ' || MIN(anio) || '-' || MAX(anio) AS cobertura, 'agregado' AS granularidad,
  MAX(anio) || '-' || lpad(CAST((SELECT MAX(mes_n) FROM v WHERE anio = (SELECT MAX(anio) FROM v)) AS VARCHAR), 2, '0') AS fecha_corte FROM v""")
def job_workload_meta(spark, sf):
    """Source, coverage and cut-off month of the court workload (JOB-1, PRJ-13)."""
    return _workload(spark, sf)["meta"]


# ------------------------------------------------------------------ JOB-2
HEADCOUNT = {"anio": YEAR, "mes": f"CASE WHEN o_orderkey % 83 = 0 THEN NULL ELSE {MONTH} END", "distrito_fiscal": PLACE,
             "cargo": "c_mktsegment", "condicion": "o_orderpriority", "total": amount("1 + o_orderkey % 5"), "fecha_corte": DMY}
HEADCOUNT_SQL = f"""WITH {orders_sql(HEADCOUNT)},
x AS (SELECT {int_year('raw.anio')} AS anio, CAST({num('raw.mes')} AS INTEGER) AS mes, {key('raw.distrito_fiscal')} AS distrito_fiscal,
  {key('raw.cargo')} AS cargo, {key('raw.condicion')} AS condicion, {num('total')} AS n, {day_first('raw.fecha_corte')} AS fc FROM raw),
v AS (SELECT * FROM x WHERE anio BETWEEN 2015 AND 2026 AND NOT COALESCE(n < 0, false)),
snap AS (SELECT * FROM v WHERE (anio, mes) IN (SELECT (anio, MAX(mes)) FROM v GROUP BY anio)),
latest AS (SELECT * FROM snap WHERE anio = (SELECT MAX(anio) FROM snap))"""


def _headcount(spark, sf):
    return J.prosecutor_headcount(orders_as(spark, sf, HEADCOUNT))


@register("job_headcount_year", sql=f"{HEADCOUNT_SQL} SELECT anio, CAST(SUM(n) AS BIGINT) AS total FROM snap GROUP BY anio")
def job_headcount_year(spark, sf):
    """Headcount of the last month of each year (JOB-2, FLT-8)."""
    return _headcount(spark, sf)["por_anio"]


@register("job_headcount_breakdown", sql=HEADCOUNT_SQL + " " + " UNION ALL ".join(
    f"SELECT '{d}' AS dimension, {d} AS valor, CAST(SUM(n) AS BIGINT) AS total FROM latest GROUP BY {d}"
    for d in ("distrito_fiscal", "cargo", "condicion")))
def job_headcount_breakdown(spark, sf):
    """Latest headcount by several dimensions (JOB-2, AGG-10)."""
    return _headcount(spark, sf)["desglose"]


@register("job_headcount_meta", sql=f"""{HEADCOUNT_SQL}
SELECT 'Ministerio Publico (datos abiertos)' AS fuente, 'Nacional, ' || MIN(anio) || '-' || MAX(anio) AS cobertura, 'agregado' AS granularidad,
  (SELECT strftime(MAX(fc), '%Y-%m-%d') FROM latest) AS fecha_corte FROM v""")
def job_headcount_meta(spark, sf):
    """Coverage and cut-off of the latest headcount (JOB-2, PRJ-6)."""
    return _headcount(spark, sf)["meta"]


# ------------------------------------------------------------------ JOB-3 / JOB-7
FLOW = {"anio": YEAR, "materia": "c_mktsegment", "distrito_fiscal": PLACE, "ingresado": amount("1 + o_orderkey % 9"),
        "atendido": amount("o_orderkey % 5", 41, 109), "fecha_descarga": "'sin fecha'", "fecha_publicacion": DMY}
FLOW_SQL = f"""WITH {orders_sql(FLOW)},
x AS (SELECT {int_year('raw.anio')} AS anio, {key('raw.materia')} AS materia, {key('raw.distrito_fiscal')} AS distrito_fiscal,
  {num0('raw.ingresado')} AS ingresado, {num0('raw.atendido')} AS atendido, {day_first('fecha_publicacion')} AS fc FROM raw),
v AS (SELECT * FROM x WHERE anio BETWEEN 2015 AND 2026 AND ingresado >= 0 AND atendido >= 0)"""
FLOW_SUMS = "CAST(SUM(ingresado) AS BIGINT) AS ingresado, CAST(SUM(atendido) AS BIGINT) AS atendido"


def _flow(spark, sf):
    return J.flow_by_year(orders_as(spark, sf, FLOW))


@register("job_flow_year", sql=f"""{FLOW_SQL}, g AS (SELECT anio, {FLOW_SUMS} FROM v GROUP BY anio)
SELECT *, {CLEARANCE.format('atendido', 'ingresado')} FROM g""")
def job_flow_year(spark, sf):
    """Prosecution flow per year (JOB-3, JOB-7)."""
    return _flow(spark, sf)["por_anio"]


@register("job_flow_subject", sql=f"""{FLOW_SQL},
g AS (SELECT materia, {FLOW_SUMS} FROM v WHERE anio = (SELECT MAX(anio) FROM v) GROUP BY materia)
SELECT *, {CLEARANCE.format('atendido', 'ingresado')} FROM g""")
def job_flow_subject(spark, sf):
    """Prosecution flow of the latest year by subject (JOB-3)."""
    return _flow(spark, sf)["reciente_por_materia"]


@register("job_flow_top_district", sql=f"""{FLOW_SQL}
SELECT distrito_fiscal, SUM(ingresado) AS ingresado_n FROM v GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""")
def job_flow_top_district(spark, sf):
    """The 15 districts with the largest inflow (JOB-3, TOP-1)."""
    return _flow(spark, sf)["top_distrito"].select("distrito_fiscal", "ingresado_n")


@register("job_flow_meta", sql=f"""{FLOW_SQL}
SELECT 'Ministerio Publico (datos abiertos)' AS fuente, 'Nacional, ' || MIN(anio) || '-' || MAX(anio) AS cobertura, 'agregado' AS granularidad,
  strftime(MAX(fc), '%Y-%m-%d') AS fecha_corte FROM v""")
def job_flow_meta(spark, sf):
    """Cut-off from the first date column in which a value parses (JOB-3, PRJ-5)."""
    return _flow(spark, sf)["meta"]


# ------------------------------------------------------------------ JOB-4 / JOB-8
REPORTS = {"anio_denuncia": YEAR, "cantidad": amount("1 + o_orderkey % 4"), "generico": "concat(c_mktsegment, ' ', o_orderpriority)",
           "dpto_pjfs": PLACE}
REPORTS_SQL = f"""WITH {orders_sql(REPORTS)},
x AS (SELECT {int_year('anio_denuncia')} AS anio, {num0('raw.cantidad')} AS n, {key('raw.generico')} AS generico,
  {key('dpto_pjfs')} AS departamento FROM raw),
v AS (SELECT * FROM x WHERE anio BETWEEN 2015 AND 2026 AND n >= 0)"""


def _reports(spark, sf):
    return J.counted_reports(orders_as(spark, sf, REPORTS))


@register("job_reports_year", sql=f"{REPORTS_SQL} SELECT anio, CAST(SUM(n) AS BIGINT) AS cantidad FROM v GROUP BY anio")
def job_reports_year(spark, sf):
    """Reported crimes per year (JOB-4, JOB-8)."""
    return _reports(spark, sf)["por_anio"]


@register("job_reports_department", sql=f"{REPORTS_SQL} SELECT departamento, CAST(SUM(n) AS BIGINT) AS cantidad FROM v GROUP BY 1")
def job_reports_department(spark, sf):
    """Reported crimes per department, blanks in a bucket of their own (JOB-4)."""
    return _reports(spark, sf)["por_departamento"]


@register("job_reports_top_type", sql=f"{REPORTS_SQL} SELECT generico, SUM(n) AS cantidad_n FROM v GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def job_reports_top_type(spark, sf):
    """The 20 most reported types (JOB-4, TOP-1)."""
    return _reports(spark, sf)["top_tipos"].select("generico", "cantidad_n")


# ------------------------------------------------------------------ JOB-5
PARTY = {"EXPEDIENTE": "concat('E', CAST(l_orderkey AS STRING))", "INSTANCIA": "concat(' ', l_linestatus)",
         "FECHA_SENTENCIA": "CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS STRING)",
         "DIAS": "CASE WHEN l_partkey % 61 = 0 THEN 'x' WHEN l_orderkey % 3 = 0 THEN concat(CAST((l_orderkey * 7 + l_partkey) % 900 - 20 AS STRING), '.5') "
                 "ELSE CAST((l_orderkey * 7 + l_partkey) % 900 - 20 AS STRING) END",
         "DNI": "CAST(l_suppkey AS STRING)"}


def _delay(spark, sf):
    rows = Tables(spark, sf).lineitem("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_linestatus", "l_returnflag", "l_shipdate")
    # the first line of an order has two parties
    rows = rows.withColumn("_party", F.explode(F.when(F.col("l_linenumber") == 1, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    part = lambda cond: (rows.where(cond).selectExpr(*_items(PARTY, "`")), "INSTANCIA")
    return J.case_delay({"Civil": part("l_returnflag = 'A'"), "Penal": part("l_returnflag <> 'A'")})


DELAY_SQL = f"""WITH raw AS (SELECT {", ".join(_items(PARTY, '"'))}, CASE WHEN l_returnflag = 'A' THEN 'Civil' ELSE 'Penal' END AS proceso,
  CASE WHEN l_linenumber = 1 THEN 2 ELSE 1 END AS partes FROM lineitem WHERE l_returnflag IS NOT NULL),
ev AS (SELECT proceso, {num('"DIAS"')} AS dias, SUM(partes) AS partes
  FROM raw GROUP BY proceso, "EXPEDIENTE", trim("INSTANCIA"), "FECHA_SENTENCIA", "DIAS"),
v AS (SELECT * FROM ev WHERE dias >= 0)"""


@register("job_delay_process", sql=f"""{DELAY_SQL}
SELECT proceso, COUNT(*) AS n, AVG(dias) AS mean, CAST(trunc(MIN(dias)) AS BIGINT) AS min, CAST(trunc(MAX(dias)) AS BIGINT) AS max,
  quantile_cont(dias, 0.5) AS median, quantile_cont(dias, 0.9) AS p90 FROM v GROUP BY proceso""")
def job_delay_process(spark, sf):
    """Case delay by process over one row per ruling, fractions of days kept (JOB-5, IND-14)."""
    return _delay(spark, sf)["por_proceso"]


@register("job_delay_histogram", sql=f"""{DELAY_SQL},
b(bucket, desde, hasta) AS (VALUES (0, 0, 30), (1, 30, 90), (2, 90, 180), (3, 180, 365), (4, 365, 730), (5, 730, NULL))
SELECT proceso, bucket, CASE WHEN hasta IS NULL THEN desde || '+' ELSE desde || '-' || hasta END AS rango, desde, hasta,
  COUNT(*) FILTER (dias >= desde AND (hasta IS NULL OR dias < hasta)) AS n FROM v, b GROUP BY proceso, bucket, desde, hasta""")
def job_delay_histogram(spark, sf):
    """Case delay in fixed buckets by process (JOB-5, AGG-9)."""
    return _delay(spark, sf)["histograma"]


@register("job_delay_audit", sql=f"""{DELAY_SQL}
SELECT proceso, COUNT(*) AS eventos, COUNT(*) FILTER (dias >= 0) AS validos,
  COUNT(*) FILTER (NOT COALESCE(dias >= 0, false)) AS descartados, CAST(SUM(partes) AS BIGINT) AS filas_brutas FROM ev GROUP BY proceso""")
def job_delay_audit(spark, sf):
    """Rulings, parties and dropped delays by process (JOB-5, SET-4)."""
    return _delay(spark, sf)["audit"]


# ------------------------------------------------------------------ JOB-6
def compact(year: str) -> str:
    return f"CAST(({year}) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS STRING)"


KIND = "CASE WHEN o_orderkey < 20 THEN 'RARO' ELSE concat(' ', o_orderpriority) END"
FILED = {"FEC_INGRESO": "CASE WHEN o_orderkey % 59 = 0 THEN 'x' ELSE " + compact(
    "year(o_orderdate) - CASE WHEN o_orderkey % 71 = 0 THEN 10 ELSE 0 END") + " END", "CDES_TIPOPROCESO": KIND}
PUBLISHED = {"FEC_INGRESO": FILED["FEC_INGRESO"], "CDES_TIPOPROCESO": KIND, "PUB_PAGWEB": compact(
    "year(o_orderdate) + CASE WHEN o_orderkey % 10 = 0 THEN -1 ELSE o_orderkey % 3 END")}
CONSTITUTIONAL_SQL = f"""WITH {orders_sql(FILED, 'ing')}, {orders_sql(PUBLISHED, 'pub')},
i AS (SELECT CAST(try_strptime("FEC_INGRESO", '%Y%m%d') AS DATE) AS fec, trim("CDES_TIPOPROCESO") AS tipo FROM ing),
i2 AS (SELECT year(fec)::INTEGER AS anio, tipo FROM i WHERE year(fec) BETWEEN 1992 AND 2026),
p AS (SELECT CAST(try_strptime("FEC_INGRESO", '%Y%m%d') AS DATE) AS fec, CAST(try_strptime("PUB_PAGWEB", '%Y%m%d') AS DATE) AS fp,
  trim("CDES_TIPOPROCESO") AS tipo FROM pub),
d AS (SELECT year(fp)::INTEGER AS anio, tipo, CAST(fp - fec AS INTEGER) AS dias FROM p WHERE year(fp) BETWEEN 1992 AND 2026)"""


def _constitutional(spark, sf):
    return J.constitutional_court(orders_as(spark, sf, FILED), orders_as(spark, sf, PUBLISHED))


@register("job_constitutional_year", sql=f"""{CONSTITUTIONAL_SQL}
SELECT anio, COALESCE(a, 0) AS ingresados, COALESCE(b, 0) AS publicados
FROM (SELECT anio, COUNT(*) AS a FROM i2 GROUP BY 1) FULL JOIN (SELECT anio, COUNT(*) AS b FROM d GROUP BY 1) USING (anio)""")
def job_constitutional_year(spark, sf):
    """Cases filed and published per year (JOB-6, JN-5, FLT-3)."""
    return _constitutional(spark, sf)["por_anio"]


@register("job_constitutional_type", sql=f"{CONSTITUTIONAL_SQL} SELECT tipo, COUNT(*) AS n FROM i2 GROUP BY tipo")
def job_constitutional_type(spark, sf):
    """Cases filed per type (JOB-6)."""
    return _constitutional(spark, sf)["por_tipo"]


@register("job_constitutional_delay", sql=f"""{CONSTITUTIONAL_SQL}, v AS (SELECT * FROM d WHERE dias >= 0),
g AS (SELECT CASE WHEN grouping(tipo) = 1 THEN 'TOTAL' ELSE tipo END AS tipo, COUNT(*) AS n, AVG(dias) AS mean, MIN(dias) AS min, MAX(dias) AS max,
  quantile_cont(dias, 0.5) AS median, quantile_cont(dias, 0.9) AS p90, grouping(tipo)::TINYINT AS is_global FROM v GROUP BY ROLLUP (tipo))
SELECT * FROM g WHERE is_global = 1 OR n >= 30""")
def job_constitutional_delay(spark, sf):
    """Delay from filing to publication, types of 30 cases or more and all (JOB-6, AGG-8, FLT-11)."""
    return _constitutional(spark, sf)["demora"]


@register("job_constitutional_audit", sql=f"""{CONSTITUTIONAL_SQL}
SELECT COUNT(*) AS publicados, COUNT(*) FILTER (dias < 0) AS dias_negativos, COUNT(*) FILTER (dias IS NULL) AS sin_fechas FROM d""")
def job_constitutional_audit(spark, sf):
    """Published cases without dates or with negative delays (JOB-6, AUD-2)."""
    return _constitutional(spark, sf)["audit"]


# ------------------------------------------------------------------ JOB-10
THOUSANDS = "CASE WHEN o_orderkey % 19 = 0 THEN '1,2' ELSE '' END"
VIOLENCE = {"AÑO": YEAR, "DEPARTAMENTO": "CASE WHEN o_orderkey % 5 = 0 THEN 'Lima Metropolitana' WHEN o_orderkey % 5 = 1 THEN 'LIMA PROVINCIAS' "
            "WHEN o_orderkey % 5 = 2 THEN ' Áncash' ELSE n_name END",
            "N° DE CASOS ATENDIDOS TOTAL": f"concat({THOUSANDS}, CAST(10 + o_orderkey % 7 AS STRING))",
            **{f"VIOLENCIA {k}": f"CASE WHEN o_orderkey % {m * 11} = 0 THEN 'n/d' ELSE concat({THOUSANDS}, CAST(10 + o_orderkey % {m} AS STRING)) END"
               for k, m in (("PSICOLOGICA", 3), ("FISICA", 4), ("SEXUAL", 5), ("ECONOMICA O PATRIMONIAL", 6))}}


def commas(c: str) -> str:
    return f"""TRY_CAST(trim(replace("{c}", ',', '')) AS DOUBLE)"""


VIOLENCE_SQL = f"""WITH {orders_sql(VIOLENCE)},
v AS (SELECT *, {int_year('"AÑO"')} AS anio, COALESCE({commas('N° DE CASOS ATENDIDOS TOTAL')}, 0) AS n FROM raw
  WHERE {int_year('"AÑO"')} BETWEEN 2002 AND 2026)"""


def _violence(spark, sf):
    return J.violence_cases(orders_as(spark, sf, VIOLENCE), categories={"por_tipo": J.VIOLENCE_TYPES})


@register("job_violence_year", sql=f"{VIOLENCE_SQL} SELECT anio, CAST(SUM(n) AS BIGINT) AS cantidad FROM v GROUP BY anio")
def job_violence_year(spark, sf):
    """Attended cases per year, thousands separators removed (JOB-10, PRJ-2)."""
    return _violence(spark, sf)["por_anio"]


@register("job_violence_department", sql=f"""{VIOLENCE_SQL}
SELECT regexp_replace(upper(trim(strip_accents("DEPARTAMENTO"))), '^LIMA .*', 'LIMA') AS departamento, CAST(SUM(n) AS BIGINT) AS cantidad
FROM v GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25""")
def job_violence_department(spark, sf):
    """Attended cases per department, variants of one territory merged (JOB-10, PRJ-25)."""
    return _violence(spark, sf)["por_departamento"].select("departamento", "cantidad")


@register("job_violence_type", sql=VIOLENCE_SQL + " " + " UNION ALL ".join(
    f"SELECT '{label}' AS categoria, CAST(COALESCE(SUM({commas('VIOLENCIA ' + c)}), 0) AS BIGINT) AS cantidad FROM v"
    for label, c in (("Psicologica", "PSICOLOGICA"), ("Fisica", "FISICA"), ("Sexual", "SEXUAL"),
                     ("Economica o patrimonial", "ECONOMICA O PATRIMONIAL"))))
def job_violence_type(spark, sf):
    """Violence types as rows, their columns found by words and beginnings of words (JOB-10, PRJ-10, AGG-11)."""
    return _violence(spark, sf)["por_tipo"]


# ------------------------------------------------------------------ JOB-11
TITLE = f"split_part('{';'.join(CRIME_TITLES)}', ';', CAST(1 + p_partkey % {len(CRIME_TITLES)} AS INT))"
LINES = {"anio": "2016 + p_size % 3",
         "line": f"CASE WHEN p_partkey % 11 = 0 THEN p_name WHEN p_partkey % 13 = 0 THEN concat('z|DELITO ', upper(p_name)) "
                 f"ELSE concat('z|', replace({TITLE}, ' LA ', ' L|A '), '|', upper(p_type)) END"}
POLICE_SQL = f"""WITH raw AS (SELECT {", ".join(_items(LINES, '"'))}, p_partkey AS id FROM part),
t AS (SELECT id, anio, CASE WHEN regexp_matches(line, 'DELITOS?\\s') THEN
  replace(substring(regexp_extract(line, '(DELITOS?\\s[\\s\\S]*)', 1), 1, 70), '|', '') END AS rec FROM raw),
k AS (SELECT label, {_letters_sql("label")} AS key FROM (VALUES {", ".join(f"('{c}')" for c in CRIME_TITLES)}) w(label)),
x AS (SELECT t.id, any_value(t.anio) AS anio, any_value(t.rec) AS rec, arg_max(k.label, length(k.key)) AS tipo
  FROM t LEFT JOIN k ON starts_with({_letters_sql("t.rec")}, k.key) GROUP BY t.id)"""


def _police(spark, sf):
    return J.police_lines(Tables(spark, sf).part("p_partkey", "p_name", "p_type", "p_size").selectExpr(*_items(LINES, "`")))


@register("job_police_year", sql=f"""{POLICE_SQL},
g AS (SELECT anio, COUNT(*) AS lineas, COUNT(rec) AS con_generico, COUNT(*) FILTER (rec IS NOT NULL AND tipo IS NULL) AS sin_clasificar FROM x GROUP BY anio)
SELECT *, 1.0::DOUBLE - con_generico::DOUBLE / NULLIF(lineas, 0)::DOUBLE AS perdida FROM g""")
def job_police_year(spark, sf):
    """Lines, readable titles, unclassified ones and the loss per year (JOB-11, AGG-16)."""
    return _police(spark, sf)["por_anio"]


@register("job_police_type", sql=f"{POLICE_SQL} SELECT anio, tipo, COUNT(*) AS cantidad FROM x WHERE tipo IS NOT NULL GROUP BY anio, tipo")
def job_police_type(spark, sf):
    """Crimes per year and title, labels recovered across stray pipes (JOB-11, JN-7)."""
    return _police(spark, sf)["por_anio_tipo"]


# ------------------------------------------------------------------ JOB-12
TERRITORY = {"anio_denuncia": YEAR, "cantidad": amount("1 + o_orderkey % 4"),
             "dpto_pjfs": "CASE WHEN o_orderkey % 47 = 0 THEN '#N/D' ELSE concat(' ', replace(lower(n_name), 'a', 'á')) END"}
TERRITORY_SQL = f"""WITH {orders_sql(TERRITORY)},
off AS (SELECT n_name FROM nation WHERE n_regionkey < 4),
x AS (SELECT {int_year('anio_denuncia')} AS anio, {num0('raw.cantidad')} AS n, upper(trim(strip_accents(dpto_pjfs))) AS departamento FROM raw),
y AS (SELECT *, n < 0 OR anio IS NULL OR anio NOT BETWEEN 2019 AND 2026 AS bad,
  COALESCE(departamento IN (SELECT n_name FROM off), false) AS inside FROM x)"""


def _territory(spark, sf):
    official = Tables(spark, sf).nation("n_name", "n_regionkey").where("n_regionkey < 4").select("n_name")
    return J.crimes_by_department(orders_as(spark, sf, TERRITORY), official)


@register("job_territory_year", sql=f"""{TERRITORY_SQL}
SELECT anio, departamento, CAST(SUM(n) AS BIGINT) AS cantidad FROM y WHERE inside AND NOT bad GROUP BY anio, departamento""")
def job_territory_year(spark, sf):
    """Crimes by year and official department (JOB-12, FLT-6, JN-3)."""
    return _territory(spark, sf)["por_anio_departamento"]


@register("job_territory_dropped", sql=f"{TERRITORY_SQL} SELECT DISTINCT departamento FROM y WHERE NOT inside")
def job_territory_dropped(spark, sf):
    """Labels outside the official set (JOB-12, JN-4)."""
    return _territory(spark, sf)["descartados"]


@register("job_territory_audit", sql=TERRITORY_SQL.replace("x AS (", "x0 AS (").replace("FROM x)", "FROM x0)").replace("y AS (", "x AS (") + "\n" + rules(
    ("leidas", "true"), ("fila_invalida", "bad"), ("territorio_no_oficial", "NOT inside"), ("descartadas", "bad OR NOT inside"),
    ("validas", "NOT bad AND inside")))
def job_territory_audit(spark, sf):
    """Rows read, dropped by reason and kept (JOB-12, AUD-1)."""
    return _territory(spark, sf)["audit"]


# ------------------------------------------------------------------ JOB-15
COURTS_AGGS = {"ingresados": "COUNT(*)", "resueltos": "SUM(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)",
               "pendientes": "SUM(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END)", "jueces": "1 + MAX(o_orderkey) % 9",
               "demora_dias": "MIN(o_orderkey) % 400 + 30"}
COURTS = {"corte": "n_name", "region": "n_regionkey", "o_orderstatus": "o_orderstatus", "o_orderkey": "o_orderkey"}
COURTS_SQL = f"""WITH {orders_sql(COURTS)},
c AS (SELECT corte, CAST(region AS VARCHAR) AS departamento, {", ".join(_items(COURTS_AGGS, ''))} FROM raw GROUP BY corte, region)"""


def _courts(spark, sf):
    raw = orders_as(spark, sf, COURTS).withColumn("departamento", F.col("region").cast("string"))
    return J.court_rollups(raw.groupBy("corte", "departamento").agg(*[F.expr(e).alias(k) for k, e in COURTS_AGGS.items()]))


COURT_TOTALS = ", ".join(f"CAST(SUM({c}) AS BIGINT) AS {c}" for c in ("resueltos", "pendientes", "jueces"))
WEIGHTED = "SUM(demora_dias::DOUBLE * ingresados) / NULLIF(SUM(ingresados), 0)::DOUBLE AS demora_ponderada"


@register("job_court_national", sql=f"""{COURTS_SQL},
g AS (SELECT CAST(SUM(ingresados) AS BIGINT) AS expedientes_ingresados, {COURT_TOTALS}, {WEIGHTED} FROM c)
SELECT *, resueltos::DOUBLE / NULLIF(expedientes_ingresados, 0)::DOUBLE AS clearance,
  (pendientes + expedientes_ingresados)::DOUBLE / NULLIF(resueltos, 0)::DOUBLE AS congestion,
  pendientes::DOUBLE / NULLIF(pendientes + resueltos, 0)::DOUBLE AS mora FROM g""")
def job_court_national(spark, sf):
    """National indicators from the court table, delay weighted by inflow (JOB-15, AGG-13)."""
    return _courts(spark, sf)["nacional"]


@register("job_court_department", sql=f"""{COURTS_SQL}
SELECT departamento, CAST(SUM(ingresados) AS BIGINT) AS ingresados, {COURT_TOTALS}, AVG(demora_dias) AS demora_simple, {WEIGHTED}
FROM c GROUP BY departamento""")
def job_court_department(spark, sf):
    """Court table rolled up to departments, plain and weighted delay (JOB-15, AGG-14)."""
    return _courts(spark, sf)["departamentos"]
