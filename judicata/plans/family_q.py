"""One query per family of small operators, over driver tables projected to the
sources' own kind of values: classifiers and keys (PRJ-14..29, FLT-15/16), indicators
(IND-5, 11, 12, 17, 19, JN-14), audits (AUD-2, AUD-4), sources and quality (JOB-16, AGG-19),
orders of results (AGG-15, TOP-3, TOP-6), histories (WIN-6, JN-11), seasons (WIN-12),
crosswalk (JN-15), arrivals (STR-3), split of the delay model (ML-1, ML-2, ML-3, ML-5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from judicata import jobs as J
from judicata.functions import classify as K
from judicata.functions import metrics as M
from judicata.functions.dates import month_of_yyyymm
from judicata.functions.provenance import require_provenance, with_provenance
from judicata.functions.text import code_in_range, label, newest_first
from judicata.ml import delay_model as DM
from judicata.operators import audit as AU
from judicata.operators import match as MT
from judicata.operators import topk as T
from judicata.operators import windows as WN
from judicata.operators.identity import match_names
from judicata.plans import register
from judicata.plans.common import CASES_SQL, cases, dim
from judicata.session import shared_folder
from judicata.streaming.snapshots import apply_snapshot_batch, read_current, read_manifest
from judicata.tables import Tables

# Texts of the sources' kind, by key.  Written once, in SQL that both engines read.
_TEXTS = {
    "instancia": "CASE p_partkey % 11 WHEN 0 THEN 'Juzgado de Paz' WHEN 1 THEN '1a sala civil' WHEN 2 THEN 'Juz. Inv. Prep.' WHEN 3 THEN 'preparatoria' "
                 "WHEN 4 THEN 'Unipersonal' WHEN 5 THEN 'Colegiado' WHEN 6 THEN 'Trabajo' WHEN 7 THEN 'FAMILIA' WHEN 8 THEN 'Civil' "
                 "WHEN 9 THEN NULL ELSE 'Mixto' END",
    "materia": "CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_type END",
    "generico": "CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_name || ' ' || p_type || ' ' || p_brand END",
    "especialidad": "CASE p_partkey % 6 WHEN 0 THEN 'Crimen Organizado' WHEN 1 THEN 'Anticorrupcion' WHEN 2 THEN 'Penal' WHEN 3 THEN 'Penales' "
                    "WHEN 4 THEN NULL ELSE 'Civil' END",
    "motivo": "CASE p_partkey % 9 WHEN 0 THEN 'Nombramiento' WHEN 1 THEN 'por traslado' WHEN 2 THEN 'ASCENSO 2' WHEN 3 THEN 'Re-asignación' "
              "WHEN 4 THEN 'encargatura' WHEN 5 THEN 'Ratificación' WHEN 6 THEN 'sanción' WHEN 7 THEN 'x' ELSE NULL END",
    "codigo": "CASE p_partkey % 7 WHEN 0 THEN ' x85' WHEN 1 THEN 'Y09.9' WHEN 2 THEN 'Y10' WHEN 3 THEN 'X84' WHEN 4 THEN NULL ELSE 'X99' END",
    "yyyymm": "CASE p_partkey % 8 WHEN 0 THEN '202512' WHEN 1 THEN ' 202400' WHEN 2 THEN 'n/d' WHEN 3 THEN NULL WHEN 4 THEN '202413' ELSE '202407' END",
    "tema": "CASE p_partkey % 4 WHEN 0 THEN 'Hurto agravado' WHEN 1 THEN 'HURTO  AGRAVADO' WHEN 2 THEN 'Lavado' ELSE 'otro' END",
    "fecha": "CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE '2024-12-31' END",
}
_TEXT_SQL = ", ".join(f"{v} AS {k}" for k, v in _TEXTS.items())
# Security themes of crime types.
THEMES = [("HURTO AGRAVADO", "patrimonio"), ("Lavado", "crimen organizado")]


def _letters(x: str) -> str:
    return f"regexp_replace(upper(strip_accents({x})), '[^A-Z]', '', 'g')"


_COURT_SQL = " ".join("WHEN " + " OR ".join(f"contains(upper(coalesce(instancia, 'NA')), '{n}')" for n in needles) + f" THEN '{lab}'"
                      for needles, lab in K.COURT_TYPES)
_MOVE_SQL = " ".join(f"WHEN contains({_letters('motivo')}, '{m}') THEN '{m}'" for m in K.MOVE_REASONS)


@register("classified_cases", sql=f"""
WITH t AS (SELECT p_partkey, p_size, p_retailprice, {_TEXT_SQL} FROM part)
SELECT p_partkey, substr(upper(coalesce(materia, generico, 'NA')), 1, 40) AS materia_f, CASE {_COURT_SQL} ELSE '{K.COURT_TYPE_OTHER}' END AS tipo_organo,
       CASE WHEN regexp_matches(especialidad, 'Crimen|Anticorrup') THEN 'red' WHEN especialidad = 'Penal' THEN 'amber' END AS alerta,
       p_size > 25 AS sobre_umbral, CASE {_MOVE_SQL} ELSE 'OTRO' END AS motivo_f,
       substr(upper(trim(codigo)), 1, 3) BETWEEN 'X85' AND 'Y09' AS homicidio,
       CASE WHEN TRY_CAST(trim(yyyymm) AS BIGINT) IS NULL THEN 0 ELSE least(TRY_CAST(trim(yyyymm) AS BIGINT) % 100, 12) END::INT AS mes,
       CASE {_letters('tema')} WHEN 'HURTOAGRAVADO' THEN 'patrimonio' WHEN 'LAVADO' THEN 'crimen organizado' ELSE 'sin tema' END AS tema_f,
       'Exp. ' || p_partkey::VARCHAR || ' ' || coalesce(especialidad, 's/e') AS rotulo, 'Registro X' AS fuente, fecha AS fecha_corte, 'expediente' AS granularidad
FROM t WHERE fecha IS NOT NULL
""")
def classified_cases(spark, sf):
    """Classifiers, keys, labels and provenance of every case (PRJ-14, 16, 17, 19, 20, 22, 27, 28, 29, FLT-15, FLT-16)."""
    p = Tables(spark, sf).part("p_partkey", "p_name", "p_type", "p_brand", "p_size", "p_retailprice")
    x = p.selectExpr("p_partkey", "p_size", *[f"{v} AS {k}" for k, v in _TEXTS.items()])
    x = MT.dictionary_lookup(x, "tema", spark.createDataFrame(THEMES, "tipo string, tema_n string"), "tipo", "tema_n", "tema_f", default="sin tema")
    x = require_provenance(with_provenance(x, "Registro X", F.col("fecha"), "expediente"))
    return x.select(
        "p_partkey", K.first_non_null_upper("materia", "generico").alias("materia_f"), K.court_type("instancia").alias("tipo_organo"),
        K.speciality_flag("especialidad").alias("alerta"), K.threshold_flag("p_size", 25).alias("sobre_umbral"),
        K.move_reason("motivo").alias("motivo_f"), code_in_range("codigo", "X85", "Y09").alias("homicidio"), month_of_yyyymm("yyyymm").alias("mes"),
        "tema_f", label("Exp. ", F.col("p_partkey").cast("string"), " ", F.coalesce("especialidad", F.lit("s/e"))).alias("rotulo"),
        "fuente", "fecha_corte", "granularidad")


_FLOW = """c AS (SELECT corte, COUNT(*) AS ingresos, COUNT(*) FILTER (WHERE estado = 'F') AS resueltos,
  COUNT(*) FILTER (WHERE estado IN ('O', 'P')) AS pendientes, COUNT(*) FILTER (WHERE estado = 'P') AS apelados FROM cases GROUP BY corte)"""


@register("indicator_extras", sql=f"""
WITH {CASES_SQL}, {_FLOW},
s AS (SELECT n_name AS corte, CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE 10 * n_nationkey END AS estandar,
             CASE WHEN n_nationkey % 4 = 0 THEN 0 ELSE n_nationkey * 2.5 END AS capacidad FROM nation)
SELECT c.corte, ingresos::DOUBLE / nullif(capacidad, 0) AS por_mil, (pendientes + ingresos)::DOUBLE / nullif(capacidad, 0) AS saturacion,
       apelados::DOUBLE / nullif(resueltos, 0) AS apelacion, 1.0 - pendientes::DOUBLE / nullif(ingresos, 0) AS mejora,
       resueltos::DOUBLE / nullif(estandar, 0) AS ejecucion, resueltos - estandar AS brecha
FROM c LEFT JOIN s ON c.corte = s.corte
""")
def indicator_extras(spark, sf):
    """Cases per thousand, saturation, appeal rate, lift, execution and the gap to a standard by court, with
    zero and missing denominators (IND-5, IND-11, IND-12, IND-17, IND-19, JN-14)."""
    c = cases(spark, sf).groupBy("corte").agg(
        F.count(F.lit(1)).alias("ingresos"), F.count_if(F.col("estado") == "F").alias("resueltos"),
        F.count_if(F.col("estado").isin("O", "P")).alias("pendientes"), F.count_if(F.col("estado") == "P").alias("apelados"))
    k = F.col("n_nationkey")
    s = dim(Tables(spark, sf).nation("n_name", "n_nationkey").select(
        F.col("n_name").alias("corte"), F.when(k % 5 != 0, 10 * k).alias("estandar"), F.when(k % 4 == 0, 0.0).otherwise(k * 2.5).alias("capacidad")))
    x = AU.standard_gap(c, s, "corte", "resueltos")
    return x.select("corte", M.per_thousand("ingresos", "capacidad").alias("por_mil"),
                    M.saturation(M.caseload("pendientes", "ingresos"), "capacidad").alias("saturacion"), M.appeal_rate("apelados", "resueltos").alias("apelacion"),
                    M.model_lift("pendientes", "ingresos").alias("mejora"), M.budget_execution("resueltos", "estandar").alias("ejecucion"), "brecha")


_MONTHS = "SELECT o_orderpriority AS id, year(o_orderdate)::INT AS anio, count(*) AS valor FROM orders GROUP BY ALL"


@register("sources_quality", sql=f"""
WITH y AS ({_MONTHS}),
m AS (SELECT id, max(anio) AS ultimo, count(*) AS anios FROM y GROUP BY id),
g AS (SELECT id, sum(valor)::BIGINT AS magnitud FROM y GROUP BY id),
r AS (SELECT *, CASE WHEN left(id, 1) = '3' THEN NULL WHEN left(id, 1) = '2' THEN 20 * magnitud WHEN left(id, 1) = '1' THEN magnitud / 4.0 ELSE magnitud END AS ref FROM g)
SELECT m.id, ultimo, anios, g.magnitud, g.magnitud::DOUBLE / nullif(ref, 0) AS ratio,
       g.magnitud::DOUBLE / nullif(ref, 0) > 10 OR g.magnitud::DOUBLE / nullif(ref, 0) < 0.1 AS fuera_de_banda
FROM m LEFT JOIN g USING (id) LEFT JOIN r USING (id)
""")
def sources_quality(spark, sf):
    """Manifest rows with their magnitude, a sum over yearly records, checked against reference values (JOB-16, AGG-19, AUD-4)."""
    y = (Tables(spark, sf).orders("o_orderpriority", "o_orderdate").groupBy(F.col("o_orderpriority").alias("id"), F.year("o_orderdate").alias("anio"))
         .agg(F.count(F.lit(1)).alias("valor")))
    manifest = y.groupBy("id").agg(F.max("anio").alias("ultimo"), F.count(F.lit(1)).alias("anios"))
    table = J.sources_quality(manifest, y)
    first = F.substring("id", 1, 1)
    reference = table.select("id", F.when(first == "2", 20.0 * F.col("magnitud")).when(first == "1", F.col("magnitud") / 4.0)
                             .when(first != "3", F.col("magnitud").cast("double")).alias("magnitud"))
    return AU.magnitude_check(table, reference, "id", "magnitud").drop("_ref")


@register("identity_audit", sql="""
WITH r AS (SELECT o_orderkey, l.n AS lineas, l.a + CASE WHEN o_orderkey % 50 = 0 THEN 1 ELSE 0 END AS con, l.b AS sin, o_orderkey % 3 AS t, l.n - o_orderkey % 3 AS e
           FROM orders JOIN (SELECT l_orderkey, count(*) AS n, count(*) FILTER (WHERE l_returnflag = 'R') AS a, count(*) FILTER (WHERE l_returnflag <> 'R') AS b
                             FROM lineitem GROUP BY 1) l ON l_orderkey = o_orderkey)
SELECT 'sin_con' AS identidad, count(*) FILTER (WHERE sin + con <> lineas) AS violaciones FROM r
UNION ALL SELECT 'tramite_ejecucion', count(*) FILTER (WHERE t + e <> lineas) FROM r
UNION ALL SELECT 'sin_con_tramite', count(*) FILTER (WHERE sin + con <> t + e) FROM r
""")
def identity_audit(spark, sf):
    """Arithmetic identities between measures of the same rows, with planted violations (AUD-2)."""
    t = Tables(spark, sf)
    li = t.lineitem("l_orderkey", "l_returnflag").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("lineas"), F.count_if(F.col("l_returnflag") == "R").alias("a"), F.count_if(F.col("l_returnflag") != "R").alias("sin"))
    x = t.orders("o_orderkey").join(li, F.col("o_orderkey") == F.col("l_orderkey"))
    x = x.select("lineas", "sin", (F.col("a") + F.when(F.col("o_orderkey") % 50 == 0, 1).otherwise(0)).alias("con"),
                 (F.col("o_orderkey") % 3).alias("t"), (F.col("lineas") - F.col("o_orderkey") % 3).alias("e"))
    c = F.col
    return AU.identity_violations(x, {"sin_con": (c("sin") + c("con"), c("lineas")), "tramite_ejecucion": (c("t") + c("e"), c("lineas")),
                                      "sin_con_tramite": (c("sin") + c("con"), c("t") + c("e"))})


@register("sorted_results", sql="""
WITH g AS (SELECT c_mktsegment AS clave, count(*) AS n FROM customer GROUP BY 1),
y AS (SELECT year(o_orderdate)::INT AS clave, count(*) AS n FROM orders GROUP BY 1),
d AS (SELECT l_shipdate::DATE AS clave, sum(CASE WHEN l_quantity > 45 THEN l_quantity END) AS n FROM lineitem GROUP BY 1)
SELECT 'segmento' AS lista, row_number() OVER (ORDER BY n DESC, clave) AS lugar, clave::VARCHAR AS clave, n::DOUBLE AS n FROM g
UNION ALL SELECT 'anio', row_number() OVER (ORDER BY clave), clave::VARCHAR, n::DOUBLE FROM y
UNION ALL SELECT * FROM (SELECT 'dia', row_number() OVER (ORDER BY n DESC NULLS LAST, clave) AS lugar, clave::VARCHAR, n FROM d) WHERE lugar <= 40
UNION ALL SELECT * FROM (SELECT 'dia_asc', row_number() OVER (ORDER BY n ASC NULLS LAST, clave) AS lugar, clave::VARCHAR, n FROM d) WHERE lugar <= 40
""")
def sorted_results(spark, sf):
    """Result lists in their order: counts by key descending, years ascending, any column in both directions
    with nulls last and a tie-break (AGG-15, TOP-3, TOP-6).  The lists are numbered in the order they come."""
    t = Tables(spark, sf)
    g = T.count_by(t.customer("c_mktsegment"), "c_mktsegment")
    y = T.sort_by(t.orders("o_orderdate").groupBy(F.year("o_orderdate").alias("anio")).agg(F.count(F.lit(1)).alias("n")), "anio")
    d = (t.lineitem("l_shipdate", "l_quantity").groupBy(F.to_date("l_shipdate").alias("dia"))
         .agg(F.sum(F.when(F.col("l_quantity") > 45, F.col("l_quantity"))).alias("n")))
    lists = [("segmento", g, "c_mktsegment"), ("anio", y, "anio"), ("dia", T.sort_by(d, "n", False, "dia").limit(40), "dia"),
             ("dia_asc", T.sort_by(d, "n", True, "dia").limit(40), "dia")]
    out = None
    for name, df, key in lists:
        rows = df.select(F.col(key).cast("string").alias("clave"), F.col("n").cast("double").alias("n")).coalesce(1)
        rows = rows.select(F.lit(name).alias("lista"), (F.monotonically_increasing_id() + 1).alias("lugar"), "clave", "n")     # short lists, in one partition
        out = rows if out is None else out.unionByName(rows)
    return out


@register("timeline", sql="""
WITH m AS (SELECT conv_id, turn, role, length(text) AS n FROM conversations)
SELECT conv_id, string_agg(role, '>' ORDER BY turn DESC) AS historia, first(role ORDER BY turn DESC) AS actual, count(*) AS n FROM m GROUP BY conv_id
""")
def timeline(spark, sf):
    """Histories newest first and their current entry (WIN-6, WIN-4); a history is a bounded list of events by key."""
    from judicata.functions.text import current_of
    c = spark.read.parquet(f"{sf.rstrip('/')}/conversations.parquet").select("conv_id", "turn", "role")
    h = c.groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("turn", "role"))), lambda s: s["role"]).alias("h"), F.count(F.lit(1)).alias("n"))
    return h.select("conv_id", F.array_join(newest_first("h"), ">").alias("historia"), current_of("h").alias("actual"), "n")


@register("assignment_current", sql="""
WITH s AS (SELECT user_id, event_id, ts, event_id % 7 AS plaza, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS hasta FROM events WHERE event_type = 'signup'),
o AS (SELECT user_id, arg_max(plaza, row(ts, plaza)) AS vigente FROM s WHERE hasta IS NULL GROUP BY 1),
d AS (SELECT user_id, CASE WHEN user_id % 10 = 3 THEN (max_by(event_id, row(ts, event_id)) + 1) % 7 ELSE max_by(event_id, row(ts, event_id)) % 7 END AS actual
      FROM events WHERE event_type = 'signup' AND user_id % 13 <> 0 GROUP BY 1)
SELECT user_id, vigente, actual, vigente IS NOT DISTINCT FROM actual AS coincide FROM o FULL JOIN d USING (user_id)
""")
def assignment_current(spark, sf):
    """The open interval of every history against the current assignment of the dimension, with planted disagreements (JN-11)."""
    e = Tables(spark, sf).events("event_id", "user_id", "event_type", "ts").where(F.col("event_type") == "signup").withColumn("t", WN.micros("ts"))
    s = WN.next_in_sequence(e, "user_id", "t", "event_id", {"hasta": "t"}, bucket_micros=86_400_000_000)
    s = s.select("user_id", F.col("t").alias("desde"), "hasta", (F.col("event_id") % 7).alias("plaza"))
    last = e.groupBy("user_id").agg(F.max(F.struct("t", "event_id")).alias("l")).where(F.col("user_id") % 13 != 0)
    shift = F.when(F.col("user_id") % 10 == 3, 1).otherwise(0)
    d = last.select("user_id", ((F.col("l.event_id") + shift) % 7).alias("actual"))
    return MT.current_mismatch(s, d, "user_id", "desde", "hasta", "plaza", "actual")


@register("deseasonalised", sql=f"""
WITH {CASES_SQL},
p AS (SELECT corte, year(o_orderdate) * 12 + month(o_orderdate) - 1 AS periodo, count(*) AS n FROM cases WHERE (o_orderkey % 31) <> 0 GROUP BY ALL),
t AS (SELECT *, (coalesce(sum(n) OVER (PARTITION BY corte ORDER BY periodo RANGE BETWEEN 5 PRECEDING AND 5 FOLLOWING), 0)
                 + 0.5 * (coalesce(sum(n) OVER (PARTITION BY corte ORDER BY periodo RANGE BETWEEN 6 PRECEDING AND 6 PRECEDING), 0)
                          + coalesce(sum(n) OVER (PARTITION BY corte ORDER BY periodo RANGE BETWEEN 6 FOLLOWING AND 6 FOLLOWING), 0)))::DOUBLE
              / (count(n) OVER (PARTITION BY corte ORDER BY periodo RANGE BETWEEN 5 PRECEDING AND 5 FOLLOWING)
                 + 0.5 * (count(n) OVER (PARTITION BY corte ORDER BY periodo RANGE BETWEEN 6 PRECEDING AND 6 PRECEDING)
                          + count(n) OVER (PARTITION BY corte ORDER BY periodo RANGE BETWEEN 6 FOLLOWING AND 6 FOLLOWING))) AS tendencia FROM p),
r AS (SELECT corte, periodo % 12 AS s, avg(n / tendencia) AS raw FROM t GROUP BY ALL),
l AS (SELECT corte, avg(raw) AS level FROM r GROUP BY corte)
SELECT t.corte, periodo, n, tendencia, raw / level AS indice, n / (raw / level) AS ajustado
FROM t JOIN r ON t.corte = r.corte AND periodo % 12 = s JOIN l ON t.corte = l.corte
""")
def deseasonalised(spark, sf):
    """Monthly series of every court with trend, seasonal index and adjusted value, over missing months (WIN-12)."""
    c = cases(spark, sf).where(F.col("o_orderkey") % 31 != 0)
    p = c.groupBy("corte", (F.year("o_orderdate") * 12 + F.month("o_orderdate") - 1).cast("long").alias("periodo")).agg(F.count(F.lit(1)).alias("n"))
    return WN.deseasonalise(p, "corte", "periodo", "n")


_PLACE = "n_name || ' ' || c_mktsegment"
_OTHER = (f"CASE WHEN k % 7 = 1 THEN substr(nombre, 2) WHEN k % 7 = 2 THEN lower(nombre) || 'a' WHEN k % 7 = 3 THEN substr(nombre, 1, 3) || 'é' || substr(nombre, 5) "
          "WHEN k % 7 = 4 THEN substr(nombre, 1, 2) || substr(nombre, 4) || 'x' ELSE nombre END")
_CROSS = f"""l AS (SELECT DISTINCT n_nationkey * 10 + length(c_mktsegment) AS k, {_PLACE} AS nombre FROM customer JOIN nation ON c_nationkey = n_nationkey),
rr AS (SELECT 1000 + k AS k, {_OTHER} AS nombre FROM l WHERE k % 11 <> 5 UNION ALL SELECT 2000 + k, nombre || ' PROVINCIA' FROM l WHERE k % 11 = 6),
a AS (SELECT k, nombre, {_letters('nombre')} AS key FROM l), b AS (SELECT k, nombre, {_letters('nombre')} AS key FROM rr)"""


@register("territory_crosswalk", sql=f"""
WITH RECURSIVE {_CROSS},
e AS (SELECT row_number() OVER (ORDER BY d, x, y) AS i, x, y, d FROM (SELECT a.k AS x, b.k AS y, levenshtein(a.key, b.key) AS d FROM a JOIN b ON abs(length(a.key) - length(b.key)) <= 2)
      WHERE d <= 2),
g AS (SELECT 0::BIGINT AS i, []::BIGINT[] AS xs, []::BIGINT[] AS ys, NULL::BIGINT AS x, NULL::BIGINT AS y, NULL::BIGINT AS d
      UNION ALL SELECT e.i, CASE WHEN f THEN list_append(xs, e.x) ELSE xs END, CASE WHEN f THEN list_append(ys, e.y) ELSE ys END,
                       CASE WHEN f THEN e.x END, CASE WHEN f THEN e.y END, CASE WHEN f THEN e.d END
      FROM (SELECT g.xs, g.ys, e.*, NOT list_contains(g.xs, e.x) AND NOT list_contains(g.ys, e.y) AS f FROM g JOIN e ON e.i = g.i + 1) e)
SELECT x AS left_code, y AS right_code, d::INT AS distance FROM g WHERE x IS NOT NULL
UNION ALL SELECT k, NULL, NULL FROM a WHERE k NOT IN (SELECT x FROM g WHERE x IS NOT NULL)
UNION ALL SELECT NULL, k, NULL FROM b WHERE k NOT IN (SELECT y FROM g WHERE y IS NOT NULL)
""")
def territory_crosswalk(spark, sf):
    """Two codings of the territory matched one to one by name, with misspelt, missing and split
    names, and what is left over on both sides (JN-15)."""
    t = Tables(spark, sf)
    names = t.customer("c_nationkey", "c_mktsegment").distinct().join(dim(t.nation("n_nationkey", "n_name")), F.col("c_nationkey") == F.col("n_nationkey"))
    left = names.select((F.col("n_nationkey") * 10 + F.length("c_mktsegment")).cast("long").alias("k"), F.expr(_PLACE).alias("nombre")).distinct()
    right = (left.where("k % 11 <> 5").select((F.col("k") + 1000).alias("k"), F.expr(_OTHER).alias("nombre"))
             .unionByName(left.where("k % 11 = 6").select((F.col("k") + 2000).alias("k"), F.concat("nombre", F.lit(" PROVINCIA")).alias("nombre"))))
    pairs, only_left, only_right = match_names(left, right, "k", "nombre")
    none = F.lit(None)
    return (pairs.unionByName(only_left.select(F.col("k").alias("left_code"), none.cast("long").alias("right_code"), none.cast("int").alias("distance")))
            .unionByName(only_right.select(none.cast("long").alias("left_code"), F.col("k").alias("right_code"), none.cast("int").alias("distance"))))


@register("snapshot_fold", sql="""
WITH a AS (SELECT o_orderpriority AS dataset, year(o_orderdate)::VARCHAR AS snapshot, o_orderkey, year(o_orderdate) % 3 AS batch FROM orders
           WHERE NOT (year(o_orderdate) = 1998 AND left(o_orderpriority, 1) IN ('1', '2'))),
n AS (SELECT dataset, max(snapshot) AS snapshot FROM a GROUP BY dataset)
SELECT a.dataset, a.snapshot, count(*) AS n, sum(o_orderkey)::BIGINT AS suma, any_value(batch)::BIGINT AS lote FROM a JOIN n USING (dataset, snapshot) GROUP BY ALL
""")
def snapshot_fold(spark, sf):
    """Arrivals folded batch by batch, in an order in which older snapshots come late, one batch replayed;
    what every dataset holds at the end and in which batch it was committed (STR-3, SRC-11)."""
    o = Tables(spark, sf).orders("o_orderkey", "o_orderdate", "o_orderpriority")
    a = o.select(F.col("o_orderpriority").alias("dataset"), F.year("o_orderdate").cast("string").alias("snapshot"), "o_orderkey")
    a = a.where(~((F.col("snapshot") == "1998") & F.substring("dataset", 1, 1).isin("1", "2")))
    folder = shared_folder(spark, "snapshots")
    state = (f"{folder}/slices", f"{folder}/manifest")
    for batch in (0, 1, 1, 2):
        apply_snapshot_batch(a.where(F.col("snapshot").cast("int") % 3 == batch), *state, batch)
    rows = read_current(spark, *state, a.schema).groupBy("dataset", "snapshot").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("suma"))
    held = read_manifest(spark, state[1]).select(F.col("id").alias("dataset"), F.col("seq").alias("lote"))
    return rows.join(held, "dataset").select("dataset", "snapshot", "n", "suma", "lote")


# Case microdata in the sources' column names; {days}: whole days between the two dates, as each engine writes them.
_MICRO = {
    "EXPEDIENTE": "CAST(l_orderkey AS VARCHAR(20))", "LINEA": "CAST(l_linenumber AS VARCHAR(20))",
    "DIAS": "CASE WHEN l_orderkey % 31 = 0 THEN 'n/d' ELSE ' ' || CAST({days} * 9 AS VARCHAR(20)) END",
    "MATERIA": "CASE WHEN l_linenumber = 3 THEN NULL ELSE 'materia ' || CAST(l_suppkey % 60 AS VARCHAR(20)) END", "GENERICO": "l_returnflag || l_linestatus",
    "PROVINCIA": "CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE 'prov ' || CAST(l_partkey % 50 AS VARCHAR(20)) END", "TIPO_INGRESO": "o_orderpriority",
    "INSTANCIA": "CASE l_partkey % 5 WHEN 0 THEN 'Sala Civil' WHEN 1 THEN 'Juzgado de familia' WHEN 2 THEN 'Unipersonal' WHEN 3 THEN NULL ELSE 'Civil' END",
    "proceso": "o_orderstatus", "MES": "CAST(year(o_orderdate) * 100 + month(o_orderdate) AS VARCHAR(20))",
}
_CATEGORIES = ["materia_f", "provincia_f", "tipo_ingreso_f", "instancia_tipo", "proceso"]
_MICRO_SQL = ", ".join(f'{v.format(days="datediff({0}, o_orderdate::DATE, l_shipdate::DATE)".format(chr(39) + "day" + chr(39)))} AS {k}' for k, v in _MICRO.items())
_TRAIN = "(('0x' || left(md5('42|' || EXPEDIENTE || '|' || LINEA), 8))::BIGINT % 100) >= 20"
_LEVELS_SQL = " UNION ALL ".join(
    f"SELECT 'nivel', '{c}', {c}, NULL FROM (SELECT {c}, row_number() OVER (ORDER BY count(*) DESC, {c}) AS i FROM f WHERE train GROUP BY {c}) WHERE i <= 39" for c in _CATEGORIES)


@register("delay_model_split", sql=f"""
WITH m AS (SELECT {_MICRO_SQL} FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
x AS (SELECT EXPEDIENTE, LINEA, TRY_CAST(trim(DIAS) AS DOUBLE) AS dias, substr(upper(coalesce(MATERIA, GENERICO, 'NA')), 1, 40) AS materia_f,
             upper(coalesce(PROVINCIA, 'NA')) AS provincia_f, upper(coalesce(TIPO_INGRESO, 'NA')) AS tipo_ingreso_f,
             CASE {_COURT_SQL.replace("instancia", "INSTANCIA")} ELSE '{K.COURT_TYPE_OTHER}' END AS instancia_tipo, coalesce(proceso, 'NA') AS proceso FROM m),
f AS (SELECT *, {_TRAIN} AS train FROM x WHERE dias BETWEEN 1 AND 998),
q AS (SELECT quantile_cont(dias, 0.5) AS med FROM f WHERE train)
SELECT 'n_train' AS medida, NULL::VARCHAR AS columna, NULL::VARCHAR AS nivel, count(*)::DOUBLE AS valor FROM f WHERE train
UNION ALL SELECT 'n_test', NULL, NULL, count(*)::DOUBLE FROM f WHERE NOT train
UNION ALL SELECT 'baseline_mae', NULL, NULL, avg(abs(dias - med)) FROM f, q WHERE NOT train
UNION ALL SELECT 'mediana', NULL, NULL, any_value(med) FROM q
UNION ALL {_LEVELS_SQL}
""")
def delay_model_split(spark, sf):
    """Features of the delay model from case microdata, their split by a hash of the key, the levels each category
    keeps and the error of the training median (ML-1, ML-2, ML-3, ML-5, PRJ-16, PRJ-17)."""
    t = Tables(spark, sf)
    x = t.lineitem("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag", "l_linestatus")
    x = x.join(t.orders("o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus"), F.col("l_orderkey") == F.col("o_orderkey"))
    micro = x.selectExpr(*[f"{v.format(days='datediff(l_shipdate, o_orderdate)')} AS {k}" for k, v in _MICRO.items()])
    features = J.delay_model_features(micro, key=("EXPEDIENTE", "LINEA"))
    train, test = DM.split(features, ["EXPEDIENTE", "LINEA"])
    return DM.split_report(train, test, _CATEGORIES, "dias")
