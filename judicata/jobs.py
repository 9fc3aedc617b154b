"""End-to-end dataset jobs (JOB-1..16) over bronze frames with the sources'
own column names (all columns as text, as landed by :mod:`judicata.sources`).

Every job is lazy: it returns a dict of DataFrames (tidy silver rows with
provenance, gold arrays, a one-row ``meta`` and a rule ``audit``) and never
collects.  Write them with :mod:`judicata.sinks` and run several with
:func:`judicata.catalog.run_jobs` (failure isolation).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from judicata.functions import metrics as M
from judicata.functions.dates import cutoff_agg, first_parsing_column, month_number, parse_with, yyyymmdd
from judicata.functions.numbers import filled, tolerant_number, tolerant_number_commas
from judicata.functions.provenance import coverage_text, with_provenance
from judicata.functions.text import fold_accents, merge_territory, recover_tail, text_key
from judicata.operators import aggregate as A
from judicata.operators import clean as C
from judicata.operators import sets as S
from judicata.operators import topk as T
from judicata.operators.match import CRIME_TITLES, DELAY_EDGES, prefix_classify


def _year(df: DataFrame, *aliases) -> Column:
    return C.resolve_year(df, aliases or C.YEAR_ALIASES)


def _meta(df: DataFrame, fuente: str, granularidad: str, fecha_corte: Column | None = None,
          scope: str = "Nacional") -> DataFrame:
    """One-row meta: source, cut-off, coverage (min-max year), granularity."""
    aggs = [F.lit(fuente).alias("fuente"), coverage_text(F.min("anio"), F.max("anio"), scope).alias("cobertura"),
            F.lit(granularidad).alias("granularidad")]
    aggs.append((fecha_corte if fecha_corte is not None else F.lit(None).cast("string")).alias("fecha_corte"))
    return df.agg(*aggs)


def _meta_latest(df: DataFrame, fuente: str, granularidad: str, column: str, by: list[str]) -> DataFrame:
    """:func:`_meta` with the cut-off of the latest period's ``column``, from one aggregate: a row a
    period holds its cut-off, and the latest period with all of ``by`` known gives its own."""
    periods = df.groupBy(*by).agg(cutoff_agg(column).alias("_corte"))
    known = F.when(reduce(lambda a, b: a & b, [F.col(b).isNotNull() for b in by]), F.struct(*by))
    return periods.agg(F.lit(fuente).alias("fuente"), coverage_text(F.min("anio"), F.max("anio"), "Nacional").alias("cobertura"),
                       F.lit(granularidad).alias("granularidad"), F.max_by("_corte", known).alias("fecha_corte"))


def _audit(raw: DataFrame, valid_mask: Column, rules: dict[str, Column]) -> DataFrame:
    r = dict(rules)
    r["descartadas"] = valid_mask
    r["validas"] = ~valid_mask
    return C.rule_counts(raw, r, total="leidas")


def _top(df: DataFrame, key: str, value: str, k: int) -> DataFrame:
    g = df.groupBy(text_key(F.col(key)).alias(key)).agg(F.sum(value).alias(value))
    return T.top_k(g, [F.col(value).desc(), F.col(key).asc()], k)


# ------------------------------------------------------------------ JOB-1
def court_workload(raw: DataFrame, years=C.YEAR_RANGES["workload"], inflow=("INGRESO_SIN", "INGRESO_CON"),
                   fuente: str = "Poder Judicial (datos abiertos)") -> dict[str, DataFrame]:
    """Court workload: monthly flows per district and speciality.

    Inflow is a parameter (TRAP-5: the meaning of SIN/CON is ambiguous).
    ``PENDIENTE`` is a stock reported only in January, so a plain sum is right
    (FLT-9; :func:`stock_outside_january` audits it)."""
    x = raw.select(
        _year(raw, "ANIO").alias("anio"), F.trim(F.col("MES")).alias("mes"),
        month_number("MES").alias("mes_n"),
        text_key("DISTRITO_JUDICIAL").alias("distrito_judicial"), text_key("ESPEC_EXP").alias("especialidad"),
        sum(filled(c) for c in inflow).alias("ingresos"), filled("RESUELTO").alias("resueltos"),
        filled("PENDIENTE").alias("pendientes"),
        (filled("SENTENCIA") if "SENTENCIA" in raw.columns else F.lit(0.0)).alias("sentencias"))
    bad = C.bad_row_mask(["ingresos", "resueltos", "pendientes"], "anio", *years)
    valid = x.where(~bad)
    last_year = valid.select(F.max("anio")).scalar()
    last_month = valid.where(F.col("anio") == last_year).select(F.max("mes_n")).scalar()
    fcorte = F.format_string("%d-%02d", last_year, last_month)
    sums = [F.sum(c).cast("bigint").alias(c) for c in ("ingresos", "resueltos", "pendientes")]

    def ind(df, with_cong=True):
        out = df.withColumn("clearance", M.clearance_pct("resueltos", "ingresos"))
        return out.withColumn("congestion", M.congestion("pendientes", "ingresos", "resueltos")) if with_cong else out

    return {
        "tidy": with_provenance(valid, fuente, fcorte, "agregado"),
        "nacional": ind(valid.agg(*sums)),
        "por_distrito": ind(valid.groupBy("distrito_judicial").agg(*sums)),
        "por_especialidad": ind(valid.groupBy("especialidad").agg(*sums), with_cong=False),
        "audit": _audit(x, bad, {"negativos": (F.col("ingresos") < 0) | (F.col("resueltos") < 0) | (F.col("pendientes") < 0),
                                  "anio_invalido": F.col("anio").isNull() | ~F.col("anio").between(*years)}),
        "meta": _meta(valid, fuente, "agregado", fcorte),
    }


def stock_outside_january(tidy: DataFrame) -> DataFrame:
    """FLT-9 audit: rows reporting stock in a month other than January."""
    return tidy.agg(F.count_if((F.col("mes_n") != 1) & (F.col("pendientes") != 0)).alias("violaciones"))


# ------------------------------------------------------------------ JOB-2
def prosecutor_headcount(raw: DataFrame, years=C.YEAR_RANGES["workload"],
                         fuente: str = "Ministerio Publico (datos abiertos)") -> dict[str, DataFrame]:
    """Headcount: snapshot of the last month of each year (summing months would
    double count), latest-year breakdowns by the dimensions present (AGG-10)."""
    x = raw.withColumns({"anio": _year(raw, "anio"), "mes": tolerant_number(F.col("mes")).cast("int")
                         if "mes" in raw.columns else F.lit(None).cast("int"),
                         "total_n": tolerant_number(F.col("total"))})
    bad = C.bad_row_mask(["total_n"], "anio", *years)
    valid = x.where(~bad)
    snap = C.keep_latest_within(valid, "anio", "mes") if "mes" in raw.columns else valid
    latest = C.latest_only(snap, "anio")
    dims = [d for d in ("distrito_fiscal", "cargo", "condicion", "sexo") if d in raw.columns]
    out = {
        "tidy": with_provenance(snap, fuente, latest.select(cutoff_agg("fecha_corte")).scalar()
                                if "fecha_corte" in raw.columns else F.lit(None), "agregado"),
        "por_anio": snap.groupBy("anio").agg(F.sum("total_n").cast("bigint").alias("total")),
        "total_reciente": latest.agg(F.sum("total_n").cast("bigint").alias("total_fiscales")),
        "audit": _audit(x, bad, {}),
        "meta": _meta_latest(valid, fuente, "agregado", "fecha_corte", ["anio", "mes"] if "mes" in raw.columns else ["anio"])
                if "fecha_corte" in raw.columns else _meta(valid, fuente, "agregado"),
    }
    if dims:
        keyed = latest.withColumns({d: text_key(F.col(d)) for d in dims})
        out["desglose"] = A.breakdown(keyed, dims, [F.sum("total_n").cast("bigint").alias("total")])
    return out


# ------------------------------------------------------------------ JOB-3 / JOB-7
def flow_by_year(raw: DataFrame, years=C.YEAR_RANGES["workload"], top: int = 15, cutoff: str = "first_dmy",
                 fuente: str = "Ministerio Publico (datos abiertos)") -> dict[str, DataFrame]:
    """Prosecution flow (ingresado / atendido): per year with clearance, latest
    year by subject and district, top districts.  Cut-off: ``first_dmy`` (flagrancy
    and violence flows) takes the first date column where any day-first date
    parses (PRJ-5); ``fecha_corte`` (prosecution cases) applies the multi-format
    rule to the latest year's ``fecha_corte`` column (PRJ-6)."""
    x = raw.withColumns({"anio": _year(raw, "anio"), "ingresado_n": filled("ingresado"),
                         "atendido_n": filled("atendido")})
    bad = C.bad_row_mask(["ingresado_n", "atendido_n"], "anio", *years)
    valid = x.where(~bad)
    sums = [F.sum("ingresado_n").cast("bigint").alias("ingresado"), F.sum("atendido_n").cast("bigint").alias("atendido")]
    latest = C.latest_only(valid, "anio")
    if cutoff == "fecha_corte" and "fecha_corte" in raw.columns:
        fcorte = latest.select(cutoff_agg("fecha_corte")).scalar()
        meta = _meta_latest(valid, fuente, "agregado", "fecha_corte", ["anio"])
    else:
        # the first column in which any date parses: its latest date, from one aggregate
        lower = {c.strip().lower(): c for c in valid.columns}
        dates = [lower[c] for c in ("fecha_descarga", "fecha_publicacion", "fecha_corte") if c in lower]
        cut = F.coalesce(*[F.max(parse_with(F.col(f"`{c}`"), "d/M/yyyy")) for c in dates], F.lit(None).cast("date"))
        fcorte = valid.select(F.date_format(cut, "yyyy-MM-dd")).scalar()
        meta = _meta(valid, fuente, "agregado", F.date_format(cut, "yyyy-MM-dd"))
    out = {
        "tidy": with_provenance(valid, fuente, fcorte, "agregado"),
        "por_anio": valid.groupBy("anio").agg(*sums).withColumn("clearance", M.clearance_pct("atendido", "ingresado")),
        "top_distrito": _top(valid, "distrito_fiscal", "ingresado_n", top) if "distrito_fiscal" in raw.columns else None,
        "audit": _audit(x, bad, {}),
        "meta": meta,
    }
    for dim in ("materia", "distrito_fiscal"):
        if dim in raw.columns:
            out[f"reciente_por_{dim}"] = (latest.groupBy(text_key(F.col(dim)).alias(dim)).agg(*sums)
                                          .withColumn("clearance", M.clearance_pct("atendido", "ingresado")))
    return {k: v for k, v in out.items() if v is not None}


# ------------------------------------------------------------------ JOB-4 / JOB-8
def counted_reports(raw: DataFrame, years=C.YEAR_RANGES["workload"], top: int = 20,
                    type_cols=("generico", "des_articulo", "subgenerico"),
                    fuente: str = "Ministerio Publico (datos abiertos)") -> dict[str, DataFrame]:
    """Reported crimes / cybercrime: totals, per year, per department, top types."""
    x = raw.withColumns({"anio": _year(raw, "anio_denuncia", "anio"), "cantidad_n": filled("cantidad")})
    bad = C.bad_row_mask(["cantidad_n"], "anio", *years)
    valid = x.where(~bad)
    tcol = next((c for c in type_cols if c in raw.columns), None)
    fcorte = valid.select(cutoff_agg("fecha_corte")).scalar() if "fecha_corte" in raw.columns else None
    out = {
        "tidy": with_provenance(valid, fuente, fcorte if fcorte is not None else F.lit(None), "agregado"),
        "total": valid.agg(F.sum("cantidad_n").cast("bigint").alias("total")),
        "por_anio": valid.groupBy("anio").agg(F.sum("cantidad_n").cast("bigint").alias("cantidad")),
        "audit": _audit(x, bad, {}),
        "meta": _meta(valid, fuente, "agregado", fcorte),
    }
    if "dpto_pjfs" in raw.columns:
        out["por_departamento"] = valid.groupBy(text_key(F.col("dpto_pjfs")).alias("departamento")).agg(
            F.sum("cantidad_n").cast("bigint").alias("cantidad"))
    if tcol:
        out["top_tipos"] = _top(valid, tcol, "cantidad_n", top)
    return out


# ------------------------------------------------------------------ JOB-5
# The columns that identify one ruling event.
EVENT_KEY = ["EXPEDIENTE", "instancia", "FECHA_INGRESO", "FECHA_SENTENCIA", "DIAS"]


def case_delay(processes: dict[str, tuple[DataFrame, str]], edges=DELAY_EDGES,
               fuente: str = "Poder Judicial (microdatos por expediente)") -> dict[str, DataFrame]:
    """Case-level delay (IND-14) for several processes: drop personal columns first,
    collapse per-party duplicates to one ruling event, keep delays >= 0, profile
    (n, mean, min, max, median, p90; only min and max in whole days) and a
    fixed-bucket histogram per process.  The cut-off is judged within each
    process and the latest of them is taken."""
    parts = []
    for proceso, (raw, inst_col) in processes.items():
        d = C.drop_private(raw)
        d = d.withColumn("instancia", F.trim(F.col(inst_col)) if inst_col in d.columns else F.lit(""))
        parts.append(d.withColumn("proceso", F.lit(proceso)))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p, allowMissingColumns=True)
    key = [k for k in EVENT_KEY if k in u.columns] + ["proceso"]
    ev = S.dedup_first(u, key, [c for c in u.columns if c not in key], count_col="n_partes")
    ev = ev.withColumn("dias", tolerant_number(F.col("DIAS")))
    ok = F.col("dias").isNotNull() & (F.col("dias") >= 0)
    valid = ev.where(ok)
    prof = A.value_histogram(valid, "proceso", "dias").groupBy("proceso").agg(*A.quantile_aggs("dias"))
    prof = prof.withColumns({c: F.col(c).cast("long") for c in ("min", "max")})
    if "FECHA_CORTE" in u.columns:
        fcorte = u.groupBy("proceso").agg(cutoff_agg("FECHA_CORTE").alias("fc")).select(F.max("fc")).scalar()
    else:
        fcorte = F.lit(None).cast("string")
    return {
        "tidy": with_provenance(valid, fuente, fcorte, "expediente"),
        "por_proceso": prof,
        "histograma": A.bucket_counts(valid, "proceso", "dias", edges),
        "audit": ev.groupBy("proceso").agg(F.count(F.lit(1)).alias("eventos"), F.count_if(ok).alias("validos"),
                                           F.count_if(~F.coalesce(ok, F.lit(False))).alias("descartados"),
                                           F.sum("n_partes").cast("bigint").alias("filas_brutas")),
    }


# ------------------------------------------------------------------ JOB-6
def constitutional_court(ing: DataFrame, pub: DataFrame, years=C.YEAR_RANGES["constitutional"], min_n: int = 30,
                         fuente: str = "Tribunal Constitucional (datos abiertos)") -> dict[str, DataFrame]:
    """Filed and published cases per year (full outer merge), filings per type,
    real delay = publication - filing per type (n >= 30) and global."""
    i = C.drop_private(ing).select(yyyymmdd("FEC_INGRESO").alias("fec_ing"), F.trim("CDES_TIPOPROCESO").alias("tipo"))
    i = i.withColumn("anio", F.year("fec_ing")).where(F.col("anio").between(*years))     # FLT-3
    p = C.drop_private(pub).select(yyyymmdd("FEC_INGRESO").alias("fec_ing"), yyyymmdd("PUB_PAGWEB").alias("fec_pub"),
                                   F.trim("CDES_TIPOPROCESO").alias("tipo"),
                                   *([yyyymmdd("FEC_DEVPJ_1").alias("fec_dev")] if "FEC_DEVPJ_1" in pub.columns else []))
    p = p.withColumn("anio", F.year("fec_pub")).where(F.col("anio").between(*years))
    gi = i.groupBy("anio").agg(F.count(F.lit(1)).alias("ingresados"))
    gp = p.groupBy("anio").agg(F.count(F.lit(1)).alias("publicados"))
    por_anio = gi.join(gp, "anio", "full_outer").select(
        "anio", F.coalesce("ingresados", F.lit(0)).alias("ingresados"), F.coalesce("publicados", F.lit(0)).alias("publicados"))
    d = p.withColumn("dias", F.datediff("fec_pub", "fec_ing"))
    dem = d.where(F.col("dias") >= 0)
    fcorte = (p.select(F.date_format(F.max("fec_dev"), "yyyy-MM-dd")).scalar() if "FEC_DEVPJ_1" in pub.columns
              else F.lit(None).cast("string"))
    return {
        "por_anio": por_anio,
        "por_tipo": i.groupBy("tipo").agg(F.count(F.lit(1)).alias("n")),
        "demora": A.quantile_profile(dem, "tipo", "dias", min_n=min_n, global_label="TOTAL"),
        "audit": d.agg(F.count(F.lit(1)).alias("publicados"), F.count_if(F.col("dias") < 0).alias("dias_negativos"),
                       F.count_if(F.col("dias").isNull()).alias("sin_fechas")),
        "meta": _meta(por_anio, fuente, "expediente", fcorte),
    }


# ------------------------------------------------------------------ JOB-9
def trafficking_sheet(long: DataFrame, top: int = 15) -> dict[str, DataFrame]:
    """Wide sheet already unpivoted by :func:`judicata.sources.sheet.sheet_to_long`."""
    return {"por_distrito": _top(long, "distrito", "valor", top),
            "por_anio": long.groupBy("anio").agg(F.sum("valor").alias("total")),
            "total": long.agg(F.sum("valor").alias("total"))}


# ------------------------------------------------------------------ JOB-10
# Violence types, relations and age groups with the words of their columns.
VIOLENCE_TYPES = {"Psicologica": ("VIOLENCIA PSICOLOGICA",), "Fisica": ("VIOLENCIA FISICA",),
                  "Sexual": ("VIOLENCIA SEXUAL",), "Economica o patrimonial": ("VIOLENCIA ECON",)}
RELATIONS = {"Pareja": ("VINCULO RELACIONAL", "PAREJA"), "Ex pareja": ("VINCULO RELACIONAL", "EX PAREJA"),
             "Familiar": ("VINCULO RELACIONAL", "FAMILIAR"), "Conocido": ("VINCULO RELACIONAL", "CONOCIDO"),
             "Desconocido": ("VINCULO RELACIONAL", "DESCONOCIDO"), "Otros": ("VINCULO RELACIONAL", "OTROS")}
AGE_GROUPS = {"0-5": "0_5", "6-11": "6_11", "12-17": "12_17", "18-29": "18_29", "30-59": "30_59", "60 a mas": "60_MÁS"}


def violence_cases(raw: DataFrame, total_needles=(("CASOS ATENDIDOS", "TOTAL"), ("CASOS", "TOTAL"), ("DE CASOS", "MUJERES"),
                                                  ("CASOS", "MUJERES")),
                   categories: dict[str, dict] | None = None, years=C.YEAR_RANGES["violence"], top: int = 25,
                   fuente: str = "MIMP - CEM (datos abiertos)") -> dict[str, DataFrame]:
    """Violence / femicide / attempt tables: totals per year and department
    (territorial variants merged before the top list, TRAP-4) and column-wise
    category totals turned into rows (AGG-11).  Categories overlap or are
    partial by design, so their sum is not the total."""
    d = C.drop_private(raw)
    tcol = next((c for n in total_needles if (c := C.find_col(d.columns, *n))), None)
    ycol = C.find_col(d.columns, "AÑO") or C.find_col(d.columns, "ANIO")
    dcol = C.find_col(d.columns, "DEPARTAMENTO")
    if tcol is None:
        raise ValueError(f"no total column among {d.columns}")
    x = d.withColumns({"anio": tolerant_number(F.col(f"`{ycol}`")).cast("int") if ycol else F.lit(None).cast("int"),
                       "total_n": F.coalesce(tolerant_number_commas(F.col(f"`{tcol}`")), F.lit(0.0))})
    bad = C.bad_row_mask(["total_n"], "anio", *years)
    valid = x.where(~bad)
    fcols = [c for c in (C.find_col(d.columns, "FECHA", "REPORTE"), C.find_col(d.columns, "FECHA", "ENVIO"),
                           C.find_col(d.columns, "FECHA")) if c][:1]
    fcorte = (valid.select(F.date_format(F.max(first_parsing_column(valid, fcols)), "yyyy-MM-dd")).scalar()
              if fcols else None)
    out = {"por_anio": valid.groupBy("anio").agg(F.sum("total_n").cast("bigint").alias("cantidad")),
           "total": valid.agg(F.sum("total_n").cast("bigint").alias("total")),
           "audit": _audit(x, bad, {}), "meta": _meta(valid, fuente, "agregado", fcorte)}
    if dcol:
        dep = merge_territory(fold_accents(F.col(f"`{dcol}`")))
        g = valid.groupBy(dep.alias("departamento")).agg(F.sum("total_n").cast("bigint").alias("cantidad"))
        out["por_departamento"] = T.top_k(g, [F.col("cantidad").desc(), F.col("departamento")], top)
    for name, spec in (categories or {}).items():
        cols = {label: C.find_col(d.columns, *(needles if isinstance(needles, tuple) else (needles,)))
                for label, needles in spec.items()}
        cols = {k: v for k, v in cols.items() if v}
        if cols:
            wide = valid.agg(*[F.coalesce(F.sum(tolerant_number_commas(F.col(f"`{c}`"))), F.lit(0.0)).cast("bigint").alias(k)
                               for k, c in cols.items()])
            out[name] = wide.unpivot([], list(cols), "categoria", "cantidad")
    return out


# ------------------------------------------------------------------ JOB-11
def police_lines(lines: DataFrame, year: str = "anio", titles=CRIME_TITLES, top: int = 20,
                 fuente: str = "INEI - Registro de denuncias (PNP)") -> dict[str, DataFrame]:
    """Counts per crime title from corrupt text lines (label recovery + longest
    prefix), with per-year totals, unclassified lines and the loss ratio
    (lines without a readable title).  The published total counts every line
    with the anchor; per-type counts only classified ones (AGG-16)."""
    x = lines.select(F.col(year).alias("anio"), recover_tail(F.col("line")).alias("rec"))
    x = x.withColumn("tipo", prefix_classify(F.col("rec"), titles))
    per_year = x.groupBy("anio").agg(
        F.count(F.lit(1)).alias("lineas"), F.count_if(F.col("rec").isNotNull()).alias("con_generico"),
        F.count_if(F.col("rec").isNotNull() & F.col("tipo").isNull()).alias("sin_clasificar"))
    per_year = per_year.withColumn("perdida", F.lit(1.0) - F.try_divide(F.col("con_generico").cast("double"),
                                                                         F.col("lineas").cast("double")))
    # lines without a title form a group that counts nothing: a filter on the count is not pushed below the match
    by_type = x.groupBy("anio", "tipo").agg(F.count("tipo").alias("cantidad")).where("cantidad > 0")
    totals = by_type.groupBy("tipo").agg(F.sum("cantidad").cast("bigint").alias("cantidad"))   # AGG-17
    checks = per_year.agg(F.count_if(F.col("con_generico") < 0).alias("negativos"))
    return {"por_anio": per_year, "por_anio_tipo": by_type,
            "top_tipos": T.top_k(totals, [F.col("cantidad").desc(), F.col("tipo")], top),
            "audit": checks, "meta": _meta(per_year, fuente, "agregado")}


# ------------------------------------------------------------------ JOB-12
def crimes_by_department(raw: DataFrame, official: DataFrame, years=C.YEAR_RANGES["territory"],
                         fuente: str = "Ministerio Publico (datos abiertos)") -> dict[str, DataFrame]:
    """Year x department counts over labels in the official territory set
    (accent-folded); dropped labels are listed (anti join) and dropped rows
    counted by reason.  The cut-off is that of the kept rows."""
    x = raw.withColumns({"anio": _year(raw, "anio_denuncia", "anio"), "cantidad_n": filled("cantidad"),
                         "departamento": fold_accents(F.col("dpto_pjfs"))})
    off = official.select(fold_accents(F.col(official.columns[0])).alias("departamento")).distinct()
    bad = C.bad_row_mask(["cantidad_n"], "anio", *years)
    ok = x.where(~bad).join(off, "departamento", "left_semi")       # FLT-6 / JN-3
    g = ok.groupBy("anio", "departamento").agg(F.sum("cantidad_n").cast("bigint").alias("cantidad"))
    marked = (x.join(off.withColumn("_in", F.lit(True)), "departamento", "left")
              .withColumn("_oficial", F.col("_in").isNotNull()))
    from judicata.sinks.writers import to_year_map
    return {"por_anio_departamento": g, "mapa": to_year_map(g, "anio", "departamento", "cantidad"),
            "total_por_anio": g.groupBy("anio").agg(F.sum("cantidad").cast("bigint").alias("cantidad")),
            "descartados": x.join(off, "departamento", "left_anti").select("departamento").distinct(),
            "audit": _audit(marked, bad | ~F.col("_oficial"), {"fila_invalida": bad, "territorio_no_oficial": ~F.col("_oficial")}),
            "meta": _meta(g, fuente, "agregado", ok.select(cutoff_agg("fecha_corte")).scalar()
                          if "fecha_corte" in raw.columns else None, scope="Nacional por departamento")}


# ------------------------------------------------------------------ JOB-14 features
def delay_model_features(micro: DataFrame, key: tuple[str, ...] = ()) -> DataFrame:
    """ML-1 features from case microdata: coalesced subject, province, entry
    type and court type (first-hit classifier), month of AAAAMM; target 1..998.
    ``key`` columns are kept, for the split."""
    from judicata.functions.classify import court_type, first_non_null_upper
    from judicata.functions.dates import month_of_yyyymm
    d = C.drop_private(micro)
    col = lambda *names: [F.col(n) for n in names if n in d.columns] or [F.lit(None).cast("string")]
    x = d.select(
        *key, F.coalesce(*[tolerant_number(c) for c in col("dias", "DIAS")]).alias("dias"),
        first_non_null_upper(*col("MATERIA", "GENERICO", "materia")).alias("materia_f"),
        first_non_null_upper(*col("PROVINCIA"), width=None).alias("provincia_f"),
        first_non_null_upper(*col("TIPO_INGRESO"), width=None).alias("tipo_ingreso_f"),
        court_type(F.coalesce(*col("INSTANCIA", "instancia"))).alias("instancia_tipo"),
        F.coalesce(*col("proceso"), F.lit("NA")).alias("proceso"),
        month_of_yyyymm(F.coalesce(*col("MES"))).alias("mes_anio"))
    return x.where(F.col("dias").between(1, 998))     # FLT-5: drops the 999 sentinel and 0


# ------------------------------------------------------------------ JOB-15
def court_rollups(cortes: DataFrame, departamentos: DataFrame | None = None) -> dict[str, DataFrame]:
    """Court table -> national KPIs (weighted delay), department rollup
    (sums, unweighted mean delay), congestion ranking and alert flags."""
    c = cortes.withColumns({"congestion": M.congestion("pendientes", "ingresados", "resueltos"),
                            "carga_por_juez": M.load_per_judge("ingresados", "jueces"),
                            "clearance": M.clearance_ratio("resueltos", "ingresados")})
    from judicata.operators.windows import rank_desc
    ranked = rank_desc(c, "congestion", "corte", out="ranking_congestion")
    nat = c.agg(F.sum("ingresados").cast("bigint").alias("expedientes_ingresados"),
                F.sum("resueltos").cast("bigint").alias("resueltos"), F.sum("pendientes").cast("bigint").alias("pendientes"),
                F.sum("jueces").cast("bigint").alias("jueces"),
                A.weighted_mean("demora_dias", "ingresados").alias("demora_ponderada"))
    nat = nat.withColumns({"clearance": M.clearance_ratio("resueltos", "expedientes_ingresados"),
                           "congestion": M.congestion("pendientes", "expedientes_ingresados", "resueltos"),
                           "mora": M.backlog_ratio("pendientes", "resueltos")})
    dep = c.groupBy("departamento").agg(
        F.sum("ingresados").cast("bigint").alias("ingresados"), F.sum("resueltos").cast("bigint").alias("resueltos"),
        F.sum("pendientes").cast("bigint").alias("pendientes"), F.sum("jueces").cast("bigint").alias("jueces"),
        F.avg("demora_dias").alias("demora_simple"), A.weighted_mean("demora_dias", "ingresados").alias("demora_ponderada"))
    if departamentos is not None:
        dep = dep.join(departamentos, "departamento", "inner")
        if "poblacion_miles" in departamentos.columns:
            dep = dep.withColumn("por_mil_habitantes", M.per_thousand("ingresados", "poblacion_miles"))
    return {"cortes": ranked, "nacional": nat, "departamentos": dep}


# ------------------------------------------------------------------ JOB-16
def sources_quality(manifest: DataFrame, magnitudes: DataFrame) -> DataFrame:
    """Manifest rows with their magnitude (AGG-19: sum over yearly records; its meaning differs per dataset)."""
    return manifest.join(magnitudes.groupBy("id").agg(F.sum("valor").alias("magnitud")), "id", "left")
