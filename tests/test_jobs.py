"""End-to-end dataset jobs on literal bronze fixtures (source column names, all text)."""

from pyspark.sql import functions as F

from judicata import jobs as J
from judicata.catalog import run_jobs


def frame(spark, cols, rows):
    return spark.createDataFrame([tuple(None if v is None else str(v) for v in r) for r in rows],
                                 ", ".join(f"`{c}` string" for c in cols))


def test_court_workload(spark):
    # covers: JOB-1 AGG-1 AGG-2 IND-1 IND-2 PRJ-13 PRJ-21 SNK-1 FLT-1 FLT-2
    cols = ["ANIO", "MES", "DISTRITO_JUDICIAL", "ESPEC_EXP", "INGRESO_SIN", "INGRESO_CON", "RESUELTO", "PENDIENTE", "SENTENCIA"]
    rows = [(2024, "Enero", " LIMA ", "CIVIL", 10, 5, 12, 100, 1), (2024, "Febrero", "LIMA", "PENAL", 20, None, 10, 0, 2),
            (2024, "Marzo", "PIURA", "CIVIL", 5, 5, 0, 0, 0), (2024, "Abril", "PIURA", "CIVIL", -1, 0, 0, 0, 0),
            (2014, "Enero", "PIURA", "CIVIL", 1, 0, 0, 0, 0), ("x", "Enero", "", "CIVIL", 1, 1, 1, 1, 1)]
    out = J.court_workload(frame(spark, cols, rows))
    nat = out["nacional"].first()
    assert (nat.ingresos, nat.resueltos, nat.pendientes) == (45, 22, 100)
    assert abs(nat.clearance - 22 * 100 / 45) < 1e-9 and abs(nat.congestion - 145 / 22) < 1e-9
    dist = {r.distrito_judicial: r for r in out["por_distrito"].collect()}
    assert dist["PIURA"].clearance == 0.0 and dist["PIURA"].congestion is None
    audit = {r.rule: r.n for r in out["audit"].collect()}
    assert audit == {"leidas": 6, "negativos": 1, "anio_invalido": 2, "descartadas": 3, "validas": 3}
    meta = out["meta"].first()
    assert meta.fecha_corte == "2024-03" and meta.cobertura == "Nacional, 2024-2024"
    assert set(out["tidy"].columns) >= {"fuente", "fecha_corte", "granularidad"}


def test_prosecutor_snapshot_and_breakdown(spark):
    # covers: JOB-2 FLT-8 AGG-10 FLT-7 PRJ-6
    cols = ["anio", "mes", "distrito_fiscal", "cargo", "total", "fecha_corte"]
    rows = [(2024, 1, "LIMA", "Fiscal", 10, "01/02/2024"), (2024, 2, "LIMA", "Fiscal", 11, "01/03/2024"),
            (2024, 2, "PIURA", "Adjunto", 4, "01/03/2024"), (2023, 12, "LIMA", "Fiscal", 9, "01/01/2024")]
    out = J.prosecutor_headcount(frame(spark, cols, rows))
    assert {r.anio: r.total for r in out["por_anio"].collect()} == {2023: 9, 2024: 15}
    assert out["total_reciente"].first().total_fiscales == 15
    got = {(r.dimension, r.valor): r.total for r in out["desglose"].collect()}
    assert got == {("distrito_fiscal", "LIMA"): 11, ("distrito_fiscal", "PIURA"): 4, ("cargo", "Fiscal"): 11,
                   ("cargo", "Adjunto"): 4}
    assert out["meta"].first().fecha_corte == "2024-03-01"


def test_case_delay_dedup_privacy_histogram(spark):
    # covers: JOB-5 SET-4 PRJ-7 FLT-4 AGG-9 IND-14
    cols = ["EXPEDIENTE", "INSTANCIA", "FECHA_INGRESO", "FECHA_SENTENCIA", "DIAS", "DNI", "FECHA_NACIMIENTO", "FECHA_CORTE"]
    civil = [("E1", "SALA", "20210104", "20210923", 262, "111", "x", "20260623")] * 3 + \
            [("E2", "SALA", "20210101", "20201201", -31, "222", "y", "20260623"),
             ("E3", "JUZ", "20210101", "20210201", 31, "333", "z", "20260623")]
    out = J.case_delay({"Civil": (frame(spark, cols, civil), "INSTANCIA")})
    assert "DNI" not in out["tidy"].columns and "FECHA_NACIMIENTO" not in out["tidy"].columns
    p = out["por_proceso"].first()
    assert p.n == 2 and p.median == (262 + 31) / 2
    h = {r.rango: r.n for r in out["histograma"].collect()}
    assert h["30-90"] == 1 and h["180-365"] == 1 and sum(h.values()) == 2
    a = out["audit"].first()
    assert (a.eventos, a.validos, a.descartados, a.filas_brutas) == (3, 2, 1, 5)


def test_case_delay_fractions_and_cutoff_by_process(spark):
    # covers: JOB-5 AGG-5 AGG-7 PRJ-6
    cols = ["EXPEDIENTE", "INSTANCIA", "DIAS", "FECHA_CORTE"]
    a = frame(spark, cols, [("E1", "S", "20.9", "01/02/2020"), ("E2", "S", "10.2", "01/02/2020")])
    b = frame(spark, cols, [("E3", "S", "7", "20260601")])
    out = J.case_delay({"A": (a, "INSTANCIA"), "B": (b, "INSTANCIA")})
    p = {r.proceso: r for r in out["por_proceso"].collect()}["A"]
    assert abs(p.mean - 15.55) < 1e-9 and abs(p.median - 15.55) < 1e-9 and (p.min, p.max) == (10, 20)
    assert {r.fecha_corte for r in out["tidy"].collect()} == {"2026-06-01"}


def test_constitutional_court(spark):
    # covers: JOB-6 PRJ-4 PRJ-12 PRJ-15 JN-5 AGG-8 FLT-3 FLT-11
    ing = frame(spark, ["FEC_INGRESO", "CDES_TIPOPROCESO"], [("20200105", "AMPARO")] * 31 + [("19910101", "HC")])
    pub_rows = [("20200105", "20200205", "AMPARO", "20260504")] * 31 + [("20200301", "20200201", "HC", "20260504")]
    pub = frame(spark, ["FEC_INGRESO", "PUB_PAGWEB", "CDES_TIPOPROCESO", "FEC_DEVPJ_1"], pub_rows)
    out = J.constitutional_court(ing, pub)
    assert {r.anio: (r.ingresados, r.publicados) for r in out["por_anio"].collect()} == {2020: (31, 32)}
    dem = {r.tipo: r.n for r in out["demora"].collect()}
    assert dem == {"AMPARO": 31, "TOTAL": 31}
    assert out["audit"].first().dias_negativos == 1
    assert out["meta"].first().fecha_corte == "2026-05-04"


def test_violence_columns_and_lima_merge(spark):
    # covers: JOB-10 PRJ-10 AGG-11 PRJ-25 PRJ-2 TOP-1
    cols = ["AÑO", "DEPARTAMENTO", "N° DE CASOS DE FEMINICIDIO MUJERES", "VINCULO RELACIONAL DESCONOCIDO",
            "VINCULO RELACIONAL CONOCIDO", "VINCULO RELACIONAL EX PAREJA", "VINCULO RELACIONAL PAREJA",
            "FEMINICIDIO 30_59 MUJERES", "FEMINICIDIO 0_5 MUJERES", "DNI"]
    rows = [(2020, "Lima Metropolitana", 5, 1, 2, 3, 4, 5, 0, "1"), (2020, "LIMA PROVINCIAS", 2, 0, 0, 0, 2, 2, 0, "2"),
            (2021, "Áncash", "1,000", 0, 0, 0, 0, 0, 1, "3")]
    out = J.violence_cases(frame(spark, cols, rows), categories={"por_vinculo": J.RELATIONS,
                                                                 "por_edad": J.AGE_GROUPS})
    deps = {r.departamento: r.cantidad for r in out["por_departamento"].collect()}
    assert deps == {"LIMA": 7, "ANCASH": 1000}
    v = {r.categoria: r.cantidad for r in out["por_vinculo"].collect()}
    assert v["Pareja"] == 6 and v["Ex pareja"] == 3 and v["Conocido"] == 2 and v["Desconocido"] == 1
    e = {r.categoria: r.cantidad for r in out["por_edad"].collect()}
    assert e == {"30-59": 7, "0-5": 1}


def test_police_lines(spark):
    # covers: JOB-11 JN-7 AGG-16 AGG-17 AUD-1
    lines = [(2016, "x|DELITOS CONTRA LA FE P|UBLICA|..."), (2016, "DELITOS CONTRA EL PATRIMONIO"),
             (2016, "DELITO X"), (2016, "basura"), (2017, "DELITOS CONTRA EL ORDEN ECONOMICO")]
    df = spark.createDataFrame(lines, "anio int, line string")
    out = J.police_lines(df)
    y = {r.anio: (r.lineas, r.con_generico, r.sin_clasificar) for r in out["por_anio"].collect()}
    assert y == {2016: (4, 3, 1), 2017: (1, 1, 0)}
    assert out["top_tipos"].count() == 3


def test_crimes_by_department(spark):
    # covers: JOB-12 PRJ-8 JN-3 JN-4 FLT-6 AGG-3 SET-5
    raw = frame(spark, ["anio_denuncia", "dpto_pjfs", "cantidad"],
                [(2020, "Áncash", 5), (2020, "ANCASH", 2), (2020, "#N/D", 9), (2021, "Piura", 1)])
    off = spark.createDataFrame([("ANCASH",), ("PIURA",)], "n string")
    out = J.crimes_by_department(raw, off)
    assert {(r.anio, r.departamento): r.cantidad for r in out["por_anio_departamento"].collect()} == \
        {(2020, "ANCASH"): 7, (2021, "PIURA"): 1}
    assert [r.departamento for r in out["descartados"].collect()] == ["#N/D"]
    assert {r.rule: r.n for r in out["audit"].collect()} == {
        "leidas": 4, "fila_invalida": 0, "territorio_no_oficial": 1, "descartadas": 1, "validas": 3}
    m = {r.anio: r.valores for r in out["mapa"].collect()}
    assert m[2020] == {"ANCASH": 7}


def test_court_rollups(spark):
    # covers: JOB-15 AGG-13 AGG-14 WIN-2 IND-4
    cortes = spark.createDataFrame([("CSJ A", "D1", 100, 80, 50, 2, 400), ("CSJ B", "D1", 300, 200, 100, 3, 800),
                                    ("CSJ C", "D2", 50, 0, 10, 1, 100)],
                                   "corte string, departamento string, ingresados long, resueltos long, pendientes long, "
                                   "jueces long, demora_dias long")
    out = J.court_rollups(cortes)
    nat = out["nacional"].first()
    assert nat.expedientes_ingresados == 450 and abs(nat.demora_ponderada - (40000 + 240000 + 5000) / 450) < 1e-9
    d1 = [r for r in out["departamentos"].collect() if r.departamento == "D1"][0]
    assert d1.demora_simple == 600.0 and d1.demora_ponderada == 700.0
    rk = {r.corte: r.ranking_congestion for r in out["cortes"].collect()}
    assert rk == {"CSJ B": 1, "CSJ A": 2, "CSJ C": 3}       # 2.0 > 1.875; null congestion last


def test_failure_isolation(spark):
    # covers: JOB-17 SNK-5
    def broken():
        raise IOError("unreadable file")
    m = {r.id: r for r in run_jobs(spark, {"ok": lambda: spark.range(3), "roto": broken}).collect()}
    assert m["ok"].n_registros == 3 and m["ok"].error is None
    assert m["roto"].n_registros is None and "unreadable" in m["roto"].error
