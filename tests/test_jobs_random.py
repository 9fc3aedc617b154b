"""Randomised brute-force checks of the dataset jobs: messy bronze rows (junk
numbers, blanks, negatives, out-of-range years, duplicate parties) through the
Spark jobs vs. a direct pandas computation of the same rules."""

import random

import numpy as np
import pandas as pd

from judicata import jobs as J


def _num(v):
    try:
        return float(str(v).strip())
    except (TypeError, ValueError):
        return np.nan


def test_court_workload_random(spark):
    # covers: JOB-1 FLT-1 PRJ-1 PRJ-3 PRJ-21 AGG-1 AGG-2
    rnd = random.Random(11)
    vals = ["5", " 7 ", "x", "", None, "-2", "12.5", "0"]
    rows = []
    for _ in range(400):
        rows.append((rnd.choice(["2024", "2014", "2026", "2027", "abc", None, "2020"]),
                     rnd.choice(["Enero", "Febrero", "Setiembre", "??"]),
                     rnd.choice([" LIMA", "PIURA ", "", None]), rnd.choice(["CIVIL", "PENAL"]),
                     rnd.choice(vals), rnd.choice(vals), rnd.choice(vals), rnd.choice(vals), rnd.choice(vals)))
    cols = ["ANIO", "MES", "DISTRITO_JUDICIAL", "ESPEC_EXP", "INGRESO_SIN", "INGRESO_CON", "RESUELTO", "PENDIENTE",
            "SENTENCIA"]
    out = J.court_workload(spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols)))
    pdf = pd.DataFrame(rows, columns=cols)
    anio = pdf["ANIO"].map(_num)
    ing = pdf["INGRESO_SIN"].map(_num).fillna(0) + pdf["INGRESO_CON"].map(_num).fillna(0)
    res, pen = pdf["RESUELTO"].map(_num).fillna(0), pdf["PENDIENTE"].map(_num).fillna(0)
    ok = ~((ing < 0) | (res < 0) | (pen < 0) | anio.isna() | (anio < 2015) | (anio > 2026))
    key = pdf["DISTRITO_JUDICIAL"].fillna("").str.strip().replace("", "SIN DATO")
    want = pd.DataFrame({"k": key[ok], "ing": ing[ok], "res": res[ok], "pen": pen[ok]}).groupby("k").sum()
    got = {r.distrito_judicial: (r.ingresos, r.resueltos, r.pendientes) for r in out["por_distrito"].collect()}
    assert got == {k: (int(v.ing), int(v.res), int(v.pen)) for k, v in want.iterrows()}
    audit = {r.rule: r.n for r in out["audit"].collect()}
    assert audit["validas"] == int(ok.sum()) and audit["descartadas"] == int((~ok).sum())


def test_case_delay_random(spark):
    # covers: JOB-5 SET-4 FLT-4 AGG-5 AGG-6 AGG-7 AGG-9
    rnd = random.Random(5)
    rows = []
    for i in range(300):
        exp = f"E{rnd.randint(0, 120)}"
        dias = rnd.choice([str(rnd.randint(-20, 900)), "x", "", str(rnd.randint(0, 60))])
        for _ in range(rnd.randint(1, 3)):                  # several parties of one ruling
            rows.append((exp, "SALA", "20200101", "20200301", dias, str(rnd.randint(1, 99999999))))
    cols = ["EXPEDIENTE", "INSTANCIA", "FECHA_INGRESO", "FECHA_SENTENCIA", "DIAS", "DNI"]
    out = J.case_delay({"P": (spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols)), "INSTANCIA")})
    pdf = pd.DataFrame(rows, columns=cols).drop(columns=["DNI"])
    ev = pdf.drop_duplicates(subset=["EXPEDIENTE", "INSTANCIA", "FECHA_INGRESO", "FECHA_SENTENCIA", "DIAS"])
    d = ev["DIAS"].map(_num)
    d = d[d.notna() & (d >= 0)]
    p = out["por_proceso"].first()
    assert p.n == len(d) and p.min == d.min() and p.max == d.max()
    assert abs(p.median - float(np.median(d))) < 1e-9 and abs(p.p90 - float(np.quantile(d, 0.9))) < 1e-9
    assert abs(p.mean - float(d.mean())) < 1e-9
    h = {r.rango: r.n for r in out["histograma"].collect()}
    edges = [0, 30, 90, 180, 365, 730]
    for i, lo in enumerate(edges):
        hi = edges[i + 1] if i + 1 < len(edges) else None
        want = int(((d >= lo) & (d < hi)).sum()) if hi else int((d >= lo).sum())
        assert h[f"{lo}-{hi}" if hi else f"{lo}+"] == want


def test_constitutional_random(spark):
    # covers: JOB-6 PRJ-4 PRJ-15 JN-5 AGG-8 FLT-3 FLT-11
    rnd = random.Random(8)

    def day():
        return rnd.choice([f"{rnd.randint(1990, 2027)}{rnd.randint(1, 12):02d}{rnd.randint(1, 28):02d}", "bad", ""])
    ing = [(day(), rnd.choice(["AMPARO", "HC", "CUMPLIMIENTO"])) for _ in range(300)]
    pub = [(day(), day(), rnd.choice(["AMPARO", "HC"])) for _ in range(400)]
    si = spark.createDataFrame(ing, "FEC_INGRESO string, CDES_TIPOPROCESO string")
    sp = spark.createDataFrame(pub, "FEC_INGRESO string, PUB_PAGWEB string, CDES_TIPOPROCESO string")
    out = J.constitutional_court(si, sp)
    to_d = lambda s: pd.to_datetime(pd.Series(s), format="%Y%m%d", errors="coerce")
    ip = pd.DataFrame(ing, columns=["f", "t"]).assign(d=lambda x: to_d(x.f))
    ip = ip[ip.d.dt.year.between(1992, 2026)]
    pp = pd.DataFrame(pub, columns=["fi", "fp", "t"]).assign(di=lambda x: to_d(x.fi), dp=lambda x: to_d(x.fp))
    pp = pp[pp.dp.dt.year.between(1992, 2026)]
    years = sorted(set(ip.d.dt.year.astype(int)) | set(pp.dp.dt.year.astype(int)))
    want = {y: (int((ip.d.dt.year == y).sum()), int((pp.dp.dt.year == y).sum())) for y in years}
    assert {r.anio: (r.ingresados, r.publicados) for r in out["por_anio"].collect()} == want
    dias = (pp.dp - pp.di).dt.days
    dem = pp.assign(dias=dias)[dias.notna() & (dias >= 0)]
    got = {r.tipo: (r.n, r.median) for r in out["demora"].collect()}
    assert got["TOTAL"] == (len(dem), float(np.median(dem.dias)))
    for t, g in dem.groupby("t"):
        if len(g) >= 30:
            assert got[t] == (len(g), float(np.median(g.dias)))
        else:
            assert t not in got
