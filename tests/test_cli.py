"""The command line runs dataset jobs on raw files with failure isolation."""

import json
import os

from judicata import cli
from judicata.sinks import document_text
from tests.test_sources import _xlsx_bytes


def test_cli_jobs_and_manifest(spark, tmp_path):
    # covers: JOB-1 JOB-9 JOB-6 JOB-17 SNK-2 SNK-3 SRC-1 SRC-3
    (tmp_path / "pj.csv").write_bytes(
        "ANIO;MES;DISTRITO_JUDICIAL;ESPEC_EXP;INGRESO_SIN;INGRESO_CON;RESUELTO;PENDIENTE;SENTENCIA\n"
        "2024;Enero;LIMA;CIVIL;10;5;12;100;1\n2024;Febrero;PIURA;PENAL;20;0;10;0;2\n".encode("latin-1"))
    (tmp_path / "trata.xlsx").write_bytes(_xlsx_bytes([["Distrito Fiscal", "2019", "2020"], ["Lima", 5, 1],
                                                       ["NACIONAL", 9, 9]]))
    ing = [["FEC_INGRESO", "CDES_TIPOPROCESO"], ["20200105", "AMPARO"]]
    pub = [["FEC_INGRESO", "PUB_PAGWEB", "CDES_TIPOPROCESO", "FEC_DEVPJ_1"], ["20200105", "20200205", "AMPARO", "20260504"]]
    (tmp_path / "ing.xlsx").write_bytes(_xlsx_bytes(ing))
    (tmp_path / "pub.xlsx").write_bytes(_xlsx_bytes(pub))
    out = str(tmp_path / "out")
    m = cli.main(["--out", out, f"court_workload={tmp_path}/pj.csv", f"trafficking={tmp_path}/trata.xlsx",
                  f"constitutional={tmp_path}/ing.xlsx,{tmp_path}/pub.xlsx", f"reports={tmp_path}/missing/*.csv"],
                 spark=spark)
    rows = {r.id: r for r in m.collect()}
    assert rows["court_workload"].n_registros == 2 and rows["court_workload"].error is None
    assert rows["trafficking"].error is None and rows["constitutional"].error is None
    assert rows["reports"].n_registros is None and rows["reports"].error
    doc = json.loads(document_text(spark, os.path.join(out, "court_workload.json")))
    assert doc["_meta"]["fecha_corte"] == "2024-02" and doc["nacional"][0]["ingresos"] == 35
    tc = json.loads(document_text(spark, os.path.join(out, "constitutional.json")))
    assert tc["por_anio"] == [{"anio": 2020, "ingresados": 1, "publicados": 1}]
    # a second run upserts: the failed job is replaced when it succeeds
    (tmp_path / "missing").mkdir()
    (tmp_path / "missing" / "d.csv").write_text("anio,dpto_pjfs,generico,cantidad\n2020,LIMA,HURTO,4\n")
    m2 = {r.id: r for r in cli.main(["--out", out, f"reports={tmp_path}/missing/*.csv"], spark=spark).collect()}
    assert m2["reports"].n_registros == 1 and m2["court_workload"].n_registros == 2


def test_cli_text_and_microdata_jobs(spark, tmp_path):
    # covers: JOB-5 JOB-11 JOB-12 SRC-6 SRC-7 SRC-8 PRJ-7
    import zipfile
    z = tmp_path / "2016.zip"
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("CAP_200.csv", "cabecera|x\nx|DELITOS CONTRA LA FE P|UBLICA|1\nx|DELITO X\n".encode("latin-1"))
        f.writestr("muestra_CAP_200.csv", b"cabecera\nDELITOS CONTRA EL HONOR\n")
    (tmp_path / "micro.csv").write_text(
        "EXPEDIENTE,INSTANCIA,FECHA_INGRESO,FECHA_SENTENCIA,DIAS,DNI,FECHA_CORTE\n"
        "E1,SALA,20210104,20210923,262,111,20260623\nE1,SALA,20210104,20210923,262,222,20260623\n"
        "E2,JUZ,20210101,20201201,-31,333,20260623\n")
    (tmp_path / "del.csv").write_text("anio,dpto_pjfs,cantidad\n2020,Áncash,5\n2020,#N/D,3\n", encoding="utf-8")
    (tmp_path / "deps.txt").write_text("ANCASH\nPIURA\n")
    out = str(tmp_path / "out")
    m = cli.main(["--out", out, f"police={z}", f"case_delay=Civil:INSTANCIA:{tmp_path}/micro.csv",
                  f"crimes_by_department={tmp_path}/del.csv,{tmp_path}/deps.txt"], spark=spark)
    rows = {r.id: r for r in m.collect()}
    assert all(r.error is None for r in rows.values()), rows
    pol = json.loads(document_text(spark, os.path.join(out, "police.json")))
    assert pol["por_anio"] == [{"anio": 2016, "lineas": 2, "con_generico": 2, "sin_clasificar": 1, "perdida": 0.0}]
    assert pol["top_tipos"] == [{"tipo": "DELITOS CONTRA LA FE PUBLICA", "cantidad": 1}]
    cd = spark.read.parquet(os.path.join(out, "case_delay", "tidy"))
    assert "DNI" not in cd.columns and cd.count() == 1
    dep = json.loads(document_text(spark, os.path.join(out, "crimes_by_department.json")))
    assert dep["por_anio_departamento"] == [{"anio": 2020, "departamento": "ANCASH", "cantidad": 5}]
    assert dep["descartados"] == [{"departamento": "#N/D"}]
