"""Scans of messy files: encodings, separators, drifting headers, corrupt lines,
zip members, XLSX cells, wide sheets, header profiles, catalogue documents."""

import io
import json
import zipfile

from pyspark.sql import functions as F

from judicata.sources import catalogue as CAT
from judicata.sources import csv as CSV
from judicata.sources import sheet as SH
from judicata.sources import text as TXT
from judicata.sources import xlsx as XL


def test_csv_smart_encodings_separators_drift(spark, tmp_path):
    # covers: SRC-1 SRC-2
    (tmp_path / "a.csv").write_bytes("﻿ANIO,TOTAL,DEP\n2020,5,Áncash\n".encode("utf-8"))
    (tmp_path / "b.csv").write_bytes("ANIO;MES;TOTAL;DEP\n2021;3;7;Huánuco\n".encode("latin-1"))
    (tmp_path / "c.csv").write_bytes(b"")
    df, errors = CSV.read_csv_smart(spark, str(tmp_path / "*.csv"))
    rows = {r.ANIO: r for r in df.collect()}
    assert set(df.columns) >= {"ANIO", "MES", "TOTAL", "DEP"}
    assert rows["2020"].DEP == "Áncash" and rows["2020"].MES is None
    assert rows["2021"].DEP == "Huánuco" and rows["2021"].TOTAL == "7"
    assert len(errors) == 1 and errors[0][0].endswith("c.csv")


def test_csv_whole_records_and_late_bytes(spark, tmp_path):
    # covers: SRC-1 SRC-2
    (tmp_path / "late.csv").write_bytes(b"A,B\n" + b"x,y\n" * 40_000 + "ÁNCASH,z\n".encode("latin-1"))
    (tmp_path / "breaks.csv").write_bytes('A;B\n"line one\nline two";"say ""yes"" now"\nñ;2\n'.encode())
    (tmp_path / "tab name.csv").write_bytes(b'A\tB\n"it is ""so"""\t3\n')
    df, errors = CSV.read_csv_smart(spark, str(tmp_path / "*.csv"))
    assert errors == [] and df.count() == 40_004
    got = {(r.A, r.B) for r in df.collect()}
    assert got == {("x", "y"), ("ÁNCASH", "z"), ("line one\nline two", 'say "yes" now'), ("ñ", "2"), ('it is "so"', "3")}


def test_latin1_lines_keep_cr_and_bytes(spark, tmp_path):
    # covers: SRC-6
    p = tmp_path / "dump.txt"
    p.write_bytes(b"HEADER|A|B\nDELITOS CONTRA LA FE P|UBLICA\r x\nPER\xdaN\n")
    out = [r.line for r in TXT.read_latin1_lines(spark, str(p), header_prefix="HEADER").collect()]
    assert len(out) == 2
    assert "\r" in out[0] and out[1] == "PERÚN"


def test_zip_member_lines(spark, tmp_path):
    # covers: SRC-7 SRC-8
    p = tmp_path / "2016.zip"
    with zipfile.ZipFile(p, "w") as z:
        z.writestr("CAP_200.csv", b"h\nline1\nl\xednea2\n")
        z.writestr("muestra_CAP_200.csv", b"h\nsample\n")
        z.writestr("diccionario.txt", b"dict\n")
    df = TXT.read_zip_lines(spark, str(p), include=r"CAP_200", exclude=r"muestra|diccionario")
    got = [(r.member, r.line) for r in df.orderBy("line_no").collect()]
    assert got == [("CAP_200.csv", "h"), ("CAP_200.csv", "line1"), ("CAP_200.csv", "línea2")]


def _xlsx_bytes(rows):
    shared = []
    def sidx(s):
        if s not in shared:
            shared.append(s)
        return shared.index(s)
    sheet_rows = []
    for r, cells in enumerate(rows, start=1):
        cs = []
        for c, v in enumerate(cells):
            ref = chr(65 + c) + str(r)
            if v is None:
                continue
            if isinstance(v, (int, float)):
                cs.append(f'<c r="{ref}"><v>{v}</v></c>')
            else:
                cs.append(f'<c r="{ref}" t="s"><v>{sidx(v)}</v></c>')
        sheet_rows.append(f'<row r="{r}">{"".join(cs)}</row>')
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rns = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} {rns}><sheets><sheet name="Trata" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels",
                   '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   '<Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData>{"".join(sheet_rows)}</sheetData></worksheet>')
        z.writestr("xl/sharedStrings.xml",
                   f'<sst {ns}>' + "".join(f"<si><t>{s}</t></si>" for s in shared) + "</sst>")
    return buf.getvalue()


def test_xlsx_wide_sheet_to_long(spark, tmp_path):
    # covers: SRC-3 SRC-12 AGG-12 FLT-10
    rows = [["Cuadro 1"], [None], ["Distrito Fiscal", "2019", "2020", "2021"],
            ["Lima", 5, None, -1], ["Piura", "x", 3, 2], ["NACIONAL", 100, 100, 100]]
    p = tmp_path / "trata.xlsx"
    p.write_bytes(_xlsx_bytes(rows))
    cells = XL.read_xlsx_rows(spark, str(p))
    long = SH.sheet_to_long(cells)
    got = sorted((r.distrito, r.anio, r.valor) for r in long.collect())
    assert got == [("Lima", 2019, 5.0), ("Piura", 2020, 3.0), ("Piura", 2021, 2.0)]


def test_wide_sheet_label_in_second_column(spark):
    # covers: SRC-12
    rows = spark.createDataFrame([(0, [None, "Cuadro"]), (1, [None, " Distrito  Fiscal", "2019", "Total", "2020"]),
                                  (2, ["1", "Lima", "5", "9", "4"]), (3, [None, "Nacional", "5", "9", "4"]), (4, ["2"])],
                                 "row_idx long, cells array<string>")
    got = sorted((r.distrito, r.anio, r.valor) for r in SH.sheet_to_long(rows).collect())
    assert got == [("Lima", 2019, 5.0), ("Lima", 2020, 4.0)]


def test_sheet_without_header_gives_nothing(spark):
    # covers: SRC-12
    rows = spark.createDataFrame([(0, ["a", "b"]), (1, ["c", "d"])], "row_idx long, cells array<string>")
    assert SH.sheet_to_long(rows).count() == 0


def test_profile_headers(spark):
    # covers: SRC-13
    df = spark.createDataFrame([("f1", "Hoja1", ["Distrito Judicial", "Especialidad", "Año", "Ingresos"]),
                                ("f1", "Notas", ["texto", "otro"])], "file string, sheet string, header array<string>")
    out = {r.sheet: r for r in SH.profile_headers(df).collect()}
    assert out["Hoja1"].es_datos and out["Hoja1"].col_anio == "Año" and out["Hoja1"].hits == 4
    assert not out["Notas"].es_datos


def test_catalogue_resources(spark):
    # covers: SRC-9 SRC-4
    docs = [json.dumps({"result": {"name": "ds1", "resources": [{"name": "a", "url": "http://x/A.CSV ", "format": "CSV"},
                                                               {"name": "b", "url": "http://x/b.xlsx"}]}}),
            json.dumps({"result": [{"name": "ds2", "resources": [{"name": "c", "url": "http://x/c.csv"}]}]})]
    df = spark.createDataFrame([(d,) for d in docs], "value string")
    got = sorted((r.dataset, r.name) for r in CAT.csv_resources(df).collect())
    assert got == [("ds1", "a"), ("ds2", "c")]


def test_latest_snapshots(spark):
    # covers: SRC-11
    df = spark.createDataFrame([("casos", "2025-06", "p1"), ("casos", "2025-12", "p2"), ("fem", "2024-01", "p3")],
                               "dataset string, snapshot string, path string")
    assert sorted(r.path for r in CAT.latest_snapshots(df).collect()) == ["p2", "p3"]
