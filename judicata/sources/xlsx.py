"""XLSX worksheets as rows of strings (SRC-3), without any Excel library.

An .xlsx file is a zip of XML parts; each file is one task (not splittable).
The output is one row per sheet row: (path, sheet, row_idx, cells array<string>)
with cells placed at their column index, ready for header promotion
(:mod:`judicata.sources.sheet`)."""

from __future__ import annotations

import io
import re
import zipfile
import xml.etree.ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
      "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships"}
ROWS = T.StructType([T.StructField("path", T.StringType()), T.StructField("sheet", T.StringType()),
                     T.StructField("row_idx", T.LongType()),
                     T.StructField("cells", T.ArrayType(T.StringType()))])


def _col_index(ref: str) -> int:
    letters = re.match(r"[A-Z]+", ref).group(0)
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def parse_workbook(content: bytes, first_sheet: bool = False):
    """Yields (sheet name, row index, cells) for every non-empty row, of all sheets or the first."""
    with zipfile.ZipFile(io.BytesIO(content)) as zf:
        shared = []
        if "xl/sharedStrings.xml" in zf.namelist():
            root = ET.fromstring(zf.read("xl/sharedStrings.xml"))
            for si in root.findall("m:si", NS):
                shared.append("".join(t.text or "" for t in si.iter(f"{{{NS['m']}}}t")))
        wb = ET.fromstring(zf.read("xl/workbook.xml"))
        rels = ET.fromstring(zf.read("xl/_rels/workbook.xml.rels"))
        target = {r.get("Id"): r.get("Target") for r in rels}
        for sh in wb.find("m:sheets", NS)[:1 if first_sheet else None]:
            rid = sh.get(f"{{{NS['r']}}}id")
            part = target[rid].lstrip("/")
            part = part if part.startswith("xl/") else "xl/" + part
            root = ET.fromstring(zf.read(part))
            for row in root.iter(f"{{{NS['m']}}}row"):
                cells = {}
                for c in row.findall("m:c", NS):
                    t = c.get("t")
                    if t == "inlineStr":
                        is_ = c.find("m:is", NS)
                        val = "".join(x.text or "" for x in is_.iter(f"{{{NS['m']}}}t")) if is_ is not None else None
                    else:
                        v = c.find("m:v", NS)
                        val = v.text if v is not None else None
                        if t == "s" and val is not None:
                            val = shared[int(val)]
                    if val is not None:
                        cells[_col_index(c.get("r"))] = val
                if cells:
                    width = max(cells) + 1
                    yield sh.get("name"), int(row.get("r")) - 1, [cells.get(i) for i in range(width)]


def read_xlsx_rows(spark: SparkSession, paths, first_sheet: bool = False) -> DataFrame:
    bins = spark.read.format("binaryFile").load(paths).select("path", "content")

    def expand(batches):
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                rows = [(path, s, r, cells) for s, r, cells in parse_workbook(bytes(content), first_sheet)]
                if rows:
                    yield pd.DataFrame(rows, columns=ROWS.names)

    return bins.mapInPandas(expand, ROWS)
