"""Wide sheets: header-row discovery (SRC-12), unpivot of year columns
(AGG-12) and a column profiler over header samples (SRC-13)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Canonical workload columns and their header synonyms.
SYNONYMS = {
    "distrito_judicial": ["distrito judicial", "distrito_judicial", "corte", "dpto_judicial"],
    "especialidad": ["especialidad", "espec", "materia"],
    "instancia": ["instancia", "tipo_organo", "tipo de organo", "tipo_órgano"],
    "anio": ["anio", "año", "year", "periodo"],
    "pendientes_inicio": ["pendiente inicial", "pendientes_inicio", "stock inicial", "carga inicial"],
    "ingresos": ["ingreso", "ingresos", "ingresado", "ingresot"],
    "resueltos": ["resuelto", "resueltos", "resueltot"],
    "pendientes_fin": ["pendiente final", "pendientes_fin", "pendiente", "stock final"],
}
MIN_HITS = 3


def _plain(cells) -> Column:
    return F.transform(cells, lambda c: F.lower(F.trim(F.regexp_replace(c, r"\s+", " "))))


def find_header_row(rows: DataFrame, first_cell: str = "distrito fiscal") -> Column:
    """Scalar subquery: index of the first row in which a cell is ``first_cell``
    (case/space-insensitive), whichever column it stands in; null when absent."""
    return rows.where(F.array_contains(_plain("cells"), first_cell)).select(F.min("row_idx")).scalar()


def sheet_to_long(rows: DataFrame, first_cell: str = "distrito fiscal", label: str = "distrito",
                  totals=("NACIONAL", "", "NAN")) -> DataFrame:
    """Rows (row_idx, cells) of one wide sheet -> (distrito, anio, valor).

    The header row is located by its label cell, the label column by that cell's
    place, the year columns by their 4-digit labels after it; every cell below is
    one (label, year, value) record.  Cells that are blank, junk or negative are ignored one by one and
    total rows (NACIONAL / blank) are excluded."""
    hdr_idx = find_header_row(rows, first_cell)
    # the header row's cells, as a scalar subquery (one row; no join with the body)
    hdr = rows.where(F.col("row_idx") == hdr_idx).select(F.first("cells")).scalar()
    body = rows.where(F.col("row_idx") > hdr_idx).withColumn("h", hdr)
    cells = F.arrays_zip(F.col("h").alias("k"), F.col("cells").alias("v"))
    at = F.array_position(_plain("h"), first_cell).cast("int")
    x = body.select(F.get("cells", at - 1).alias(label), at.alias("at"), F.posexplode(cells).alias("pos", "kv"))
    x = x.where(F.col("pos") >= F.col("at")).select(label, F.trim(F.col("kv.k")).alias("k"), F.col("kv.v").alias("v"))
    x = x.where(F.col("k").rlike(r"^\d{4}(\.0)?$"))
    x = x.select(F.trim(F.col(label)).alias(label), F.substring("k", 1, 4).cast("int").alias("anio"),
                 F.trim(F.col("v")).try_cast("double").alias("valor"))
    x = x.where(F.col("valor").isNotNull() & (F.col("valor") >= 0))
    lab = F.upper(F.trim(F.coalesce(F.col(label), F.lit(""))))
    return x.where(~lab.isin(*totals))


# Years a wide sheet may have columns for.
SHEET_YEARS = (1990, 2026)


def sheets_to_long(rows: DataFrame, keys=("path", "sheet"), first_cell: str = "distrito fiscal", label: str = "distrito",
                   years=SHEET_YEARS, totals=("NACIONAL", "", "NAN")) -> tuple[DataFrame, DataFrame]:
    """Many wide sheets in one plan: (long, errors).

    ``rows``: keys, row_idx, cells of any number of sheets.  The header of each
    sheet is its first row with the label cell, wherever it stands; it is one
    aggregate per sheet, joined back to the sheet's rows by its keys.  ``long``: keys,
    label, anio, valor as in :func:`sheet_to_long`; ``errors``: keys and error of the sheets
    without a header, which give no rows."""
    keys = list(keys)
    is_header = F.array_contains(_plain("cells"), first_cell)
    headers = rows.groupBy(*keys).agg(F.min(F.when(is_header, F.struct("row_idx", "cells"))).alias("_h"))
    errors = headers.where("_h IS NULL").select(*keys, F.lit(f"no header row with {first_cell!r}").alias("error"))
    found = headers.where("_h IS NOT NULL").select(*keys, F.col("_h.row_idx").alias("_top"), F.col("_h.cells").alias("_names"))
    at = F.array_position(_plain("_names"), first_cell).cast("int")
    body = rows.join(found, keys).where(F.col("row_idx") > F.col("_top"))
    cells = F.arrays_zip(F.col("_names").alias("k"), F.col("cells").alias("v"))
    x = body.select(*keys, F.trim(F.get("cells", at - 1)).alias(label), at.alias("_at"), F.posexplode(cells).alias("_pos", "_kv"))
    year = F.trim("_kv.k")
    anio = F.when(year.rlike(r"^\d{4}(\.0)?$"), F.substring(year, 1, 4).cast("int"))
    valor = F.trim("_kv.v").try_cast("double")
    x = x.where(F.col("_pos") >= F.col("_at")).select(*keys, label, anio.alias("anio"), valor.alias("valor"))
    x = x.where(F.col("anio").between(*years) & (F.col("valor") >= 0))
    return x.where(~F.upper(F.coalesce(F.col(label), F.lit(""))).isin(*totals)), errors


def _norm(h: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(h, r"\s+", " ")))


def _contains(s: str):
    return lambda h: _norm(h).contains(s)


def profile_headers(headers: DataFrame, col: str = "header", synonyms=SYNONYMS, min_hits: int = MIN_HITS) -> DataFrame:
    """Per (file, sheet) row with an array of header names: which canonical
    columns are found (substring synonyms, first synonym wins), hit count and a
    data-sheet flag (>= ``min_hits`` canonical groups).  Pure expressions over
    the array, no join."""
    out = headers
    found = []
    for canon, syns in synonyms.items():
        pick = None
        for s in syns:
            hit = F.filter(col, _contains(s))
            cand = F.element_at(hit, 1)
            pick = F.when(F.size(hit) > 0, cand) if pick is None else pick.when(F.size(hit) > 0, cand)
        out = out.withColumn(f"col_{canon}", pick)
        found.append(F.when(F.col(f"col_{canon}").isNotNull(), 1).otherwise(0))
    hits = sum(found[1:], found[0])
    return out.withColumn("hits", hits).withColumn("es_datos", F.col("hits") >= min_hits)


def year_columns(header: list[str]) -> list[str]:
    """Driver-side helper over metadata: header labels that are years."""
    return [h for h in header if h is not None and re.fullmatch(r"\d{4}(\.0)?", str(h).strip())]
