"""Provenance columns (PRJ-22, PRJ-23, SNK-1, FLT-15)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRANULARITIES = ("expediente", "agregado")


def with_provenance(df: DataFrame, fuente: str, fecha_corte, granularidad: str) -> DataFrame:
    """Tag every row with source, cut-off date and granularity.

    ``fecha_corte`` may be a literal or a Column (e.g. a scalar subquery)."""
    if granularidad not in GRANULARITIES:
        raise ValueError(f"granularidad must be one of {GRANULARITIES}")
    fc = fecha_corte if isinstance(fecha_corte, Column) else F.lit(fecha_corte)
    return df.withColumns({"fuente": F.lit(fuente), "fecha_corte": fc.cast("string"),
                           "granularidad": F.lit(granularidad)})


def require_provenance(df: DataFrame) -> DataFrame:
    """Discard rows without source or cut-off (SPEC rule)."""
    return df.where(F.col("fuente").isNotNull() & F.col("fecha_corte").isNotNull())


def coverage_text(min_year, max_year, scope: str = "Nacional") -> Column:
    mn = F.col(min_year) if isinstance(min_year, str) else min_year
    mx = F.col(max_year) if isinstance(max_year, str) else max_year
    return F.format_string(f"{scope}, %d-%d", mn.cast("int"), mx.cast("int"))
