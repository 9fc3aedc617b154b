"""Tolerant numeric parsing (PRJ-1, PRJ-2, PRJ-21).

Spark 4 runs in ANSI mode, where ``cast('x' as double)`` raises; the
source's "bad text becomes NaN" rule is ``try_cast``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tolerant_number(c) -> Column:
    """Text -> double; blank, junk and null give null."""
    return F.trim(_c(c).cast("string")).try_cast("double")


def tolerant_number_commas(c) -> Column:
    """Like :func:`tolerant_number` but thousand separators ``,`` are removed first."""
    return F.trim(F.replace(_c(c).cast("string"), F.lit(","), F.lit(""))).try_cast("double")


def filled(c, default: float = 0.0) -> Column:
    """Measure coerced and missing values set to ``default`` (the source's fillna(0))."""
    return F.coalesce(tolerant_number(c), F.lit(default))


def sum_filled(*cols) -> Column:
    """Derived measure as a sum of filled measures (ingresos = SIN + CON)."""
    out = None
    for c in cols:
        out = filled(c) if out is None else out + filled(c)
    return out
