"""Dates from messy text (PRJ-4, PRJ-5, PRJ-6, PRJ-12..15)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names of the source (Spanish; "Setiembre" is the
# source spelling, "Septiembre" is accepted too), in calendar order.
MONTHS = ["ENERO", "FEBRERO", "MARZO", "ABRIL", "MAYO", "JUNIO", "JULIO",
          "AGOSTO", "SETIEMBRE", "OCTUBRE", "NOVIEMBRE", "DICIEMBRE"]
MONTH_ALIASES = {"SEPTIEMBRE": 9}

# Cut-off formats tried in order; the first format under which any value
# parses wins (day-first, ISO, compact).  Spark patterns accept unpadded
# day and month, as the source's parser did.
CUTOFF_FORMATS = ("d/M/yyyy", "yyyy-M-d", "yyyyMMdd")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _blank_to_null(c) -> Column:
    t = F.trim(_c(c).cast("string"))
    return F.when(t != "", t)


def yyyymmdd(c) -> Column:
    return F.try_to_date(_blank_to_null(c), "yyyyMMdd")


def dmy(c) -> Column:
    """Day-first date; ``4/1/2021`` and ``04/01/2021`` both give 2021-01-04."""
    return F.try_to_date(_blank_to_null(c), "d/M/yyyy")


def parse_with(c, fmt: str) -> Column:
    return F.try_to_date(_blank_to_null(c), fmt)


def cutoff_agg(c, formats=CUTOFF_FORMATS) -> Column:
    """Aggregate expression: the cut-off date of a column of mixed text.

    For the first format under which at least one value parses, the max parsed
    date as ``yyyy-MM-dd`` text; when no format parses anything, the lexical max
    of the non-blank raw values; null when there are none.  One pass, usable in
    ``agg`` (global) or ``groupBy(...).agg`` (per group)."""
    v = _blank_to_null(c)
    tries = [F.date_format(F.max(F.try_to_date(v, f)), "yyyy-MM-dd") for f in formats]
    return F.coalesce(*tries, F.max(v))


def first_parsing_column(df, candidates, fmt: str = "d/M/yyyy") -> Column:
    """Date from the first existing candidate column in which any value parses.

    Existence is resolved on ``df.columns`` (metadata).  "Any value parses" is a
    scalar subquery per column, so the choice happens inside the plan without
    collecting to the driver."""
    lower = {c.strip().lower(): c for c in df.columns}
    present = [lower[c.lower()] for c in candidates if c.lower() in lower]
    out = F.lit(None).cast("date")
    for name in reversed(present):
        parsed = parse_with(F.col(name), fmt)
        any_ok = df.select(F.max(parsed.isNotNull())).scalar()
        out = F.when(F.coalesce(any_ok, F.lit(False)), parsed).otherwise(out)
    return out


def days_between(end, start) -> Column:
    """Whole days from ``start`` to ``end`` (negative when end precedes start)."""
    return F.datediff(F.to_date(_c(end)), F.to_date(_c(start)))


def month_number(c) -> Column:
    """Month name -> 1..12; unknown -> 0 (PRJ-13)."""
    pairs = []
    for i, m in enumerate(MONTHS, start=1):
        pairs += [F.lit(m), F.lit(i)]
    for m, i in MONTH_ALIASES.items():
        pairs += [F.lit(m), F.lit(i)]
    lookup = F.create_map(*pairs)
    return F.coalesce(F.try_element_at(lookup, F.upper(F.trim(_c(c).cast("string")))), F.lit(0))


def month_of_yyyymm(c) -> Column:
    """Month of an ``AAAAMM`` number: mod 100, null -> 0, clipped to 0..12 (PRJ-14)."""
    m = F.pmod(F.trim(_c(c).cast("string")).try_cast("bigint"), F.lit(100))
    return F.least(F.greatest(F.coalesce(m, F.lit(0)), F.lit(0)), F.lit(12)).cast("int")


def age_days(start, as_of: str) -> Column:
    """Age in days at a fixed as-of date (never ``current_date``: reruns must agree)."""
    return F.datediff(F.to_date(F.lit(as_of)), F.to_date(_c(start)))
