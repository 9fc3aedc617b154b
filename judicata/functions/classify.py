"""Ordered classifiers (PRJ-16..20, PRJ-28) as ``CASE`` chains."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from judicata.functions.text import letters_key

# Court-type classes in first-hit order: (needles, label).
COURT_TYPES = [
    (("PAZ",), "JUZGADO DE PAZ LETRADO"),
    (("SALA",), "SALA SUPERIOR"),
    (("INV", "PREPARAT"), "JUZ. INVESTIGACION PREPARATORIA"),
    (("UNIPERSONAL",), "JUZ. PENAL UNIPERSONAL"),
    (("COLEGIADO",), "JUZ. PENAL COLEGIADO"),
    (("LABORAL", "TRABAJO"), "JUZGADO LABORAL"),
    (("FAMILIA",), "JUZGADO DE FAMILIA"),
    (("CIVIL",), "JUZGADO CIVIL"),
]
COURT_TYPE_OTHER = "OTRO"

# Alert levels by age in days (strict >).
ALERT_LEVELS = [(1000, "Critico"), (500, "Riesgo")]
ALERT_DEFAULT = "Normal"

# Magistrate move reasons (matched on the letters-only key).
MOVE_REASONS = ["NOMBRAMIENTO", "TRASLADO", "ASCENSO", "REASIGNACION", "ENCARGATURA",
                "RATIFICACION", "SANCION"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_non_null_upper(*cols, default: str = "NA", width: int | None = 40) -> Column:
    """Coalesce chain across equivalent columns, upper-cased, first ``width`` chars (None: all)."""
    whole = F.upper(F.coalesce(*[_c(c).cast("string") for c in cols], F.lit(default)))
    return whole if width is None else F.substring(whole, 1, width)


def court_type(c) -> Column:
    """Court-type class, first hit wins in the fixed order (PRJ-17)."""
    s = F.upper(F.coalesce(_c(c).cast("string"), F.lit("NA")))
    out = None
    for needles, label in COURT_TYPES:
        cond = None
        for n in needles:
            hit = s.contains(n)
            cond = hit if cond is None else (cond | hit)
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(COURT_TYPE_OTHER)


def alert_level(age) -> Column:
    out = None
    for limit, label in ALERT_LEVELS:
        cond = _c(age) > limit
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(ALERT_DEFAULT)


def speciality_flag(c) -> Column:
    """red for Crimen/Anticorrup (regex), amber for exactly Penal (PRJ-19)."""
    s = _c(c).cast("string")
    return F.when(s.rlike("Crimen|Anticorrup"), "red").when(s == "Penal", "amber")


def threshold_flag(c, limit: float) -> Column:
    """Strict ``>`` threshold flag (congestion > 3 or 2.5, share > 0.40, delay > 365) (PRJ-20)."""
    return _c(c) > F.lit(limit)


def move_reason(c) -> Column:
    k = letters_key(c)
    out = None
    for r in MOVE_REASONS:
        out = F.when(k.contains(r), r) if out is None else out.when(k.contains(r), r)
    return out.otherwise("OTRO")
