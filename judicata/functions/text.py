"""Text keys and text recovery (PRJ-3, PRJ-8, PRJ-9, PRJ-25, FLT-12, §2.11)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING_KEY = "SIN DATO"

# Accented letters and their plain forms, pairwise in order
# (composed forms; decomposed forms lose their combining marks below).
ACCENTED = "ÁÀÂÄÃÅáàâäãåÉÈÊËéèêëÍÌÎÏíìîïÓÒÔÖÕóòôöõÚÙÛÜúùûüÑñÇçÝýÿºª"
PLAIN = "AAAAAAaaaaaaEEEEeeeeIIIIiiiiOOOOOoooooUUUUuuuuNnCcYyyoa"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_key(c, missing: str = MISSING_KEY) -> Column:
    """Trimmed group key; null and blank go to an explicit bucket (never dropped)."""
    t = F.trim(_c(c).cast("string"))
    return F.when(t.isNull() | (t == ""), F.lit(missing)).otherwise(t)


def fold_accents(c) -> Column:
    """Upper-case, accent-free, trimmed key (composed and decomposed input alike)."""
    t = F.translate(_c(c).cast("string"), ACCENTED, PLAIN)
    t = F.regexp_replace(t, r"\p{M}", "")
    return F.upper(F.trim(t))


def letters_key(c) -> Column:
    """Letters A-Z only, after accent folding (spaces, dots and pipes removed)."""
    return F.regexp_replace(fold_accents(c), "[^A-Z]", "")


def merge_territory(c, pattern: str = r"^LIMA .*", to: str = "LIMA") -> Column:
    """Merge territorial variants into one label; run before any ranking."""
    return F.regexp_replace(_c(c), pattern, to)


def recover_tail(c, anchor: str = r"DELITOS?(?:(?U:\s)|$)", width: int = 70, must_contain: str | None = "DELITO") -> Column:
    """Recover a label split by spurious delimiters: from the anchor on, cut
    ``width`` characters, then remove pipes (cut first, pipes second).
    Returns null when the anchor is absent.  ``must_contain`` is a literal every
    anchor match contains; lines without it skip the regex (a cheap substring test)."""
    src = _c(c)
    if must_contain:
        src = F.when(src.contains(must_contain), src)
    tail = F.regexp_extract(src, f"({anchor}[\\s\\S]*)", 1)
    cut = F.replace(F.substring(tail, 1, width), F.lit("|"), F.lit(""))
    return F.when(tail != "", cut)


def search_match(cols, query: str) -> Column:
    """Case-insensitive substring search over the concatenation of ``cols``."""
    blob = F.lower(F.concat_ws("", *[_c(c).cast("string") for c in cols]))
    return blob.contains(query.lower())


def label(*parts) -> Column:
    """Label composition, e.g. ``label(lit("CSJ "), col("nombre"))`` (PRJ-27)."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def code_in_range(c, lo: str, hi: str, width: int = 3) -> Column:
    """Cause-code range on the first ``width`` characters, e.g. ICD-10 X85..Y09 (FLT-16)."""
    return F.substring(F.upper(F.trim(_c(c))), 1, width).between(lo, hi)


def newest_first(arr) -> Column:
    """Timeline newest first: the array of a bounded history, reversed (WIN-6)."""
    return F.reverse(_c(arr))


def current_of(arr) -> Column:
    """Current element of a history = its last element (WIN-4); null where there is none."""
    return F.try_element_at(_c(arr), F.lit(-1))
