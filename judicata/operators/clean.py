"""Cleaning, validation and quarantine (PRJ-7, PRJ-10/11, FLT-*, AUD-1/2).

Only metadata (``df.columns``) is inspected on the driver; every data rule is a
column expression evaluated on the executors.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Personal columns removed before any processing (compared
# upper-case and trimmed).
PRIVATE_COLUMNS = ["DNI", "NOMBRES", "APELLIDOS", "NOMBRE", "FECHA_NACIMIENTO",
                   "FEC_NACIMIENTO", "NOMBRE_COMPLETO"]

# Valid year ranges per source family.
YEAR_RANGES = {"workload": (2015, 2026), "constitutional": (1992, 2026),
               "violence": (2002, 2026), "territory": (2019, 2026)}

# Year column aliases, in preference order.
YEAR_ALIASES = ("anio", "ano", "año", "anio_denuncia")


def drop_private(df: DataFrame, extra=()) -> DataFrame:
    """Drop personal columns (case-insensitive, trimmed) right after the scan;
    column pruning then keeps them from ever being read."""
    priv = {c.upper() for c in PRIVATE_COLUMNS} | {c.strip().upper() for c in extra}
    return df.drop(*[c for c in df.columns if c.strip().upper() in priv])


def _tokens(name: str) -> list[str]:
    s = unicodedata.normalize("NFKD", name)
    s = "".join(ch for ch in s if not unicodedata.combining(ch)).upper()
    return [t for t in re.split(r"[^A-Z0-9]+", s) if t]


def _covers(tokens: list[str], needle: list[str]) -> bool:
    n = len(needle)
    return any(tokens[i:i + n] == needle for i in range(len(tokens) - n + 1))


def _covers_prefix(tokens: list[str], needle: list[str]) -> bool:
    """As :func:`_covers`, but the needle's last token may be the beginning of one."""
    n = len(needle)
    return any(tokens[i:i + n - 1] == needle[:-1] and tokens[i + n - 1].startswith(needle[-1])
               for i in range(len(tokens) - n + 1))


def find_col(columns, *needles: str) -> str | None:
    """Column whose name holds every needle as a whole-token run.

    Token boundaries avoid substring traps (CONOCIDO vs DESCONOCIDO, 0_5 vs
    30_59); among several hits the one with the fewest extra tokens wins
    (PAREJA vs EX PAREJA), then the first in column order.  Where no column
    holds all needles as whole tokens, the last token of a needle may be the
    beginning of a token (VIOLENCIA ECON finds VIOLENCIA ECONOMICA)."""
    nts = [_tokens(n) for n in needles]
    for covers in (_covers, _covers_prefix):
        best, best_extra = None, None
        for c in columns:
            toks = _tokens(c)
            if all(nt and covers(toks, nt) for nt in nts):
                extra = len(toks) - sum(len(nt) for nt in nts)
                if best is None or extra < best_extra:
                    best, best_extra = c, extra
        if best is not None:
            return best
    return None


def resolve_year(df: DataFrame, aliases=YEAR_ALIASES) -> Column:
    """Year as int from the first alias present (tolerant parse) (PRJ-11)."""
    lower = {c.strip().lower(): c for c in df.columns}
    for a in aliases:
        if a.lower() in lower:
            return F.trim(F.col(lower[a.lower()]).cast("string")).try_cast("double").cast("int")
    return F.lit(None).cast("int")


def bad_row_mask(measures, year, lo: int, hi: int) -> Column:
    """True for rows to drop: any negative measure, null year or year out of range.

    Null measures are not bad (``NaN < 0`` is False in the source): the
    negative test is wrapped in ``coalesce(.., false)`` so three-valued logic
    does not drop them."""
    y = F.col(year) if isinstance(year, str) else year
    neg = None
    for m in measures:
        c = (F.col(m) if isinstance(m, str) else m) < 0
        neg = c if neg is None else (neg | c)
    neg = F.coalesce(neg, F.lit(False)) if neg is not None else F.lit(False)
    return neg | y.isNull() | F.coalesce(~y.between(lo, hi), F.lit(True))


def split_valid(df: DataFrame, mask: Column, name: str = "_bad"):
    """(valid, quarantine) pair from one mask; the mask column is materialised once."""
    m = df.withColumn(name, mask)
    return m.where(~F.col(name)).drop(name), m.where(F.col(name))


def rule_counts(df: DataFrame, rules: dict[str, Column], total: str = "read") -> DataFrame:
    """Audit table (rule, n) from one aggregation pass over ``df`` (FLT-2)."""
    aggs = [F.count(F.lit(1)).alias(total)] + [F.count_if(F.coalesce(c, F.lit(False))).alias(r)
                                                for r, c in rules.items()]
    wide = df.agg(*aggs)
    names = [total] + list(rules)
    return wide.select(F.inline(F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(n).alias("rule"),
                                                   F.col(n).alias("n")) for i, n in enumerate(names)])))


def keep_latest_within(df: DataFrame, by, col: str) -> DataFrame:
    """Rows whose ``col`` equals its max within ``by`` (snapshot of the last month per year).

    The max is an aggregate (partial per task, one row per group) joined back by
    a semi join, so no group is gathered into one window task."""
    by = [by] if isinstance(by, str) else list(by)
    mx = df.groupBy(*by).agg(F.max(col).alias(col))
    return df.join(mx, on=by + [col], how="left_semi")


def latest_only(df: DataFrame, col: str) -> DataFrame:
    """Rows of the latest value of ``col`` (scalar subquery, no driver round trip)."""
    return df.where(F.col(col) == df.select(F.max(col)).scalar())


def drop_totals(df: DataFrame, label: str, totals=("NACIONAL", "", "NAN")) -> DataFrame:
    """Drop total/blank rows of a sheet by their normalised label (FLT-10)."""
    t = F.upper(F.trim(F.coalesce(F.col(label).cast("string"), F.lit(""))))
    return df.where(~t.isin(*totals))


def expectations(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Expectation table (check, violations): each check is a *violation* predicate."""
    return rule_counts(df, checks, total="rows").where(F.col("rule") != "rows").select("rule", "n")


def tag_violations(df: DataFrame, rules: dict[str, Column], out: str = "reglas") -> DataFrame:
    """Quarantine rows with the names of the rules each one breaks (FLT-2):
    ``out`` is an array of rule names; rows breaking none are not returned."""
    names = F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(r)) for r, c in rules.items()])
    tagged = df.withColumn(out, F.filter(names, lambda x: x.isNotNull()))
    return tagged.where(F.size(out) > 0)
