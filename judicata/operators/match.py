"""Matching operators: range buckets (JN-6), longest-prefix taxonomy (JN-7),
as-of and interval joins (JN-9, JN-10, JN-11).

Small fixed dimensions (bucket edges, a ~20-key taxonomy) are compiled into a
``CASE`` expression at plan-build time: no nested-loop join and nothing to
broadcast.  As-of matching is a sort within (key, time bucket) plus a small
per-bucket carry table, so a key with a third of all rows is still spread over
many tasks and no (probe x candidate) pairs are ever formed.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from judicata.functions.text import letters_key

UNB = Window.unboundedPreceding

# Crime-title taxonomy of the police text dumps (canonical labels).
CRIME_TITLES = [
    "DELITOS CONTRA EL PATRIMONIO",
    "DELITOS CONTRA LA VIDA EL CUERPO Y LA SALUD",
    "DELITOS CONTRA LA SEGURIDAD PUBLICA",
    "DELITOS CONTRA LA LIBERTAD",
    "DELITOS CONTRA LA ADMINISTRACION PUBLICA",
    "DELITOS CONTRA LA FAMILIA",
    "DELITOS CONTRA LA FE PUBLICA",
    "DELITOS CONTRA LA HUMANIDAD",
    "DELITOS CONTRA EL ORDEN FINANCIERO Y MONETARIO",
    "DELITOS AMBIENTALES",
    "DELITOS CONTRA LA ECOLOGIA Y LOS RECURSOS NATURALES",
    "DELITOS CONTRA LA TRANQUILIDAD PUBLICA",
    "DELITOS CONTRA EL HONOR",
    "DELITOS CONTRA LOS DERECHOS INTELECTUALES",
    "DELITOS TRIBUTARIOS",
    "DELITOS CONTRA LA VOLUNTAD POPULAR",
    "DELITOS CONTRA EL ORDEN ECONOMICO",
    "DELITOS CONTRA LA CONFIANZA Y LA BUENA FE EN LOS NEGOCIOS",
    "DELITOS CONTRA EL ESTADO Y LA DEFENSA NACIONAL",
    "DELITOS CONTRA LOS PODERES DEL ESTADO Y EL ORDEN CONSTITUCIONAL",
    "DELITOS ADUANEROS",
]

# Delay buckets in days, [e_i, e_{i+1}), last open.
DELAY_EDGES = [0, 30, 90, 180, 365, 730]


def _cols(x):
    return [x] if isinstance(x, str) else list(x)


def bucket_index(value, edges) -> Column:
    """Index of ``[e_i, e_{i+1})`` (last open); null below the first edge or for null."""
    v = F.col(value) if isinstance(value, str) else value
    out = None
    for i in range(len(edges) - 1, -1, -1):
        cond = v >= edges[i]
        out = F.when(cond, F.lit(i)) if out is None else out.when(cond, F.lit(i))
    return out


def letters_only(s: str) -> str:
    """Python twin of :func:`letters_key`, applied to fixed literal keys only."""
    s = unicodedata.normalize("NFKD", s)
    s = "".join(ch for ch in s if not unicodedata.combining(ch)).upper()
    return re.sub(r"[^A-Z]", "", s)


def prefix_classify(text, labels, normalise: bool = True) -> Column:
    """Canonical label whose key is the longest prefix of the text, else null.

    Keys and text are compared letters-only (case, accents, spaces, dots and
    pipes ignored).  Keys are tried longest first, so "ORDEN ECONOMICO" can
    never be shadowed by a shorter key that is its prefix."""
    t = letters_key(text) if normalise else (F.col(text) if isinstance(text, str) else text)
    keyed = {}
    for lab in labels:
        keyed[letters_only(lab) if normalise else lab] = lab
    ordered = sorted(keyed.items(), key=lambda kv: len(kv[0]), reverse=True)
    out = None
    for k, lab in ordered:
        cond = t.startswith(F.lit(k))
        out = F.when(cond, F.lit(lab)) if out is None else out.when(cond, F.lit(lab))
    return out


def asof_join(left: DataFrame, right: DataFrame, key, left_t: str, right_t: str, right_tie: str,
              payload: dict[str, str], bucket: int) -> DataFrame:
    """For each left row, the latest right row of the same key with right_t <= left_t.

    ``left_t``/``right_t`` are longs (e.g. microseconds); ``payload`` maps output
    names to right columns.  Exact, skew-safe: both sides are unioned and sorted
    within (key, floor(t/bucket)); a left row whose bucket holds no earlier
    right row takes the latest right row of the key's earlier buckets from a
    one-row-per-bucket table (running max over buckets)."""
    key = _cols(key)
    rp = F.struct(F.col(right_t).alias("_t"), F.col(right_tie).alias("_tie"),
                  *[F.col(v).alias(k) for k, v in payload.items()])
    lcols = left.columns
    rtype = right.select(rp.alias("_r")).schema["_r"].dataType  # analysis only, no job
    L = left.select(*[F.col(c) for c in lcols], F.col(left_t).alias("_t"), F.lit(1).alias("_side"),
                    F.lit(None).cast(rtype).alias("_r"))
    R = right.select(*[F.col(k) for k in key], F.col(right_t).alias("_t"), F.lit(0).alias("_side"), rp.alias("_r"))
    for c in lcols:
        if c not in key:
            R = R.withColumn(c, F.lit(None).cast(left.schema[c].dataType))
    u = L.unionByName(R).withColumn("_b", F.floor(F.col("_t") / F.lit(bucket)).cast("long"))
    w = Window.partitionBy(*key, "_b").orderBy("_t", "_side").rowsBetween(UNB, 0)
    u = u.withColumn("_in", F.max("_r").over(w))
    best = u.where(F.col("_side") == 0).groupBy(*key, "_b").agg(F.max("_r").alias("_bm"))
    wb = Window.partitionBy(*key).orderBy("_b").rowsBetween(UNB, -1)
    # previous-bucket carry must also exist for buckets that hold only left rows
    bks = u.select(*key, "_b").distinct().join(best, on=key + ["_b"], how="left")
    bks = bks.withColumn("_prev", F.max("_bm").over(wb)).select(*key, "_b", "_prev")
    out = u.where(F.col("_side") == 1).join(bks, on=key + ["_b"], how="left")
    m = F.coalesce(F.col("_in"), F.col("_prev"))
    out = out.withColumn("_m", m)
    return out.select(*[F.col(c) for c in lcols], *[F.col(f"_m.{k}").alias(k) for k in payload])


def interval_join(points: DataFrame, intervals: DataFrame, key, point_t: str, start: str, end: str,
                  tie: str, payload: dict[str, str], bucket: int) -> DataFrame:
    """Point-in-interval join for non-overlapping intervals per key: start <= t < end
    (end null = open).  An as-of match on ``start`` followed by the end check;
    linear in the input, no per-key nested loop.  Use :func:`interval_audit`
    to verify the non-overlap precondition."""
    p = dict(payload)
    p["_end"] = end
    m = asof_join(points, intervals, key, point_t, start, tie, p, bucket)
    ok = F.col("_end").isNull() | (F.col(point_t) < F.col("_end"))
    return m.select(*points.columns, *[F.when(ok, F.col(k)).alias(k) for k in payload])


def interval_audit(intervals: DataFrame, key, start: str, end: str, tie: str, bucket: int | None = None) -> DataFrame:
    """Per key: intervals, open intervals (more than one open interval means the
    history disagrees with a single current assignment, JN-11), overlaps with
    the next interval and gaps before it.

    With ``bucket`` (``start``/``end`` as longs) the next interval is found by the
    skew-safe :func:`judicata.operators.windows.next_in_sequence`."""
    key = _cols(key)
    if bucket is not None:
        from judicata.operators.windows import next_in_sequence
        x = next_in_sequence(intervals, key, start, tie, {"_next": start}, bucket)
    else:
        w = Window.partitionBy(*key).orderBy(start, tie)
        x = intervals.withColumn("_next", F.lead(start).over(w))
    return x.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n_intervals"),
        F.count_if(F.col(end).isNull()).alias("n_open"),
        F.count_if(F.col("_next").isNotNull() & (F.col(end).isNull() | (F.col(end) > F.col("_next")))).alias("n_overlaps"),
        F.count_if(F.col("_next").isNotNull() & (F.col(end) < F.col("_next"))).alias("n_gaps"))


def current_mismatch(intervals: DataFrame, dimension: DataFrame, key: str, start: str, end: str, value: str, current: str) -> DataFrame:
    """Consistency of histories with the current assignment of the dimension (JN-11): (key, value
    of the latest open interval, current value, agrees) for every key of either; where there is no
    open interval, or none in the dimension, the value is null."""
    opened = (intervals.where(F.col(end).isNull()).groupBy(key)
              .agg(F.max(F.struct(F.col(start).alias("s"), F.col(value).alias("v"))).alias("_o")).select(key, F.col("_o.v").alias("vigente")))
    return (opened.join(dimension.select(key, F.col(current).alias("actual")), key, "full")
            .withColumn("coincide", F.col("vigente").eqNullSafe(F.col("actual"))))


def dictionary_lookup(df: DataFrame, col: str, dictionary: DataFrame, key: str, value: str, out: str,
                      default: str | None = None) -> DataFrame:
    """Standardise a coded column through a dictionary (crime type -> security
    theme, service type, court-name standardisation) by a left join on the
    letters-only key (PRJ-29).  Dictionaries are reference tables; AQE decides
    from their measured size whether to broadcast."""
    d = dictionary.select(letters_key(F.col(key)).alias("_k"), F.col(value).alias(out)).dropDuplicates(["_k"])
    x = df.withColumn("_k", letters_key(F.col(col))).join(d, "_k", "left").drop("_k")
    return x.withColumn(out, F.coalesce(F.col(out), F.lit(default))) if default is not None else x
