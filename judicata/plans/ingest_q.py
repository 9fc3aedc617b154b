"""Ingestion family: records of split CSV text (SRC-1), identity resolution
(SET-7), many wide sheets in one plan (JOB-9, SRC-12, AGG-12, FLT-10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from judicata import jobs as J
from judicata.operators.identity import resolve_identities
from judicata.plans import register
from judicata.plans.common import dim
from judicata.session import materialise
from judicata.sources.records import assemble_records, decode_lines, parse_records
from judicata.sources.sheet import sheets_to_long
from judicata.tables import Tables, balance


@register("csv_records", sql=r"""
WITH d AS (SELECT *, lang || CASE WHEN doc_id % 2 = 1 AND NOT regexp_matches(coalesce(text, ''), '[^\x{00}-\x{FF}]')
                                  THEN '-latin1' ELSE '' END AS file FROM documents)
SELECT file, row_number() OVER (PARTITION BY file ORDER BY doc_id) AS record_no, doc_id, source, length(text) AS n_chars, md5(text) AS text_md5
FROM d
""")
def csv_records(spark, sf):
    """Documents written as CSV lines and read back: quoted line breaks, doubled
    quotes, Latin-1 and UTF-8 files, blocks that begin in the middle of a record (SRC-1)."""
    d = Tables(spark, sf).documents("doc_id", "lang", "source", "text")
    latin = (F.col("doc_id") % 2 == 1) & ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x00-\xFF]")
    quoted = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    record = F.concat_ws(";", F.col("doc_id").cast("string"), F.concat(F.lit('"'), "source", F.lit('"')), F.coalesce(quoted, F.lit("")))
    x = d.select(F.when(latin, F.concat("lang", F.lit("-latin1"))).otherwise(F.col("lang")).alias("file"), "doc_id",
                 F.posexplode(F.split(record, "\n")).alias("pos", "text"))
    # blocks as a file's splits would be: in order, and wherever they happen to fall within a record
    block = F.floor((F.col("doc_id") * 8 + F.least("pos", F.lit(7))) / 11)
    raw = F.when(F.col("file").endswith("latin1"), F.encode("text", "ISO-8859-1")).otherwise(F.encode("text", "UTF-8"))
    lines = materialise(x.select("file", block.alias("block"), F.struct("doc_id", "pos").alias("n"), raw.alias("raw")))
    got = parse_records(assemble_records(decode_lines(lines)), ["doc_id", "source", "text"], ";", keep_empty=True)
    return got.select("file", "record_no", F.col("doc_id").cast("long").alias("doc_id"), "source",
                      F.char_length("text").cast("long").alias("n_chars"), F.md5(F.col("text").cast("binary")).alias("text_md5"))


# Letters of the ten digits in three renderings that differ everywhere, so that two keys differ by three letters.
RENDERINGS = ("ABCDEFGHIJ", "KLMNOPQRST", "UVWXYZBDFH")


def _planted_name(key: str) -> str:
    """SQL, for both engines, of a name that repeats the name of another key with an edit."""
    own = f"({key} - CASE {key} % 10 WHEN 3 THEN 1 WHEN 7 THEN 1 WHEN 8 THEN 2 ELSE 0 END)"
    digits = f"lpad(CAST({own} AS VARCHAR(20)), 6, '0')"
    name = " || ' ' || ".join(f"translate({digits}, '0123456789', '{r}')" for r in RENDERINGS)
    return (f"CASE WHEN {key} % 97 = 0 THEN NULL WHEN {key} % 10 = 3 THEN 'É' || substr({name}, 2) "
            f"WHEN {key} % 10 = 7 THEN lower(substr({name}, 1, 19)) WHEN {key} % 10 = 8 THEN ({name}) || ' z' ELSE {name} END")


_NAME = _planted_name("c_custkey")


@register("identity_clusters", sql=rf"""
WITH RECURSIVE n AS (SELECT c_custkey AS id, regexp_replace(upper(strip_accents({_NAME})), '[^A-Z]', '', 'g') AS k FROM customer),
e AS (SELECT a.id AS a, b.id AS b FROM n a JOIN n b ON a.id <> b.id AND abs(length(a.k) - length(b.k)) <= 2 AND levenshtein(a.k, b.k) <= 2),
r AS (SELECT id AS a, id AS b FROM n UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT a AS id, min(b) AS cluster_id FROM r GROUP BY a
""")
def identity_clusters(spark, sf):
    """People by name within two edits, chains included, over customers whose names repeat
    others' with replaced, lost and added letters, accents and case (SET-7)."""
    c = balance(Tables(spark, sf).customer("c_custkey"))
    return resolve_identities(c.select("c_custkey", F.expr(_NAME).alias("nombre")), "c_custkey", "nombre")


_SHEET_YEARS = tuple(range(1992, 1999))


def _wide_sheets(spark, sf):
    """(path, sheet, row_idx, cells): a workbook a region and a sheet an order priority; titles above, the
    header at another row and column in each, junk cells, total rows, and one sheet without a header."""
    t = Tables(spark, sf)
    places = dim(t.nation("n_nationkey", "n_name", "n_regionkey").join(dim(t.region("r_regionkey", "r_name")), F.col("n_regionkey") == F.col("r_regionkey")))
    o = (t.orders("o_custkey", "o_orderdate", "o_orderpriority").join(t.customer("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
         .groupBy("c_nationkey", F.col("o_orderpriority").alias("sheet"), F.year("o_orderdate").alias("anio")).agg(F.count(F.lit(1)).alias("n"))
         .join(places, F.col("c_nationkey") == F.col("n_nationkey")))
    n = F.col("n")
    cell = (F.when(n % 10 == 0, F.lit("n.d.")).when(n % 10 == 1, F.concat(F.lit("-"), n.cast("string"))).when(n % 10 == 2, F.lit(" "))
            .otherwise(F.concat(F.lit(" "), n.cast("string"), F.lit(".0"))))
    by_year = o.groupBy(F.col("r_name").alias("path"), "sheet", "n_name", "n_nationkey").agg(
        *[F.max(F.when(F.col("anio") == y, cell)).alias(f"y{y}") for y in _SHEET_YEARS])
    shift = F.substring("sheet", 1, 1).cast("int")                  # header row and left margin of the sheet
    margin = F.array_repeat(F.lit("x"), shift % 3)
    data = by_year.select("path", "sheet", (F.lit(10) + F.col("n_nationkey")).cast("int").alias("row_idx"),
                          F.concat(margin, F.array("n_name", *[F.col(f"y{y}") for y in _SHEET_YEARS])).alias("cells"))
    sheets = by_year.select("path", "sheet").distinct()
    whole = ~((F.col("path") == "ASIA") & (shift == 5))
    head = sheets.select("path", "sheet", (shift + 1).alias("row_idx"),
                         F.concat(margin, F.array(F.when(whole, F.lit(" Distrito  FISCAL")).otherwise(F.lit("Oficina")),
                                                  *[F.lit(f"{y}.0" if y % 2 else f" {y}") for y in _SHEET_YEARS])).alias("cells"))
    title = sheets.select("path", "sheet", F.lit(0).alias("row_idx"), F.array(F.lit("Casos por distrito fiscal"), F.lit("1997")).alias("cells"))
    total = sheets.select("path", "sheet", F.lit(99).alias("row_idx"),
                          F.concat(margin, F.array(F.lit("Nacional"), *[F.lit("999999") for _ in _SHEET_YEARS])).alias("cells"))
    return data.unionByName(head).unionByName(title).unionByName(total)


_LONG_SQL = """
o AS (SELECT r_name AS path, o_orderpriority AS sheet, n_name AS distrito, year(o_orderdate)::INT AS anio, count(*) AS n
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL),
l AS (SELECT path, sheet, distrito, anio, n::DOUBLE AS valor FROM o
      WHERE anio BETWEEN 1992 AND 1998 AND NOT (path = 'ASIA' AND sheet LIKE '5%') AND n % 10 > 2)"""


@register("wide_sheets", sql=f"""
WITH {_LONG_SQL}
SELECT path, sheet, distrito, anio, valor, NULL::VARCHAR AS error FROM l
UNION ALL SELECT DISTINCT path, sheet, NULL, NULL, NULL, 'no header row with ''distrito fiscal''' FROM o WHERE path = 'ASIA' AND sheet LIKE '5%'
""")
def wide_sheets(spark, sf):
    """Every cell of many wide sheets with headers that drift, and the sheets that have none (SRC-12, AGG-12, FLT-10)."""
    long, errors = sheets_to_long(_wide_sheets(spark, sf))
    return long.withColumn("error", F.lit(None).cast("string")).unionByName(errors, allowMissingColumns=True)


@register("job_trafficking_district", sql=f"""
WITH {_LONG_SQL}
SELECT distrito, sum(valor) AS valor FROM l GROUP BY distrito ORDER BY valor DESC, distrito LIMIT 15
""")
def job_trafficking_district(spark, sf):
    """Dataset job over all wide sheets at once: the largest districts (JOB-9, TOP-1)."""
    return J.trafficking_sheet(sheets_to_long(_wide_sheets(spark, sf))[0])["por_distrito"]


@register("job_trafficking_year", sql=f"""
WITH {_LONG_SQL}
SELECT anio, sum(valor) AS total FROM l GROUP BY anio
""")
def job_trafficking_year(spark, sf):
    """Dataset job over all wide sheets at once: totals by year (JOB-9)."""
    return J.trafficking_sheet(sheets_to_long(_wide_sheets(spark, sf))[0])["por_anio"]
