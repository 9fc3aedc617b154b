"""Text and messy-value family: longest-prefix taxonomy (JN-7), label recovery
from corrupt lines (§2.11, JOB-11), tolerant numbers (PRJ-1/2), mixed-format
cut-off dates (PRJ-6), search and facets (FLT-12/13), union of shapes (SET-2),
privacy projection (PRJ-7), JSON properties (§2.11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from judicata.functions import dates as D
from judicata.functions import numbers as NUM
from judicata.functions.text import letters_key, recover_tail, search_match
from judicata.operators import clean as C
from judicata.operators import sets as S
from judicata.operators.match import CRIME_TITLES, prefix_classify
from judicata.plans import register
from judicata.tables import Tables, balance

# Analogue taxonomy of part descriptions; keys share prefixes on
# purpose so that the longest key must win.
PART_TAXONOMY = ["ECONOMY", "ECONOMY SMALL", "LARGE", "LARGE RED", "MEDIUM", "PROMO", "PROMO HOT",
                 "SMALL", "STANDARD", "STANDARD BLUE"]
UNCLASSIFIED = "SIN CLASIFICAR"


def _letters_sql(x: str) -> str:
    return f"regexp_replace(upper(strip_accents({x})), '[^A-Z]', '', 'g')"


_TAX_VALUES = ", ".join(f"('{k}')" for k in PART_TAXONOMY)


@register("prefix_taxonomy", sql=f"""
WITH p AS (SELECT p_partkey, p_retailprice, {_letters_sql("p_type || ' ' || p_name")} AS t FROM part),
k AS (SELECT label, {_letters_sql("label")} AS key FROM (VALUES {_TAX_VALUES}) v(label)),
m AS (SELECT p.p_partkey, p.p_retailprice, k.label,
             row_number() OVER (PARTITION BY p.p_partkey ORDER BY length(k.key) DESC) AS rn
      FROM p LEFT JOIN k ON starts_with(p.t, k.key)),
b AS (SELECT p_partkey, p_retailprice, COALESCE(label, '{UNCLASSIFIED}') AS categoria FROM m WHERE rn = 1)
SELECT categoria, COUNT(*) AS n, CAST(sum(CAST(p_retailprice AS DECIMAL(8, 2))) AS DOUBLE) AS precio_total
FROM b GROUP BY categoria
""")
def prefix_taxonomy(spark, sf):
    """Longest-prefix taxonomy match of part descriptions, letters-only (JN-7, PRJ-9).

    The ~10 keys are compiled into one CASE chain (longest first): a map-side
    expression, no theta join, nothing to broadcast."""
    p = Tables(spark, sf).part("p_partkey", "p_type", "p_name", "p_retailprice")
    cat = prefix_classify(F.concat_ws(" ", "p_type", "p_name"), PART_TAXONOMY)
    b = p.select(F.coalesce(cat, F.lit(UNCLASSIFIED)).alias("categoria"), "p_retailprice")
    return b.groupBy("categoria").agg(F.count(F.lit(1)).alias("n"),
                                      F.sum(F.col("p_retailprice").cast("decimal(8,2)")).cast("double").alias("precio_total"))


_RAW_PART = ("concat('X', p_brand, CASE WHEN p_partkey % 10 = 0 THEN ' ' ELSE ' DELITO ' END, p_type, ' ', replace(upper(p_name), ' ', '|'), ' ', "
             "repeat('Z', CAST(p_size AS INTEGER)))")


@register("fuzzy_text_recover", sql=f"""
WITH r AS (SELECT p_partkey, {_RAW_PART} AS raw FROM part),
t AS (SELECT p_partkey, regexp_extract(raw, '(DELITOS?\\s[\\s\\S]*)', 1) AS tail FROM r)
SELECT p_partkey, CASE WHEN tail <> '' THEN replace(substring(tail, 1, 70), '|', '') END AS recuperado,
       CASE WHEN tail <> '' THEN {_letters_sql("replace(substring(tail, 1, 70), '|', '')")} END AS clave
FROM t
""")
def fuzzy_text_recover(spark, sf):
    """Recover a label from a corrupt line (spurious pipes, trailing junk): from
    the anchor ``DELITOS?\\s`` take 70 characters, then remove pipes, then key it."""
    p = Tables(spark, sf).part("p_partkey", "p_brand", "p_type", "p_name", "p_size")
    anchor = F.when(F.col("p_partkey") % 10 == 0, F.lit(" ")).otherwise(F.lit(" DELITO "))
    raw = F.concat(F.lit("X"), F.col("p_brand"), anchor, F.col("p_type"), F.lit(" "),
                   F.replace(F.upper("p_name"), F.lit(" "), F.lit("|")), F.lit(" "),
                   F.repeat(F.lit("Z"), F.col("p_size").cast("int")))
    rec = recover_tail(raw)
    return p.select("p_partkey", rec.alias("recuperado"), F.when(rec.isNotNull(), letters_key(rec)).alias("clave"))


@register("crime_lines_taxonomy", sql=f"""
WITH l AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents),
t AS (SELECT line, regexp_extract(line, '(DELITOS?\\s[\\s\\S]*)', 1) AS tail FROM l),
k AS (SELECT label, {_letters_sql("label")} AS key
      FROM (VALUES {", ".join(f"('{c}')" for c in CRIME_TITLES)}) v(label)),
c AS (SELECT t.tail, k.label, row_number() OVER (PARTITION BY t.rowid ORDER BY length(k.key) DESC) AS rn
      FROM (SELECT row_number() OVER () AS rowid, tail,
                   {_letters_sql("replace(substring(tail, 1, 70), '|', '')")} AS key FROM t WHERE tail <> '') t
      LEFT JOIN k ON starts_with(t.key, k.key))
SELECT 'lineas' AS medida, COUNT(*) AS n FROM l
UNION ALL SELECT 'con_delito', COUNT(*) FROM t WHERE tail <> ''
UNION ALL SELECT 'sin_clasificar', COUNT(*) FROM c WHERE rn = 1 AND label IS NULL
UNION ALL SELECT label, COUNT(*) FROM c WHERE rn = 1 AND label IS NOT NULL GROUP BY label
""")
def crime_lines_taxonomy(spark, sf):
    """Police-report style line scan over whole documents (JOB-11, AGG-16): every
    line is searched for the crime anchor, the label is recovered (70 chars,
    pipes out) and matched to the fixed crime-title taxonomy, longest first.
    Counts: lines, lines with the anchor, unclassified, and one row per title."""
    d = balance(Tables(spark, sf).documents("text"))
    lines = d.select(F.explode(F.split(F.col("text"), "\n")).alias("line"))
    rec = recover_tail(F.col("line"))
    x = lines.select(rec.alias("rec")).select(F.col("rec").isNotNull().alias("has"),
                                              prefix_classify(F.col("rec"), CRIME_TITLES).alias("tipo"))
    # one pass over the text: both outputs below read this small aggregate
    g = x.groupBy("has", "tipo").agg(F.count(F.lit(1)).alias("n"))
    summary = g.agg(F.sum("n").cast("bigint").alias("lineas"),
                    F.coalesce(F.sum(F.when(F.col("has"), F.col("n"))), F.lit(0)).cast("bigint").alias("con_delito"),
                    F.coalesce(F.sum(F.when(F.col("has") & F.col("tipo").isNull(), F.col("n"))), F.lit(0))
                    .cast("bigint").alias("sin_clasificar"))
    summary = summary.unpivot([], ["lineas", "con_delito", "sin_clasificar"], "medida", "n")
    per_type = g.where(F.col("tipo").isNotNull()).groupBy(F.col("tipo").alias("medida")).agg(
        F.sum("n").cast("bigint").alias("n"))
    return summary.unionByName(per_type)


@register("tolerant_number", sql="""
WITH x AS (SELECT l_returnflag, l_linestatus,
                  CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'n/a'
                       ELSE CAST(l_quantity AS VARCHAR) END AS txt_plain,
                  format('{:,}', CAST(trunc(l_extendedprice) AS BIGINT)) AS txt_commas FROM lineitem)
SELECT l_returnflag, l_linestatus, COUNT(*) AS n,
       COUNT(TRY_CAST(trim(txt_plain) AS DOUBLE)) AS n_plain,
       sum(TRY_CAST(trim(txt_plain) AS DOUBLE)) AS sum_plain,
       COUNT(TRY_CAST(trim(txt_commas) AS DOUBLE)) AS n_commas_as_plain,
       sum(TRY_CAST(trim(replace(txt_commas, ',', '')) AS DOUBLE)) AS sum_commas
FROM x GROUP BY 1, 2
""")
def tolerant_number(spark, sf):
    """Numbers arriving as text (PRJ-1/2): junk gives null, never an exception;
    thousand separators defeat the plain parser and are removed by the comma parser."""
    li = balance(Tables(spark, sf).lineitem("l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice"))
    x = li.select("l_returnflag", "l_linestatus",
                  F.when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O"), F.lit("n/a"))
                  .otherwise(F.col("l_quantity").cast("string")).alias("txt_plain"),
                  F.format_number(F.col("l_extendedprice").cast("bigint"), 0).alias("txt_commas"))
    return x.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(NUM.tolerant_number("txt_plain")).alias("n_plain"),
        F.sum(NUM.tolerant_number("txt_plain")).alias("sum_plain"),
        F.count(NUM.tolerant_number("txt_commas")).alias("n_commas_as_plain"),
        F.sum(NUM.tolerant_number_commas("txt_commas")).alias("sum_commas"))


_DATE_TXT_SQL = """CASE o_orderpriority
      WHEN '1-URGENT' THEN strftime(o_orderdate, '%d/%m/%Y')
      WHEN '2-HIGH' THEN strftime(o_orderdate, '%Y%m%d')
      WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%Y-%m-%d')
      WHEN '4-NOT SPECIFIED' THEN CAST(year(o_orderdate) AS VARCHAR) || '-T' || CAST(quarter(o_orderdate) AS VARCHAR)
      ELSE strftime(o_orderdate, '%-d/%-m/%Y') END"""


@register("mixed_date_cutoff", sql=f"""
WITH x AS (SELECT o_orderpriority AS tipo, NULLIF(trim({_DATE_TXT_SQL}), '') AS v FROM orders)
SELECT tipo, COALESCE(strftime(max(try_strptime(v, '%d/%m/%Y')), '%Y-%m-%d'),
                      strftime(max(try_strptime(v, '%Y-%m-%d')), '%Y-%m-%d'),
                      strftime(max(try_strptime(v, '%Y%m%d')), '%Y-%m-%d'),
                      max(v)) AS fecha_corte
FROM x GROUP BY tipo
""")
def mixed_date_cutoff(spark, sf):
    """Cut-off date of a text column in mixed formats (PRJ-6): the first format
    under which any value parses gives the max; none parses -> lexical max."""
    o = balance(Tables(spark, sf).orders("o_orderpriority", "o_orderdate"))
    d = F.col("o_orderdate")
    txt = (F.when(F.col("o_orderpriority") == "1-URGENT", F.date_format(d, "dd/MM/yyyy"))
           .when(F.col("o_orderpriority") == "2-HIGH", F.date_format(d, "yyyyMMdd"))
           .when(F.col("o_orderpriority") == "3-MEDIUM", F.date_format(d, "yyyy-MM-dd"))
           .when(F.col("o_orderpriority") == "4-NOT SPECIFIED",
                 F.concat(F.year(d).cast("string"), F.lit("-T"), F.quarter(d).cast("string")))
           .otherwise(F.date_format(d, "d/M/yyyy")))
    return o.groupBy(F.col("o_orderpriority").alias("tipo")).agg(D.cutoff_agg(txt).alias("fecha_corte"))


SEARCH_Q = "9"
FACET_SEGMENTS = ("BUILDING", "MACHINERY")


@register("search_facets", sql=f"""
WITH m AS (SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer
           WHERE contains(lower(concat(c_name, c_mktsegment)), '{SEARCH_Q}')
             AND c_mktsegment IN {FACET_SEGMENTS} AND c_acctbal > 0)
SELECT *, (SELECT COUNT(*) FROM m) AS n_total FROM m ORDER BY c_custkey LIMIT 250
""")
def search_facets(spark, sf):
    """Case-insensitive search over concatenated columns (FLT-12) with facet filters
    (FLT-13); the first 250 by key are shown with the total match count (TOP-4)."""
    c = Tables(spark, sf).customer("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    m = c.where(search_match(["c_name", "c_mktsegment"], SEARCH_Q)
                & F.col("c_mktsegment").isin(*FACET_SEGMENTS) & (F.col("c_acctbal") > 0))
    total = m.select(F.count(F.lit(1))).scalar()
    return m.orderBy("c_custkey").limit(250).withColumn("n_total", total)


@register("union_shapes", sql="""
SELECT 'Proveedor: ' || s_name AS etiqueta, s_nationkey AS nacion, s_acctbal AS saldo FROM supplier
UNION ALL
SELECT 'Cliente: ' || c_name, c_nationkey, c_acctbal FROM customer
""")
def union_shapes(spark, sf):
    """Two result shapes projected to one schema with a source prefix (SET-2, SET-1)."""
    t = Tables(spark, sf)
    return S.union_shapes([
        ("Proveedor", t.supplier("s_name", "s_nationkey", "s_acctbal"),
         {"etiqueta": "s_name", "nacion": "s_nationkey", "saldo": "s_acctbal"}),
        ("Cliente", t.customer("c_name", "c_nationkey", "c_acctbal"),
         {"etiqueta": "c_name", "nacion": "c_nationkey", "saldo": "c_acctbal"}),
    ])


@register("privacy_projection", sql="""
SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer
""")
def privacy_projection(spark, sf):
    """Personal columns dropped before anything else (PRJ-7); here the customer
    name is declared personal in addition to the fixed list."""
    c = Tables(spark, sf).customer()
    return C.drop_private(c, extra=["c_name"])


@register("json_props", sql="""
WITH x AS (SELECT event_type, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
SELECT event_type, COUNT(*) AS n, COUNT(k) AS n_k, sum(k)::BIGINT AS sum_k, avg(k) AS avg_k, max(k) AS max_k
FROM x GROUP BY event_type
""")
def json_props(spark, sf):
    """A typed field pulled from a JSON text column and aggregated (§2.11 JSON)."""
    e = Tables(spark, sf).events("event_type", "props")
    k = F.get_json_object("props", "$.k").try_cast("int")
    x = e.select("event_type", k.alias("k"))
    return x.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count("k").alias("n_k"),
                                       F.sum("k").cast("bigint").alias("sum_k"), F.avg("k").alias("avg_k"),
                                       F.max("k").alias("max_k"))
