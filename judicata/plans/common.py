"""Shared building blocks of the plans: the case frame and its SQL twin.

Analogue mapping of the driver tables: case = order, filing date =
``o_orderdate``, resolution date = ``l_shipdate``, court = customer nation,
department = region, judge = supplier, status F = resolved and O/P = pending,
process type = ``o_orderpriority``, speciality = ``c_mktsegment``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from judicata.functions import metrics as M
from judicata.tables import Tables

AS_OF = "2001-12-31"          # fixed as-of date for ages (never current_date)


def dim(df: DataFrame) -> DataFrame:
    """Broadcast hint for fixed-domain dimensions only (nation: 25 rows,
    region: 5).  Their size is bounded by the territory, not by the data;
    data-derived sides are left to AQE's measured-size conversion."""
    return F.broadcast(df)


def cases(spark: SparkSession, sf: str) -> DataFrame:
    t = Tables(spark, sf)
    o = t.orders("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    c = t.customer("c_custkey", "c_nationkey", "c_mktsegment")
    n = dim(t.nation("n_nationkey", "n_name", "n_regionkey"))
    x = o.join(c, o.o_custkey == c.c_custkey, "left").join(n, c.c_nationkey == n.n_nationkey, "left")
    return x.select(
        "o_orderkey", "o_orderdate",
        F.year("o_orderdate").cast("int").alias("anio"),
        F.month("o_orderdate").cast("int").alias("mes"),
        F.col("n_name").alias("corte"), "n_regionkey",
        F.col("c_mktsegment").alias("especialidad"),
        F.col("o_orderpriority").alias("tipo"),
        F.col("o_orderstatus").alias("estado"))


def flow_aggs():
    e = F.col("estado")
    return [F.count(F.lit(1)).alias("ingresos"),
            F.count_if(e == "F").alias("resueltos"),
            F.count_if(e.isin("O", "P")).alias("pendientes")]


def flow_sums():
    """Re-aggregation of pre-aggregated flows (sum of partial counts)."""
    return [F.sum(c).cast("bigint").alias(c) for c in ("ingresos", "resueltos", "pendientes")]


def with_indicators(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "clearance_pct": M.clearance_pct("resueltos", "ingresos"),
        "congestion": M.congestion("pendientes", "ingresos", "resueltos"),
        "mora": M.backlog_ratio("pendientes", "resueltos"),
        "activos": M.active_cases("pendientes", "ingresos", "resueltos"),
    })


def case_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Case x resolution line with the delay in days (may be negative)."""
    t = Tables(spark, sf)
    l = t.lineitem("l_orderkey", "l_linenumber", "l_shipdate")
    c = cases(spark, sf)
    x = c.join(l, c.o_orderkey == l.l_orderkey, "inner")
    return x.withColumn("dias", F.datediff(F.to_date("l_shipdate"), F.to_date("o_orderdate")))


CASES_SQL = """
cases AS (
  SELECT o.o_orderkey, o.o_orderdate,
         CAST(year(o.o_orderdate) AS INTEGER) AS anio, CAST(month(o.o_orderdate) AS INTEGER) AS mes,
         n.n_name AS corte, n.n_regionkey, c.c_mktsegment AS especialidad,
         o.o_orderpriority AS tipo, o.o_orderstatus AS estado
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

CASE_LINES_SQL = CASES_SQL + """,
case_lines AS (
  SELECT cs.*, l.l_linenumber, l.l_shipdate,
         CAST(date_diff('day', CAST(cs.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS INTEGER) AS dias
  FROM cases cs JOIN lineitem l ON cs.o_orderkey = l.l_orderkey)"""

FLOW_SQL = """COUNT(*) AS ingresos,
       COUNT(*) FILTER (WHERE estado = 'F') AS resueltos,
       COUNT(*) FILTER (WHERE estado IN ('O', 'P')) AS pendientes"""

IND_SQL = """100.0::DOUBLE * resueltos / NULLIF(ingresos, 0)::DOUBLE AS clearance_pct,
       (pendientes + ingresos)::DOUBLE / NULLIF(resueltos, 0)::DOUBLE AS congestion,
       pendientes::DOUBLE / NULLIF(pendientes + resueltos, 0)::DOUBLE AS mora,
       pendientes + ingresos - resueltos AS activos"""
