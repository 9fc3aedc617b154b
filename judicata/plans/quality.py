"""Quality family: primary keys (AUD-5), foreign keys (AUD-6), manifest upsert
(SNK-3), duplicate-feed detection (SET-8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from judicata.operators import audit as AU
from judicata.operators import sets as S
from judicata.plans import register
from judicata.sinks.manifest import upsert
from judicata.tables import Tables

PKS = [("orders", ["o_orderkey"]), ("lineitem", ["l_orderkey", "l_linenumber"]), ("customer", ["c_custkey"]),
       ("supplier", ["s_suppkey"]), ("part", ["p_partkey"]), ("nation", ["n_nationkey"]),
       ("region", ["r_regionkey"]), ("events", ["event_id"]), ("documents", ["doc_id"])]

FKS = [("lineitem.l_orderkey", "lineitem", "l_orderkey", "orders", "o_orderkey"),
       ("lineitem.l_partkey", "lineitem", "l_partkey", "part", "p_partkey"),
       ("lineitem.l_suppkey", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
       ("orders.o_custkey", "orders", "o_custkey", "customer", "c_custkey"),
       ("customer.c_nationkey", "customer", "c_nationkey", "nation", "n_nationkey"),
       ("supplier.s_nationkey", "supplier", "s_nationkey", "nation", "n_nationkey"),
       ("nation.n_regionkey", "nation", "n_regionkey", "region", "r_regionkey"),
       ("labels.doc_id", "labels", "doc_id", "documents", "doc_id"),
       ("part.p_partkey (as supplier)", "part", "p_partkey", "supplier", "s_suppkey")]     # orphans on purpose


def _pk_sql(t, cols):
    k = ", ".join(cols)
    return (f"SELECT '{t}' AS tabla, sum(c)::BIGINT AS n_rows, COUNT(*) AS n_keys, "
            f"COUNT(*) FILTER (WHERE c > 1) AS n_dup_keys, "
            f"COALESCE(sum(c) FILTER (WHERE c > 1), 0)::BIGINT AS n_dup_rows "
            f"FROM (SELECT {k}, COUNT(*) AS c FROM {t} GROUP BY {k})")


@register("pk_dupes", sql="\nUNION ALL\n".join(_pk_sql(t, c) for t, c in PKS))
def pk_dupes(spark, sf):
    """Primary-key uniqueness audit for every table with a declared key (AUD-5)."""
    t = Tables(spark, sf)
    out = None
    for name, cols in PKS:
        p = AU.pk_profile(getattr(t, name)(*cols), cols, name)
        out = p if out is None else out.unionByName(p)
    return out


def _fk_sql(name, child, fk, parent, pk):
    return (f"SELECT '{name}' AS fk, COUNT(*) AS n_child, "
            f"COUNT(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pk} = c.{fk})) AS n_orphans "
            f"FROM {child} c")


@register("fk_orphans", sql="\nUNION ALL\n".join(_fk_sql(*f) for f in FKS))
def fk_orphans(spark, sf):
    """Foreign-key coverage: child rows whose key has no parent (AUD-6)."""
    t = Tables(spark, sf)
    out = None
    for name, child, fk, parent, pk in FKS:
        j = AU.fk_orphans(getattr(t, child)(fk), fk, getattr(t, parent)(pk), pk, name)
        out = j if out is None else out.unionByName(j)
    return out


@register("manifest_upsert", sql="""
WITH old AS (SELECT 'region' AS id, COUNT(*) AS n_registros, 1 AS lote, 1 AS seq FROM region
             UNION ALL SELECT 'nation', COUNT(*), 1, 2 FROM nation
             UNION ALL SELECT 'customer', COUNT(*), 1, 3 FROM customer
             UNION ALL SELECT 'supplier', COUNT(*) FILTER (WHERE s_acctbal >= 0), 1, 4 FROM supplier),
new AS (SELECT 'supplier' AS id, COUNT(*) AS n_registros, 2 AS lote, 1 AS seq FROM supplier
        UNION ALL SELECT 'part', COUNT(*), 2, 2 FROM part
        UNION ALL SELECT 'orders', COUNT(*) FILTER (WHERE o_orderstatus IN ('O', 'P')), 2, 3 FROM orders
        UNION ALL SELECT 'orders', COUNT(*), 2, 4 FROM orders
        UNION ALL SELECT 'lineitem', COUNT(*), 2, 5 FROM lineitem),
nd AS (SELECT id, n_registros, lote, seq FROM
         (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn FROM new) WHERE rn = 1)
SELECT id, n_registros, lote, seq FROM old WHERE id NOT IN (SELECT id FROM nd)
UNION ALL SELECT id, n_registros, lote, seq FROM nd
""")
def manifest_upsert(spark, sf):
    """Dataset manifest upsert by id: new entries win, the rest are kept, and a
    duplicate id inside the new batch resolves to its last entry (SNK-3)."""
    t = Tables(spark, sf)

    def entry(df, id_, lote, seq, cond=None):
        d = df.where(cond) if cond is not None else df
        return d.agg(F.lit(id_).alias("id"), F.count(F.lit(1)).alias("n_registros"),
                     F.lit(lote).alias("lote"), F.lit(seq).alias("seq"))

    old = entry(t.region("r_regionkey"), "region", 1, 1)
    for e in [entry(t.nation("n_nationkey"), "nation", 1, 2), entry(t.customer("c_custkey"), "customer", 1, 3),
              entry(t.supplier("s_acctbal"), "supplier", 1, 4, F.col("s_acctbal") >= 0)]:
        old = old.unionByName(e)
    new = entry(t.supplier("s_suppkey"), "supplier", 2, 1)
    for e in [entry(t.part("p_partkey"), "part", 2, 2),
              entry(t.orders("o_orderstatus"), "orders", 2, 3, F.col("o_orderstatus").isin("O", "P")),
              entry(t.orders("o_orderkey"), "orders", 2, 4), entry(t.lineitem("l_orderkey"), "lineitem", 2, 5)]:
        new = new.unionByName(e)
    return upsert(old, new, "id", "seq")


@register("duplicate_feed", sql="""
WITH f AS (SELECT 'ordenes' AS dataset, CAST(year(o_orderdate) AS INTEGER) AS anio, COUNT(*) AS total FROM orders GROUP BY 2
           UNION ALL
           SELECT 'ordenes_con_lineas', CAST(year(o.o_orderdate) AS INTEGER), COUNT(DISTINCT l.l_orderkey)
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 2
           UNION ALL
           SELECT 'ordenes_resueltas', CAST(year(o_orderdate) AS INTEGER), COUNT(*) FROM orders
           WHERE o_orderstatus = 'F' GROUP BY 2
           UNION ALL
           SELECT 'ordenes_republicadas', CAST(year(o_orderdate) AS INTEGER), COUNT(*) FROM orders
           WHERE year(o_orderdate) % 2 = 0 OR o_orderkey % 2 = 0 GROUP BY 2
           UNION ALL
           SELECT 'lineas_despachadas', CAST(year(l_shipdate) AS INTEGER), COUNT(*) FROM lineitem GROUP BY 2)
SELECT a.anio, a.total, a.dataset AS dataset_a, b.dataset AS dataset_b
FROM f a JOIN f b ON a.anio = b.anio AND a.total = b.total AND a.dataset < b.dataset
""")
def duplicate_feed(spark, sf):
    """Datasets reporting the identical yearly total (a feed published twice, SET-8)."""
    t = Tables(spark, sf)
    o = t.orders("o_orderkey", "o_orderdate", "o_orderstatus")
    li = t.lineitem("l_orderkey", "l_shipdate")
    yo = F.year("o_orderdate").cast("int")
    # three feeds of one table in one aggregate; the even years of a feed are published again
    resolved, again = F.col("o_orderstatus") == "F", (F.year("o_orderdate") % 2 == 0) | (F.col("o_orderkey") % 2 == 0)
    counted = o.groupBy(yo.alias("anio")).agg(F.count(F.lit(1)).alias("ordenes"), F.count_if(resolved).alias("ordenes_resueltas"),
                                              F.count_if(again).alias("ordenes_republicadas"))
    feeds = counted.unpivot(["anio"], ["ordenes", "ordenes_resueltas", "ordenes_republicadas"], "dataset", "total").where("total > 0")
    with_lines = (li.select("l_orderkey").distinct().join(o.select("o_orderkey", yo.alias("anio")), F.col("l_orderkey") == F.col("o_orderkey"))
                  .groupBy("anio").agg(F.lit("ordenes_con_lineas").alias("dataset"), F.count(F.lit(1)).alias("total")))
    shipped = li.groupBy(F.year("l_shipdate").cast("int").alias("anio")).agg(F.lit("lineas_despachadas").alias("dataset"), F.count(F.lit(1)).alias("total"))
    allf = feeds.unionByName(with_lines).unionByName(shipped)
    return S.duplicate_feeds(allf, "dataset", "anio", "total").select("anio", "total", "dataset_a", "dataset_b")


@register("coverage_summary", sql="""
WITH d AS (SELECT 'ordenes' AS dataset, CAST(o_orderdate AS DATE) AS f FROM orders
           UNION ALL SELECT 'lineas', CAST(l_shipdate AS DATE) FROM lineitem
           UNION ALL SELECT 'eventos', CAST(ts AS DATE) FROM events),
p AS (SELECT dataset, CAST(min(year(f)) AS INTEGER) AS anio_min, CAST(max(year(f)) AS INTEGER) AS anio_max,
             COUNT(DISTINCT year(f)) AS n_anios, strftime(max(f), '%Y-%m-%d') AS fecha_corte FROM d GROUP BY dataset)
SELECT dataset, anio_min, anio_max, n_anios, fecha_corte,
       'Nacional, ' || anio_min || '-' || anio_max AS cobertura FROM p
UNION ALL
SELECT 'todos', CAST(min(year(f)) AS INTEGER), CAST(max(year(f)) AS INTEGER), COUNT(DISTINCT year(f)),
       strftime(max(f), '%Y-%m-%d'), 'Nacional, ' || min(year(f)) || '-' || max(year(f)) FROM d
""")
def coverage_summary(spark, sf):
    """Coverage per dataset (year range, distinct years, cut-off, coverage text)
    and across datasets: global max cut-off and the union of years (AGG-18, AGG-20, SET-3, PRJ-23)."""
    from judicata.functions.provenance import coverage_text
    t = Tables(spark, sf)
    d = (t.orders("o_orderdate").select(F.lit("ordenes").alias("dataset"), F.to_date("o_orderdate").alias("f"))
         .unionByName(t.lineitem("l_shipdate").select(F.lit("lineas").alias("dataset"), F.to_date("l_shipdate").alias("f")))
         .unionByName(t.events("ts").select(F.lit("eventos").alias("dataset"), F.to_date("ts").alias("f"))))
    y = F.year("f")
    aggs = [F.min(y).cast("int").alias("anio_min"), F.max(y).cast("int").alias("anio_max"),
            F.count_distinct(y).alias("n_anios"), F.date_format(F.max("f"), "yyyy-MM-dd").alias("fecha_corte")]
    per = d.groupBy("dataset").agg(*aggs)
    allr = d.agg(F.lit("todos").alias("dataset"), *aggs)
    out = per.unionByName(allr)
    return out.withColumn("cobertura", coverage_text("anio_min", "anio_max"))
