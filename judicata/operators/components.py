"""Connected components of an edge table by alternating stars.

Large star links every larger neighbour of a node to its smallest neighbour,
small star every smaller one; both keep connectivity and converge to one star
per component in a logarithmic number of rounds.  The smallest neighbour is an
aggregate with map-side combine and the join back can be split where a node has
very many edges; every round is written to the shared folder, which cuts
lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from judicata.session import materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (a, b): to all rows (v, smallest neighbour) of the larger (or smaller) neighbours."""
    sym = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        sym = sym.where(F.col("b") < F.col("a"))
    least = sym.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    j = sym.join(least, "a")
    if large:
        out = j.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = j.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node of its component, for every node with an edge."""
    e = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    e = materialise(e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    last = None
    while True:
        now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("b") % 1_000_003)).first()
        if now == last:
            break
        last = now
        e = materialise(_star(_star(e, True), False))
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
