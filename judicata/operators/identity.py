"""Identity resolution of people by name (SET-7).

Equal keys are one node.  Two keys within d edits share a string that is left of
each after at most d deleted letters, so nodes are joined on the hashes of these
strings, verified by edit distance, and every connected group is one person.  No
first letters and no representative are asked for, and a common surname is no
block: the shared strings are nearly whole names.  A key of n letters has about
n^d / d! such strings.

Nodes are told apart by 64 bits of a digest of the key.  Records without a name
stay on their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from judicata.functions.text import letters_key
from judicata.operators.components import components
from judicata.session import materialise

#: Names whose shortened strings one task makes.
NAMES_A_TASK = 20_000


def _deletions(key: Column, max_dist: int) -> Column:
    """Hashes of the key and of all that is left of it after up to ``max_dist`` deleted letters."""
    def shorter(left: Column) -> Column:
        some = F.filter(left, lambda v: F.length(v) > 0)
        return F.array_distinct(F.flatten(F.transform(some, lambda v: F.transform(
            F.sequence(F.lit(1), F.length(v)), lambda i: F.overlay(v, F.lit(""), i, F.lit(1))))))

    levels = [F.array(key)]
    for _ in range(max_dist):
        levels.append(shorter(levels[-1]))
    return F.transform(F.concat(*levels), lambda v: F.xxhash64(v))


def _shared(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of the two sides that hold the same shortened string.

    A plan's estimate of a side is the size of its names, of which it has hundreds of
    strings each, so the join is told to sort both sides and send neither through the driver."""
    return left.hint("merge").join(right.hint("merge"), "v")


def resolve_identities(df: DataFrame, id_col: str, name_col: str, max_dist: int = 2) -> DataFrame:
    """(id, cluster_id): records whose names are linked by steps of at most
    ``max_dist`` edits share the smallest id among them."""
    x = df.select(F.col(id_col).alias("id"), letters_key(F.col(name_col)).alias("clave"))
    nodes = materialise(x.where("clave IS NOT NULL").groupBy("clave").agg(F.min("id").alias("least"))
                        .select(F.xxhash64("clave").alias("node"), "clave", "least"))
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-nodes.count() // NAMES_A_TASK))
    left = nodes.repartition(tasks, "node").select("node", F.explode(_deletions(F.col("clave"), max_dist)).alias("v"))
    pairs = (_shared(left.select(F.col("node").alias("a"), "v"), left.select(F.col("node").alias("b"), "v"))
             .where("a < b").select("a", "b").distinct())
    # files of names are a fraction of the names' size in memory, so these are not left to the estimate either
    near = (pairs.join(nodes.select(F.col("node").alias("a"), F.col("clave").alias("ka")).hint("merge"), "a")
            .join(nodes.select(F.col("node").alias("b"), F.col("clave").alias("kb")).hint("merge"), "b")
            .where(F.levenshtein("ka", "kb") <= max_dist).select("a", "b"))
    owner = nodes.join(components(near), "node", "left").withColumn("root", F.coalesce("component", "node"))
    person = owner.groupBy("root").agg(F.min("least").alias("cluster_id"))
    named = owner.join(person, "root").select("clave", "cluster_id")
    return x.join(named, "clave", "left").select("id", F.coalesce("cluster_id", "id").alias("cluster_id"))


def match_names(left: DataFrame, right: DataFrame, code: str, name: str, max_dist: int = 2) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One-to-one crosswalk of two codings by name (JN-15): (pairs, only left, only right).

    ``pairs`` are (left_code, right_code, distance).  Candidates are names within ``max_dist``
    edits, found by their shared deletion strings.  In every round each code is joined to its nearest
    candidate (ties to the smaller codes), and codes that choose each other are matched and
    leave; the rounds end when no candidates are left, as each matches at least the nearest pair of all.
    A code without a partner, e.g. one side of a split territory, is left over."""
    def keyed(df: DataFrame, side: str) -> DataFrame:
        return df.select(F.col(code).alias(side), letters_key(F.col(name)).alias(f"{side}_key")).where(f"{side}_key IS NOT NULL")

    a, b = keyed(left, "left_code"), keyed(right, "right_code")
    va = a.select("left_code", "left_code_key", F.explode(_deletions(F.col("left_code_key"), max_dist)).alias("v"))
    vb = b.select("right_code", "right_code_key", F.explode(_deletions(F.col("right_code_key"), max_dist)).alias("v"))
    distance = F.levenshtein("left_code_key", "right_code_key")
    open_pairs = materialise(_shared(va, vb).select("left_code", "right_code", distance.alias("distance")).distinct()
                             .where(F.col("distance") <= max_dist))
    pairs = None
    while not open_pairs.isEmpty():
        best = F.min(F.struct("distance", "left_code", "right_code"))
        near_l = open_pairs.groupBy("left_code").agg(best.alias("b")).select("b.*")
        near_r = open_pairs.groupBy("right_code").agg(best.alias("b")).select("b.*")
        made = materialise(near_l.join(near_r, ["left_code", "right_code", "distance"]).select("left_code", "right_code", "distance"))
        pairs = made if pairs is None else pairs.unionByName(made)
        open_pairs = materialise(open_pairs.join(made.select("left_code"), "left_code", "left_anti")
                                 .join(made.select("right_code"), "right_code", "left_anti"))
    if pairs is None:
        pairs = open_pairs
    only_left = left.join(pairs.select(F.col("left_code").alias(code)), code, "left_anti").select(code, name)
    only_right = right.join(pairs.select(F.col("right_code").alias(code)), code, "left_anti").select(code, name)
    return pairs.select("left_code", "right_code", "distance"), only_left, only_right
