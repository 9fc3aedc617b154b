"""Line deduplication (native).

Lines are exploded with their position, normalised to a key, hashed to 128 bits
and counted by distinct document; keys held by too many documents lose their
lines everywhere but in one keeper document, and the rest is put together again
by position.

Defined cases: a null or empty text is one empty line; a line whose key is
shorter than ``min_chars`` code points is always kept; rows without a document
id keep all lines and count for nothing; rows that repeat a document id count
as one document, each keeps or loses its own lines; every other column of the
input passes through, whatever its name, but for those named like the three new
columns, which give way; an empty table gives no rows; the lines of a very long
text travel one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from judicata.llm.common import SPACES, lower_ascii, materialise


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(SPACES)))


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """(doc, txt, drop): positions that a row (document id, text hash) loses."""
    lines = (docs.where(F.col(id_col).isNotNull() & (F.char_length(text_col) >= min_chars))
             .select(F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("txt"),
                     F.posexplode(F.split(text_col, "\n", -1)).alias("pos", "line"))
             .withColumn("line", F.btrim("line", F.lit(SPACES)))
             .where(F.char_length("line") >= min_chars)
             .withColumn("line", lower_ascii(F.col("line"))))
    lines = materialise(lines.select("doc", "txt", "pos", F.xxhash64("line").alias("k1"),
                                     F.xxhash64(F.lit(1), "line").alias("k2")))
    # written, so that both sides of the join are plain shuffles: the rows of a very common line can then be split
    common = materialise(lines.groupBy("k1", "k2")
                         .agg(F.count_distinct("doc").alias("n"), F.max("doc").alias("keeper"))
                         .where(F.col("n") >= min_docs).select("k1", "k2", "keeper"))
    return (lines.join(common, ["k1", "k2"]).where(F.col("doc") != F.col("keeper"))
            .groupBy("doc", "txt").agg(F.collect_set("pos").alias("drop")))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_chars: int = 20, min_docs: int = 3, out: str = "kept_text",
               n_lines: str = "n_lines", n_dropped: str = "n_dropped") -> DataFrame:
    """The input's rows and columns plus the kept text and the two counts.

    The lines travel as an array, so that a kept position is looked up in
    constant time; the set of kept positions is a hash difference."""
    drops = dropped_lines(docs, id_col, text_col, min_chars, min_docs)
    through = [c for c in docs.columns if c not in (text_col, out, n_lines, n_dropped)]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in through]).alias("rest"),
                       F.col(text_col).isNull().alias("was_null"), F.xxhash64(text_col).alias("txt"),
                       F.split(F.coalesce(text_col, F.lit("")), "\n", -1).alias("lines"))
    rows = rows.withColumn("doc", F.col(f"rest.{id_col}"))
    j = rows.join(drops, ["doc", "txt"], "left")
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drop")),
                       lambda i: F.get(F.col("lines"), i))
    kept = F.array_join(F.when(F.col("drop").isNull(), F.col("lines")).otherwise(kept), "\n")
    new = j.select("rest", F.when(~F.col("was_null") | F.col("drop").isNotNull(), kept).alias("text"),
                   F.size("lines").cast("long").alias("all"), F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("gone"))
    return new.select(*[F.col(f"rest.`{c}`").alias(c) for c in through],
                      F.col("text").alias(out), F.col("all").alias(n_lines), F.col("gone").alias(n_dropped))
