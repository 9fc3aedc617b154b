"""A corpus pipeline: five stages from raw documents to packed sequences.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet in the shared folder and read again as the next one's docs.
All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from judicata.llm import line_dedup as lines
from judicata.llm import mixing, ngram_join, packing, toxicity
from judicata.llm.common import documents, materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fitted classifier predicts toxic go."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.fit(docs, labels)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("text"))
    scored = model.score(rows, ["_row"]).where("predicted = 0")
    return scored.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one of them; n_chars follows the text."""
    rest = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("_row"), "doc_id", "text")
    out = lines.line_dedup(rows, out="_kept", n_lines="_lines", n_dropped="_dropped")
    new = {c: F.col(f"_row.`{c}`") for c in rest} | {"text": F.col("_kept")}
    if "n_chars" in new:
        new["n_chars"] = F.when(F.col("_dropped") > 0, F.char_length("_kept").cast("long")).otherwise(new["n_chars"])
    return out.select(*[new[c].alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near copies stays.

    An id may repeat: all different texts under a kept id stay, a text that
    repeats under its id stays once, with the least values of the other columns.
    Rows without an id stay."""
    kept = materialise(ngram_join.ngram_jaccard_join(docs).where("id = component_id").select("id"))
    known = docs.join(kept, docs["doc_id"] == kept["id"], "left_semi")
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    inner = [F.struct(*[F.col(f"`{c}`") for c in rest]).alias("inner")] if rest else []
    least = known.groupBy("doc_id", "text").agg(F.min(F.struct(F.lit(0).alias("any"), *inner)).alias("_rest"))
    once = least.select(*[F.col(f"_rest.inner.`{c}`").alias(c) if c in rest else F.col(c) for c in docs.columns])
    return once.unionByName(docs.where("doc_id IS NULL"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, not at all where it takes none."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "doc_id", "source",
                       mixing.word_count(F.col("text")).alias("_words"))
    mixed, _ = mixing.mix(rows, F.array("source"), F.col("_words"), copies_col="_copies", size_col="_size")
    mixed = mixed.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("_copies"))))
    return mixed.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and offset."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_common_lines),
    ("ngram_join", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Classifier and tokenizer have no SQL; the tests check the stages' columns and row counts, not their rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
