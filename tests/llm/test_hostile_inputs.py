"""Every operator and stage on hostile tables: extra columns with clashing names, no rows, nulls, very long texts."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from judicata.llm import chat, line_dedup, mixing, ngram_join, packing, queries, repetition, sharding, substring_dedup, toxicity

#: Names that the operators use inside or give their results.
NAMES = ("id txt cls n grams doc drop rest lines n_lines n_dropped kept_text _kept _lines _dropped _row _rest _ _key _u _b _base _cut _at "
         "_more _size _id _pattern _copies _copy copies size position parent_turn n_quoted conv own_text anchor mid lvl seed learned capitals "
         "label toxic predicted score shard slot piece start length places hot component_id n_shingles n_words count").split()


def texts():
    r = random.Random(3)
    pool = [f"w{i}" for i in range(300)]
    out = [None, "", " \n\t", "you IDIOT moron!", "> quoted line of text\nanswer"]
    for _ in range(20):
        t = [r.choice(pool) for _ in range(60)]
        out += [" ".join(t), " ".join(t[:30]) + "\nthis is a line that many texts share\n" + " ".join(t[30:])]
    return out + out[:8]


@pytest.fixture(scope="module")
def plain(spark):
    rows = [(i if i != 7 else None, t, ("a", "b", None)[i % 3], len(t or "")) for i, t in enumerate(texts())]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long").repartition(3)


def hostile(df):
    return df.select("*", *[F.lit(f"{c}!").alias(c) for c in NAMES if c not in df.columns])


def rows_of(df, columns=None):
    return sorted(map(repr, df.select(*(columns or df.columns)).collect()))


OPERATORS = {
    "substring": lambda d: substring_dedup.substring_dedup(d)[1],
    "repetition": lambda d: repetition.quality_rules(repetition.repetition_features(d)),
    "ngram": ngram_join.ngram_jaccard_join,
    "lines": line_dedup.line_dedup,
    "sharding": lambda d: sharding.shard_documents(d, [1.0] * 5),
    "mixing": lambda d: mixing.mix(d, F.array("source"), mixing.word_count(F.col("text")))[0],
    "packing": packing.pack,
    "chat": lambda d: chat.reply_ordered(d.withColumns({"conv_id": F.lit(1), "turn": F.col("doc_id")})).drop("position"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_clashing_names_and_no_rows(spark, plain, name):
    run = OPERATORS[name]
    want, got = run(plain), run(hostile(plain))
    assert len(set(got.columns)) == len(got.columns)
    assert rows_of(got, want.columns) == rows_of(want)
    for c in set(got.columns) - set(want.columns):
        assert c in NAMES and {r[0] for r in got.select(c).distinct().collect()} == {f"{c}!"}
    assert run(hostile(plain).where("false")).count() == 0


@pytest.mark.parametrize("stage", [s for s, _ in corpus_pipeline.STAGES if s != "toxicity"])
def test_stages_keep_columns_of_any_name(spark, plain, stage):
    run = dict(corpus_pipeline.STAGES)[stage]
    want, got = run(spark, plain, ""), run(spark, hostile(plain), "")
    assert rows_of(got, want.columns) == rows_of(want)
    if stage != "packing":
        assert got.columns == hostile(plain).columns
        assert got.where(" or ".join(f"`{c}` is null or `{c}` <> '{c}!'" for c in NAMES)).count() == 0
    assert run(spark, hostile(plain).where("false"), "").count() == 0


def test_toxicity_stage_keeps_columns_of_any_name(spark, tmp_path, plain):
    labels = [(i, int(i % 2)) for i in range(0, 40)]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    run = dict(corpus_pipeline.STAGES)["toxicity"]
    want, got = run(spark, plain, str(tmp_path)), run(spark, hostile(plain), str(tmp_path))
    assert got.columns == hostile(plain).columns and rows_of(got, plain.columns) == rows_of(want)
    assert run(spark, hostile(plain).where("false"), str(tmp_path)).count() == 0


def test_very_long_text(spark):
    r = random.Random(5)
    half = [f"w{r.randrange(50_000)}" for _ in range(200_000)]
    words = half + half                        # every window of the second half occurs before
    text = "\n".join(" ".join(words[k:k + 50]) for k in range(0, len(words), 50))
    docs = spark.createDataFrame([(1, text, "a"), (2, "short text", "b")], "doc_id long, text string, source string")
    (_, cut) = substring_dedup.substring_dedup(docs)
    assert [(x.id, x.n_words, x.n_removed) for x in cut.collect()] == [(1, 400_000, 200_000)]
    x = repetition.quality_rules(repetition.repetition_features(docs)).where("doc_id = 1").first()
    assert (x.n_words, x.n_repeat_words, x.kept) == (400_000, 400_000, False)
    assert ngram_join.ngram_jaccard_join(docs).where("id = 1").first().n_shingles == len({tuple(words[k:k + 5]) for k in range(len(words) - 4)})
    assert line_dedup.line_dedup(docs).where("doc_id = 1").first().n_lines == 8000
    pieces = packing.pack(docs).where("doc_id = 1").agg(F.sum("length"), F.max("length"), F.count("*")).first()
    assert pieces[0] > 400_000 and pieces[1] == 1024 and pieces[2] == -(-pieces[0] // 1024)
    assert len(toxicity.describe(text, frozenset())) == len(toxicity.FEATURES)
    assert sharding.shard_documents(docs, [1.0] * 3).where("doc_id = 1").first().size == len(text) + 16
    assert queries.QUERIES
