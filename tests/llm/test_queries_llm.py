"""Registered training-data queries against DuckDB, and the classifier and pipeline on driver tables."""

import duckdb
import pytest

import corpus_pipeline
from judicata.llm import queries, toxicity
from tools.oracle_check import TABLES, digest

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    cur = con.execute(queries.ORACLE[name])
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest([d[0] for d in cur.description], cur.fetchall())[0]


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.01"
    out = queries.QUERIES["op7_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    rows = out.where("held_out").collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert sum(r.predicted == r.toxic for r in rows) >= 0.9 * len(rows)


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "you idiot"), (2, None), (3, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, None)], "doc_id long, toxic int")
    got = {r.doc_id: r.predicted for r in toxicity.fit(docs, labels).score(docs, ["doc_id"]).collect()}
    assert got == {1: 1, 2: 0, 3: 0}


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        if name == "toxicity":
            assert 0.8 * n <= out.count() < n
        if name == "line_dedup":
            assert out.count() == docs.count()
        if name == "ngram_join":
            assert out.select("doc_id").distinct().count() == out.count() < docs.count()
        if name == "mixing":
            assert out.groupBy("doc_id").count().agg({"count": "max"}).first()[0] == 2
        docs = corpus_pipeline.materialise(out)
    packed = corpus_pipeline.pack_sequences(spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
