"""Every registered query against its DuckDB oracle on sf0.001 (the driver
runs the same comparison at sf0.01), plus the entry smoke check."""

import duckdb
import pytest

import __spark_entry__ as E
from judicata.plans import load_all
from tools.oracle_check import TABLES, digest

SF = "/root/testdata/sf0.001"
SLOW = {"delay_model_metrics", "delay_model_by_type"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry(spark):
    # covers: JOB-1
    df = E.entry(spark)
    assert df.count() > 0 and "congestion" in df.columns


def test_every_query_has_oracle_or_is_declared():
    q, o = load_all()
    assert set(q) <= set(E.queries()) and set(o) <= set(E.oracle_sql())
    assert set(o) <= set(q)
    assert set(q) - set(o) == {"delay_model_metrics", "delay_model_by_type"}


@pytest.mark.parametrize("name", sorted(load_all()[1]))
def test_query_matches_oracle(spark, con, name):
    # covers: every registered query
    sdf = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(sdf.columns, srows)[0] == digest(dcols, drows)[0]


def test_limiter_query_rows(spark):
    df = E.queries()["limiter_batch"](spark, SF)
    n_events = spark.read.parquet(f"{SF}/events.parquet").count()
    assert df.count() == n_events


def test_delay_model_small(spark):
    # covers: ML-1 ML-2 ML-3 ML-4 ML-5 ML-6 ML-7
    from judicata.ml import delay_model as DM
    from judicata.plans.model_q import CAT, NUM, _features
    df = _features(spark, SF)
    model, pred, m = DM.fit_and_score(df, ["o_orderkey", "l_linenumber"], CAT, NUM, "dias", maxIter=5)
    r = m.first()
    assert r.n_train > 0 and r.n_test > 0 and r.mae >= 0 and r.baseline_mae > 0
    fb = DM.median_by_group(pred, "tipo", "dias")
    scored = DM.score_with_fallback(model, df.limit(50), fb, "tipo")
    assert scored.where("prediccion IS NULL").count() == 0


@pytest.mark.parametrize("name", ["event_dedup", "topk_by_group", "stage_durations", "asof_assignment",
                                  "trailing_rate", "delay_histogram", "pending_age", "interval_join"])
def test_partition_count_independence(spark, name):
    # covers: SET-4 TOP-2 WIN-13 JN-10 STR-2 AGG-9 IND-15 JN-9 (1 vs 8 shuffle partitions give the same rows)
    fn = E.queries()[name]
    a = fn(spark, SF)
    da = digest(a.columns, [tuple(r) for r in a.collect()])[0]
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        b = fn(spark, SF)
        db = digest(b.columns, [tuple(r) for r in b.collect()])[0]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert da == db


def test_delay_model_rows_are_dealt_over_tasks(spark, monkeypatch):
    # covers: ML-4; boosting's rows per task do not follow from how many bytes a file holds of them
    from pyspark.ml.regression import GBTRegressor
    from pyspark.sql import functions as F

    from judicata.ml import delay_model as DM
    from judicata.plans.model_q import CAT, NUM, _features
    from judicata.session import materialise
    df = materialise(_features(spark, SF).coalesce(1))
    seen, fit = [], GBTRegressor._fit

    def spied(self, x):
        seen.append(x.groupBy(F.spark_partition_id().alias("p")).count().agg(F.count("p").alias("tasks"), F.max("count").alias("most"), F.sum("count").alias("rows")).first())
        return fit(self, x)

    monkeypatch.setattr(GBTRegressor, "_fit", spied)
    maes = []
    for rows in (10_000_000, 100):
        monkeypatch.setattr(DM, "ROWS_A_TASK", rows, raising=False)
        m = DM.fit_and_score(df, ["o_orderkey", "l_linenumber"], CAT, NUM, "dias", maxIter=2)[2].first()
        maes.append(m.mae)
        assert seen[-1].rows == m.n_train
    assert seen[0].tasks == 1 and seen[1].tasks >= seen[1].rows / 100 and seen[1].most < 200
    assert maes[0] == pytest.approx(maes[1], rel=1e-9)
