"""Remaining jobs, sources, sinks, streams, formulas and models."""

import os

from pyspark.sql import functions as F

from judicata import catalog, jobs as J, sinks
from judicata.functions import classify as K
from judicata.functions import metrics as M
from judicata.sources import catalogue as CAT
from judicata.sources import files as FI
from judicata.sources.registry import source_registry


def frame(spark, cols, rows):
    return spark.createDataFrame([tuple(None if v is None else str(v) for v in r) for r in rows],
                                 ", ".join(f"`{c}` string" for c in cols))


def test_flow_jobs(spark):
    # covers: JOB-3 JOB-7 PRJ-5 FLT-7 IND-1
    cols = ["anio", "distrito_fiscal", "materia", "ingresado", "atendido", "Fecha_descarga"]
    rows = [(2023, "LIMA", "PENAL", 10, 5, "bad"), (2024, "LIMA", "PENAL", 20, 10, "4/1/2025"),
            (2024, "PIURA", "CIVIL", 5, None, "15/02/2025"), (2024, "PIURA", "CIVIL", -1, 0, None)]
    out = J.flow_by_year(frame(spark, cols, rows))
    y = {r.anio: (r.ingresado, r.atendido, r.clearance) for r in out["por_anio"].collect()}
    assert y[2023] == (10, 5, 50.0) and y[2024][:2] == (25, 10)
    assert {r.materia for r in out["reciente_por_materia"].collect()} == {"PENAL", "CIVIL"}
    assert out["meta"].first().fecha_corte == "2025-02-15"
    assert [r.distrito_fiscal for r in out["top_distrito"].collect()] == ["LIMA", "PIURA"]


def test_counted_reports(spark):
    # covers: JOB-4 JOB-8 PRJ-11 TOP-1
    cols = ["anio_denuncia", "dpto_pjfs", "generico", "cantidad"]
    rows = [(2020, "LIMA", "HURTO", 5), (2020, "PIURA", "ROBO", 7), (2021, "LIMA", "HURTO", 1), (2030, "LIMA", "X", 9)]
    out = J.counted_reports(frame(spark, cols, rows))
    assert out["total"].first().total == 13
    assert [(r.generico, r.cantidad_n) for r in out["top_tipos"].collect()] == [("ROBO", 7.0), ("HURTO", 6.0)]
    ciber = J.counted_reports(frame(spark, ["anio", "des_articulo", "cantidad"], [(2020, "FRAUDE", 3)]))
    assert ciber["top_tipos"].first().des_articulo == "FRAUDE"


def test_trafficking_job(spark):
    # covers: JOB-9 AGG-12
    long = spark.createDataFrame([("Lima", 2019, 5.0), ("Piura", 2020, 3.0), ("Piura", 2021, 2.0)],
                                 "distrito string, anio int, valor double")
    out = J.trafficking_sheet(long)
    assert out["total"].first().total == 10.0 and out["por_distrito"].first().distrito == "Lima"   # 5 vs 5: key tie-break


def test_parquet_merge_and_unify(spark, tmp_path):
    # covers: SRC-5
    spark.createDataFrame([("12", "A")], "DIAS string, MATERIA string").write.parquet(str(tmp_path / "p" / "a"))
    spark.createDataFrame([(30, "B")], "dias_n int, materia2 string").withColumnRenamed("dias_n", "dias2") \
        .write.parquet(str(tmp_path / "p" / "b"))
    df = FI.read_parquet_merged(spark, [str(tmp_path / "p" / "a"), str(tmp_path / "p" / "b")],
                                unify={"dias": ["DIAS", "dias2"]}, cast={"dias": "int"})
    assert sorted(r.dias for r in df.collect()) == [12, 30] and "DIAS" not in df.columns


def test_landed_files_and_registry(spark, tmp_path):
    # covers: SRC-10 SRC-14
    for n in ("a.csv", "b.csv"):
        (tmp_path / n).write_text("x\n1\n")
    listed = spark.createDataFrame([(f"file:{tmp_path}/a.csv",)], "path string")
    got = CAT.landed_files(spark, listed, str(tmp_path), "*.csv")
    assert got.count() == 2
    assert source_registry(spark).count() == 5


def test_star_and_csv_export(spark, tmp_path):
    # covers: SNK-6 SNK-7
    made = catalog.create_star(spark)
    assert "expediente" in made and spark.table("expediente").count() == 0
    sinks.export_csv(spark.range(3), str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 3


def test_flags_and_reasons(spark):
    # covers: PRJ-19 PRJ-28 FLT-9 FLT-14
    df = spark.createDataFrame([("Crimen Organizado",), ("Penal",), ("Civil",)], "e string")
    assert [r[0] for r in df.select(K.speciality_flag("e")).collect()] == ["red", "amber", None]
    mv = spark.createDataFrame([("Traslado por necesidad",), ("RATIFICACIÓN",), ("x",)], "m string")
    assert [r[0] for r in mv.select(K.move_reason("m")).collect()] == ["TRASLADO", "RATIFICACION", "OTRO"]
    tidy = spark.createDataFrame([(1, 5.0), (2, 0.0), (3, 4.0)], "mes_n int, pendientes double")
    assert J.stock_outside_january(tidy).first().violaciones == 1
    years = spark.createDataFrame([(2024,), (2025,), (2026,)], "anio int")
    assert years.where(F.col("anio") < 2026).agg(F.max("anio")).first()[0] == 2025


def test_indicator_formulas(spark):
    # covers: IND-4 IND-5 IND-6 IND-7 IND-8 IND-9 IND-10 IND-11 IND-12 IND-13 IND-17 IND-18 IND-19
    df = spark.createDataFrame([(100, 80, 50, 4, 20.0, 10, 5, 0.5, 200.0)],
                               "ing long, res long, pend long, jueces long, pob double, apel long, sent long, mae double, cap double")
    r = df.select(M.load_per_judge("ing", "jueces").alias("a"), M.per_thousand("ing", "pob").alias("b"),
                  M.active_cases("pend", "ing", "res").alias("c"), M.caseload("pend", "ing").alias("d"),
                  M.pending_rate_pct("pend", M.caseload("pend", "ing")).alias("e"),
                  M.disposition_time("pend", "res").alias("f"), M.productivity("res", "jueces").alias("g"),
                  M.saturation(M.caseload("pend", "ing"), "cap").alias("h"), M.appeal_rate("apel", "sent").alias("i"),
                  M.share("res", "ing").alias("j"), M.model_lift("mae", F.lit(1.0)).alias("k"),
                  M.budget_execution("res", "ing").alias("l")).first()
    assert (r.a, r.b, r.c, r.d) == (25.0, 5.0, 70, 150)
    assert abs(r.e - 100 * 50 / 150) < 1e-12 and abs(r.f - 365 * 50 / 80) < 1e-12
    assert (r.g, r.h, r.i, r.j, r.k, r.l) == (20.0, 0.75, 2.0, 0.8, 0.5, 0.8)


def test_snapshot_stream(spark, tmp_path):
    # covers: STR-3 SRC-11 SNK-3
    from judicata.streaming.snapshots import read_current, read_manifest, start_snapshot_stream
    schema = "dataset string, snapshot string, anio int, casos long"
    src = tmp_path / "in"
    spark.createDataFrame([("casos", "2025-06", 2024, 10), ("casos", "2025-12", 2024, 12), ("fem", "2025-01", 2024, 3)],
                          schema).coalesce(1).write.parquet(str(src / "batch1"))
    q = start_snapshot_stream(spark, str(src), schema, str(tmp_path / "out"), str(tmp_path / "manifest"),
                              str(tmp_path / "ckpt"))
    q.awaitTermination(300)
    state = (str(tmp_path / "out"), str(tmp_path / "manifest"))
    out = read_current(spark, *state, schema)
    assert {(r.dataset, r.snapshot) for r in out.collect()} == {("casos", "2025-12"), ("fem", "2025-01")}
    man = {r.id: r.n_registros for r in read_manifest(spark, state[1]).collect()}
    assert man == {"casos": 1, "fem": 1}
    # an older snapshot that arrives late replaces nothing, a newer one does
    spark.createDataFrame([("casos", "2025-03", 2024, 7), ("fem", "2025-02", 2024, 4)],
                          schema).coalesce(1).write.parquet(str(src / "batch2"))
    start_snapshot_stream(spark, str(src), schema, *state, str(tmp_path / "ckpt")).awaitTermination(300)
    out = read_current(spark, *state, schema)
    assert {(r.dataset, r.snapshot) for r in out.collect()} == {("casos", "2025-12"), ("fem", "2025-02")}
    man = {r.id: r.fecha_corte for r in read_manifest(spark, state[1]).collect()}
    assert man == {"casos": "2025-12", "fem": "2025-02"}


def test_snapshot_commit_is_one_step(spark, tmp_path):
    # covers: STR-3
    import pytest
    from judicata.streaming import snapshots as SN
    schema = "dataset string, snapshot string, casos long"
    at, man = str(tmp_path / "out"), str(tmp_path / "manifest")
    frames = [spark.createDataFrame(rows, schema) for rows in (
        [("a", "2025-01", 1), ("a", "2025-01", 2), ("b", "2025-01", 3)], [("a", "2025-02", 4), ("c", "2025-01", 5)], [("b", "2024-01", 9)])]

    def state():
        return (sorted(tuple(r) for r in SN.read_current(spark, at, man, schema).select("dataset", "snapshot", "casos").collect()),
                sorted(tuple(r) for r in SN.read_manifest(spark, man).collect()))

    def crash():
        raise RuntimeError("lost between slices and manifest")

    assert state() == ([], []) and SN.apply_snapshot_batch(frames[0], at, man, 0)
    before = state()
    with pytest.raises(RuntimeError):
        SN.apply_snapshot_batch(frames[1], at, man, 1, between=crash)
    assert state() == before                                    # new slices are there, nobody sees them
    (tmp_path / "manifest" / "batch=1").mkdir()                 # and a manifest that was begun does not count
    assert state() == before
    assert SN.apply_snapshot_batch(frames[1], at, man, 1)
    after = state()
    assert after[0] == [("a", "2025-02", 4), ("b", "2025-01", 3), ("c", "2025-01", 5)]
    assert not SN.apply_snapshot_batch(frames[1], at, man, 1) and state() == after      # replay of a committed batch
    assert SN.apply_snapshot_batch(frames[2], at, man, 2) and state() == after          # a late older snapshot
    assert SN.drop_superseded(spark, at, man, keep_versions=1) == [0, 1] and state() == after


def test_risk_and_appeal_models(spark):
    # covers: ML-8 ML-10
    from judicata.ml import delay_model as DM
    rows = [(i, i % 3, "A" if i % 2 else "B", float(i % 7), float((i * 37) % 500)) for i in range(400)]
    df = spark.createDataFrame(rows, "k long, ln int, cat string, x double, dias double")
    _, pred, auc = DM.risk_classifier(df, ["k", "ln"], ["cat"], ["x"], "dias", maxIter=3, maxDepth=2)
    assert 0.0 <= auc <= 1.0
    lab = df.withColumn("apelado", (F.col("dias") > 250).cast("double"))
    m = DM.appeal_model(lab, ["cat"], ["x"], "apelado")
    assert m.transform(lab).where("probability IS NULL").count() == 0


def test_features_quality_and_format(spark):
    # covers: JOB-14 FLT-5 PRJ-16 PRJ-17 JN-14 AGG-19 JOB-16 PRJ-22 PRJ-26 TOP-6
    from judicata.functions.provenance import with_provenance
    from judicata.operators.audit import standard_gap
    micro = frame(spark, ["DIAS", "MATERIA", "GENERICO", "PROVINCIA", "INSTANCIA", "MES", "DNI"],
                  [(999, None, "ROBO", "PIURA", "SALA PENAL", 202107, "1"), (0, "X", None, None, None, None, "2"),
                   (120, None, None, "SULLANA", "JUZGADO DE PAZ", 202113, "3")])
    f = J.delay_model_features(micro).collect()
    assert len(f) == 1 and f[0].instancia_tipo == "JUZGADO DE PAZ LETRADO" and f[0].mes_anio == 12 \
        and f[0].materia_f == "NA"
    org = spark.createDataFrame([("SALA", 90)], "tipo string, resueltos int")
    std = spark.createDataFrame([("SALA", 100)], "tipo string, estandar int")
    assert standard_gap(org, std, "tipo", "resueltos").first().brecha == -10
    man = spark.createDataFrame([("a", "x")], "id string, titulo string")
    mag = spark.createDataFrame([("a", 2020, 5.0), ("a", 2021, 7.0)], "id string, anio int, valor double")
    assert J.sources_quality(man, mag).first().magnitud == 12.0
    p = with_provenance(spark.range(1), "F", "2024-01", "expediente").first()
    assert (p.fuente, p.fecha_corte, p.granularidad) == ("F", "2024-01", "expediente")
    assert spark.range(1).select(sinks.formatted(F.lit(1234.5), 1, percent=True)).first()[0] == "1,234.5 %"
    years = spark.createDataFrame([(2021, 3), (2020, 9)], "anio int, n int")
    assert [r.anio for r in years.orderBy("anio").collect()] == [2020, 2021]


def test_cutoff_rules_per_source(spark):
    # covers: JOB-3 JOB-10 PRJ-5 PRJ-6
    cols = ["anio", "materia", "ingresado", "atendido", "fecha_corte"]
    rows = [(2023, "PENAL", 1, 1, "31/12/2023"), (2024, "PENAL", 2, 1, "20250131"), (2024, "CIVIL", 2, 1, "x")]
    out = J.flow_by_year(frame(spark, cols, rows), cutoff="fecha_corte")
    assert out["meta"].first().fecha_corte == "2025-01-31"          # latest year only; compact format
    vcols = ["AÑO", "DEPARTAMENTO", "CASOS ATENDIDOS TOTAL", "FECHA DE REPORTE"]
    v = J.violence_cases(frame(spark, vcols, [(2024, "LIMA", 3, "5/2/2025"), (2024, "PIURA", 1, "bad")]))
    assert v["meta"].first().fecha_corte == "2025-02-05"


def test_reports_meta_cutoff(spark):
    # covers: JOB-4 PRJ-6
    out = J.counted_reports(frame(spark, ["anio", "cantidad", "fecha_corte"], [(2020, 1, "01/02/2024"), (2021, 2, "03/04/2025")]))
    assert out["meta"].first().fecha_corte == "2025-04-03"
