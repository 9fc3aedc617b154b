"""Sinks and the remaining small operators."""

import json

from pyspark.sql import functions as F

from judicata import sinks
from judicata.functions.text import code_in_range, current_of, label, newest_first
from judicata.operators import audit as AU
from judicata.operators.identity import resolve_identities
from judicata.operators.match import dictionary_lookup
from judicata.operators.topk import count_by, sort_by


def test_tidy_roundtrip_and_latest_snapshot(spark, tmp_path):
    # covers: SNK-1 SNK-8 FLT-15
    df = spark.createDataFrame([(2023, 5), (2024, 7)], "anio int, n int")
    sinks.write_tidy(df, str(tmp_path / "t"), "fuente X", "2024-06", "agregado")
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.where("fuente IS NULL OR fecha_corte IS NULL").count() == 0 and back.count() == 2
    # re-writing one year replaces that partition only
    sinks.write_tidy(df.where("anio = 2024").withColumn("n", F.lit(9)), str(tmp_path / "t"), "fuente X", "2024-07", "agregado")
    got = {r.anio: r.n for r in spark.read.parquet(str(tmp_path / "t")).collect()}
    assert got == {2023: 5, 2024: 9}
    sinks.write_snapshot(df, str(tmp_path / "s"), "2024-01-31")
    sinks.write_snapshot(df.limit(1), str(tmp_path / "s"), "2024-02-29")
    assert sinks.latest_snapshot(spark, str(tmp_path / "s")).count() == 1


def test_contract_document(spark):
    # covers: SNK-2
    a = spark.createDataFrame([("LIMA", 3), ("PIURA", 1)], "d string, n int")
    doc = json.loads("".join(r.value for r in sinks.contract_document({"fuente": "x", "granularidad": "agregado"}, {"por_dep": a}).orderBy("section", "seq").collect()))
    assert doc["_meta"]["fuente"] == "x" and sorted(r["d"] for r in doc["por_dep"]) == ["LIMA", "PIURA"]


def test_present_rounding(spark):
    # covers: PRJ-24
    df = spark.createDataFrame([(44.55555, 3.914, 12.9)], "clearance double, congestion double, ingresos double")
    r = sinks.present(df, {"clearance": 1, "congestion": 2}, truncate=("ingresos",)).first()
    assert r.clearance == 44.6 and r.congestion == 3.91 and r.ingresos == 12


def test_olap_load(spark):
    # covers: SNK-4 JOB-13
    out = sinks.olap_load(spark, {"t_a": spark.range(3), "t_b": spark.range(5)})
    assert {r.tabla: r.n for r in out.collect()} == {"t_a": 3, "t_b": 5}


def test_small_helpers(spark):
    # covers: FLT-16 WIN-6 WIN-4 PRJ-27
    df = spark.createDataFrame([("X86", ["a", "b", "c"]), ("Y10", ["z"]), ("x99", [])], "code string, h array<string>")
    assert [r[0] for r in df.select(code_in_range("code", "X85", "Y09")).collect()] == [True, False, True]
    rows = df.select(newest_first("h").alias("n"), current_of("h").alias("c"), label("CSJ ", F.col("code")).alias("l")).collect()
    assert rows[0].n == ["c", "b", "a"] and rows[0].l == "CSJ X86" and [r.c for r in rows] == ["c", "z", None]


def test_sort_and_count(spark):
    # covers: TOP-3 AGG-15
    df = spark.createDataFrame([(1, None), (2, 5.0), (3, 1.0)], "id int, v double")
    assert [r.id for r in sort_by(df, "v", ascending=False, tie="id").collect()] == [2, 3, 1]
    assert [r.id for r in sort_by(df, "v", ascending=True, tie="id").collect()] == [3, 2, 1]
    c = spark.createDataFrame([("a",), ("b",), ("b",)], "k string")
    assert [(r.k, r.n) for r in count_by(c, "k").collect()] == [("b", 2), ("a", 1)]


def test_audits(spark):
    # covers: AUD-2 AUD-4 JN-15
    df = spark.createDataFrame([(1, 2, 2, 1), (1, 1, 1, 0)], "sin int, con int, t int, e int")
    v = {r.identidad: r.violaciones for r in AU.identity_violations(
        df, {"ingresos": (F.col("sin") + F.col("con"), F.col("t") + F.col("e"))}).collect()}
    assert v == {"ingresos": 1}
    act = spark.createDataFrame([("a", 100.0), ("b", 5.0)], "k string, v double")
    ref = spark.createDataFrame([("a", 90.0), ("b", 500.0)], "k string, v double")
    flags = {r.k: r.fuera_de_banda for r in AU.magnitude_check(act, ref, "k", "v").collect()}
    assert flags == {"a": False, "b": True}
    mapped, unc = AU.crosswalk(spark.createDataFrame([("01",), ("99",)], "code string"),
                               spark.createDataFrame([("01", "150101")], "code string, ubigeo string"), "code", "ubigeo")
    assert [r.code for r in unc.collect()] == ["99"] and mapped.where("ubigeo IS NULL").count() == 1


def test_dictionary_lookup(spark):
    # covers: PRJ-29
    df = spark.createDataFrame([("Robo agravado",), ("HURTO",), ("otro",)], "delito string")
    d = spark.createDataFrame([("ROBO AGRAVADO", "Patrimonio"), ("Hurto", "Patrimonio")], "k string, tema string")
    got = [r.tema for r in dictionary_lookup(df, "delito", d, "k", "tema", "tema", default="OTROS").collect()]
    assert sorted(got) == ["OTROS", "Patrimonio", "Patrimonio"]


def test_identity_resolution(spark):
    # covers: SET-7
    df = spark.createDataFrame([(1, "Juan Pérez Soto"), (2, "JUAN PEREZ SOTTO"), (3, "Juana Díaz"), (4, "Pedro Ruiz")],
                               "id int, nombre string")
    got = {r.id: r.cluster_id for r in resolve_identities(df, "id", "nombre").collect()}
    assert got[2] == 1 and got[1] == 1 and got[4] == 4


def test_identity_resolution_links_every_pair_within_two_edits(spark):
    # covers: SET-7 (typos at any place, no representative; equals brute force)
    import random
    rng = random.Random(3)
    names = ["GARCIA AAAAAA", "GARCIA LOPEZ JUAN", "GARCIA LOPES JUAN", "GRACIA LOPEZ JUAN", "", "AB", "Ñ", None, None]
    for _ in range(25):
        k = "".join(rng.choice("ABC") for _ in range(rng.randint(3, 12)))
        for _ in range(4):
            names.append(k)
            at = rng.randrange(len(k))
            k = rng.choice((k[:at] + k[at + 1:], k[:at] + "D" + k[at:], k[:at] + "E" + k[at + 1:]))

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row = row, [i]
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    key = [n if n is None else n.replace(" ", "").replace("Ñ", "N") for n in names]
    want = list(range(len(key)))
    for i, a in enumerate(key):
        for j in range(i):
            if a is not None and key[j] is not None and edits(a, key[j]) <= 2 and want[i] != want[j]:
                x, y = sorted((want[i], want[j]))
                want = [x if w == y else w for w in want]
    assert want[1] == want[2] == want[3] == 1 and want[0] == 0 and want[7:9] == [7, 8]
    df = spark.createDataFrame(list(enumerate(names)), "id int, nombre string")
    got = {r.id: r.cluster_id for r in resolve_identities(df, "id", "nombre").collect()}
    assert got == dict(enumerate(want))


def test_tables_see_new_files(spark, tmp_path):
    # covers: SRC-5
    from judicata.tables import table
    d = tmp_path / "sf"
    spark.range(3).withColumnRenamed("id", "r_regionkey").write.parquet(str(d / "region.parquet"))
    assert table(spark, str(d), "region").count() == 3
    spark.range(2).withColumnRenamed("id", "r_regionkey").write.mode("append").parquet(str(d / "region.parquet"))
    assert table(spark, str(d), "region").count() == 5


def test_small_api_helpers(spark, tmp_path):
    # covers: JN-6 SRC-12 SNK-2 SNK-3
    from judicata.operators.match import DELAY_EDGES, bucket_index
    from judicata.sinks.manifest import upsert, write_version
    from judicata.sinks.writers import contract_document, write_document
    from judicata.sources.sheet import year_columns
    df = spark.createDataFrame([(v,) for v in (-1, 0, 29, 30, 730, 5000, None)], "d int")
    assert [r[0] for r in df.select(bucket_index("d", DELAY_EDGES)).collect()] == [None, 0, 0, 1, 5, 5, None]
    assert year_columns(["Distrito Fiscal", "2019", "2020.0", "Total", None]) == ["2019", "2020.0"]
    m = upsert(spark.createDataFrame([("a", 1, 0)], "id string, n int, seq int"),
               spark.createDataFrame([("b", 2, 1)], "id string, n int, seq int"))
    p1 = write_version(m, str(tmp_path / "manifest"), "1")
    assert sorted(r.id for r in spark.read.parquet(p1).collect()) == ["a", "b"]
    doc = contract_document({"fuente": "x"}, {"filas": spark.range(2)})
    write_document(doc, str(tmp_path / "doc"))
    assert json.loads(sinks.document_text(spark, str(tmp_path / "doc")))["filas"] == [{"id": 0}, {"id": 1}]


def test_document_in_parts(spark, tmp_path, monkeypatch):
    # covers: SNK-2
    from judicata.sinks import writers
    monkeypatch.setattr(writers, "PART_RECORDS", 1000)
    big = spark.range(7000).select(F.col("id").alias("n"), F.lit('a "b"\n').alias("t")).repartition(5).orderBy(F.desc("n"))
    index = writers.write_document(writers.contract_document({"fuente": "é"}, {"filas": big, "nada": big.where("n < 0"), "uno": spark.range(1)}),
                                   str(tmp_path / "doc"))
    doc = json.loads(sinks.document_text(spark, str(tmp_path / "doc")))
    assert [r["n"] for r in doc["filas"]] == list(range(6999, -1, -1)) and doc["nada"] == [] and doc["uno"] == [{"id": 0}]
    parts = index.collect()
    assert len(parts) == 8 and sum(p.lines for p in parts) == 7010 - 1 and max(p.lines for p in parts) < 2500


def test_missing_dataset_and_appended_log(spark, tmp_path):
    # covers: SNK-4 SNK-5
    assert sinks.load_table(spark, str(tmp_path / "none"), "t_none").first().n is None
    spark.range(4).write.parquet(str(tmp_path / "some"))
    assert sinks.load_table(spark, str(tmp_path / "some"), "t_some").first().n == 4
    for run in ("r1", "r2", "r2"):
        log = sinks.append_run_log(spark, str(tmp_path / "log"), run, [("casos", "n", 3.0)])
    assert sorted(tuple(r) for r in log.collect()) == [("r1", "casos", "n", 3.0), ("r2", "casos", "n", 3.0)]


def test_text_dump_header_by_place(spark, tmp_path):
    # covers: SRC-6
    from judicata.sources.text import read_latin1_lines
    (tmp_path / "a.txt").write_bytes(b"h\n" + b"x\n" * 3000)
    (tmp_path / "b.txt").write_bytes(b"x\nh\n")
    assert read_latin1_lines(spark, str(tmp_path / "*.txt"), skip_header=True).count() == 3001


def test_cutoff_falls_back_to_any_date_column(spark):
    # covers: PRJ-5 JOB-10
    from judicata import jobs as J
    raw = spark.createDataFrame([("2020", "LIMA", "5", "03/02/2021"), ("2021", "PIURA", "1", "junk")], "`AÑO` string, DEPARTAMENTO string, `CASOS TOTAL` string, FECHA string")
    assert J.violence_cases(raw)["meta"].first().fecha_corte == "2021-02-03"


def test_identity_resolution_sends_no_shortened_strings_through_the_driver(spark):
    # covers: SET-7; a name of 20 letters has 211 of them, a plan's estimate sees the name's bytes only
    rows = [(i, "".join(chr(65 + (i * p + p // 7) % 26) for p in range(3, 99, 5)) + chr(65 + i // 26 % 26) * 3 + chr(65 + i // 676) * 3) for i in range(1500)]
    df = spark.createDataFrame([*rows, (5000, rows[7][1][:-1])], "id long, nombre string")
    conf = {"spark.sql.autoBroadcastJoinThreshold": str(10 << 20), "spark.sql.maxBroadcastTableSize": str(4 << 20)}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        got = {r.id: r.cluster_id for r in resolve_identities(df, "id", "nombre").collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == {i: i for i in range(1500)} | {5000: 7}
