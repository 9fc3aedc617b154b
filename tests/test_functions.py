"""Column builders against the dirty-input fixtures."""

from pyspark.sql import functions as F

from judicata.functions import classify as K
from judicata.functions import dates as D
from judicata.functions import metrics as M
from judicata.functions import numbers as N
from judicata.functions import text as X


def col1(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {typ}")


def test_tolerant_numbers(spark):
    # covers: PRJ-1 PRJ-2 PRJ-21
    df = col1(spark, ["12", " 12.5 ", "x", "", None, "1,234"])
    plain = [r[0] for r in df.select(N.tolerant_number("v")).collect()]
    commas = [r[0] for r in df.select(N.tolerant_number_commas("v")).collect()]
    assert plain == [12.0, 12.5, None, None, None, None]
    assert commas[-1] == 1234.0
    assert [r[0] for r in col1(spark, [None]).select(N.filled("v")).collect()] == [0.0]


def test_text_key_blank(spark):
    # covers: PRJ-3
    out = [r[0] for r in col1(spark, [None, "", "  PIURA "]).select(X.text_key("v")).collect()]
    assert out == ["SIN DATO", "SIN DATO", "PIURA"]


def test_accent_fold_composed_and_decomposed(spark):
    # covers: PRJ-8
    import unicodedata
    vals = ["Áncash", "HUÁNUCO ", "cañete", unicodedata.normalize("NFD", "cañete"), unicodedata.normalize("NFD", "Áncash")]
    out = [r[0] for r in col1(spark, vals).select(X.fold_accents("v")).collect()]
    assert out == ["ANCASH", "HUANUCO", "CANETE", "CANETE", "ANCASH"]
    assert len(X.ACCENTED) == len(X.PLAIN)


def test_letters_key(spark):
    # covers: PRJ-9
    out = col1(spark, ["Delitos contra la F|e Pública."]).select(X.letters_key("v")).first()[0]
    assert out == "DELITOSCONTRALAFEPUBLICA"


def test_cutoff_formats(spark):
    # covers: PRJ-6
    cases = {
        ("23/06/2026", "bad"): "2026-06-23",
        ("20260623",): "2026-06-23",
        ("2026-06-23",): "2026-06-23",
        ("2024-T1",): "2024-T1",
        (None, ""): None,
    }
    for vals, expected in cases.items():
        got = col1(spark, list(vals)).agg(D.cutoff_agg("v")).first()[0]
        assert got == expected, (vals, got)


def test_day_first_without_zero(spark):
    # covers: PRJ-5 PRJ-4
    got = col1(spark, ["4/1/2021"]).select(D.dmy("v")).first()[0]
    assert str(got) == "2021-01-04"


def test_month_names_and_yyyymm(spark):
    # covers: PRJ-13 PRJ-14
    out = [r[0] for r in col1(spark, ["Enero", "Setiembre", "Septiembre", "??"]).select(D.month_number("v")).collect()]
    assert out == [1, 9, 9, 0]
    out = [r[0] for r in col1(spark, [202107, None, 202199], "bigint").select(D.month_of_yyyymm("v")).collect()]
    assert out == [7, 0, 12]


def test_days_between(spark):
    # covers: PRJ-15
    df = spark.createDataFrame([("2021-01-04", "2021-09-23")], "a string, b string")
    assert df.select(D.days_between(F.to_date("b"), F.to_date("a"))).first()[0] == 262


def test_court_type_first_hit(spark):
    # covers: PRJ-17 PRJ-16
    vals = ["1° JUZGADO DE PAZ LETRADO LABORAL", "SALA CIVIL", "JUZGADO DE INVESTIGACION", "X"]
    out = [r[0] for r in col1(spark, vals).select(K.court_type("v")).collect()]
    assert out == ["JUZGADO DE PAZ LETRADO", "SALA SUPERIOR", "JUZ. INVESTIGACION PREPARATORIA", "OTRO"]


def test_alert_levels_strict(spark):
    # covers: PRJ-18 PRJ-20
    out = [r[0] for r in col1(spark, [1001, 1000, 501, 500], "int").select(K.alert_level("v")).collect()]
    assert out == ["Critico", "Riesgo", "Riesgo", "Normal"]


def test_zero_denominators(spark):
    # covers: IND-1 IND-2 IND-3
    df = spark.createDataFrame([(0, 0, 5)], "ing long, res long, pend long")
    r = df.select(M.clearance_pct("res", "ing").alias("c"), M.congestion("pend", "ing", "res").alias("g")).first()
    assert r.c is None and r.g is None


def test_recover_tail_cut_before_pipes(spark):
    # covers: PRJ-9 JN-7
    raw = "xx DELITOS CONTRA LA FE P|UBLICA" + "|" * 60 + "TAIL"
    got = col1(spark, [raw, "nothing here"]).select(X.recover_tail("v")).collect()
    tail = raw[raw.index("DELITOS"):][:70].replace("|", "")
    assert got[0][0] == tail and got[1][0] is None
