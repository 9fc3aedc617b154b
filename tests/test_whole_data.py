"""Nothing is dropped, cut or switched by size: limits that once were there."""

import json

from pyspark.sql import functions as F

from judicata import cli
from judicata import jobs as J
from judicata.functions.text import recover_tail
from judicata.operators.clean import find_col
from judicata.sinks import document_text


def test_contract_document_keeps_long_arrays(spark, tmp_path):
    # covers: SNK-2
    big = spark.range(10_001).withColumnRenamed("id", "n")
    cli.write_outputs("d", {"filas": big, "meta": spark.range(1)}, str(tmp_path))
    doc = json.loads(document_text(spark, str(tmp_path / "d.json")))
    assert len(doc["filas"]) == 10_001 and doc["_meta"] == {"id": 0}


def test_year_floor_of_flows_and_reports():
    # covers: JOB-2 JOB-3 JOB-4
    import inspect
    for job in (J.prosecutor_headcount, J.flow_by_year, J.counted_reports):
        assert inspect.signature(job).parameters["years"].default == (2015, 2026)
    assert inspect.signature(J.crimes_by_department).parameters["years"].default == (2019, 2026)


def test_needle_may_be_a_prefix():
    # covers: PRJ-10
    assert find_col(["VIOLENCIA FISICA", "VIOLENCIA ECONOMICA O PATRIMONIAL"], "VIOLENCIA ECON") == "VIOLENCIA ECONOMICA O PATRIMONIAL"
    assert find_col(["DESCONOCIDO", "CONOCIDO"], "CONOCIDO") == "CONOCIDO"
    assert find_col(["A"], "B") is None


def test_anchor_at_line_end_and_before_any_space(spark):
    # covers: AGG-16
    df = spark.createDataFrame([("x DELITO",), ("x DELITO DE ROBO",), ("x DELITO DE ROBO",), ("DELITOSO",)], "l string")
    got = [r[0] for r in df.select(recover_tail(F.col("l"))).collect()]
    assert got == ["DELITO", "DELITO DE ROBO", "DELITO DE ROBO", None]


def test_manifest_keeps_entries_and_stops_on_unreadable(spark, tmp_path):
    # covers: SNK-3 JOB-17
    import pytest
    out = tmp_path / "o"
    csv = tmp_path / "a.csv"
    csv.write_text("anio;generico;cantidad\n2017;X;3\n")
    cli.main(["--out", str(out), f"reports={csv}"], spark)
    m = cli.main(["--out", str(out), f"cybercrime={csv}"], spark)
    assert {r.id for r in m.collect()} == {"reports", "cybercrime"}
    for f in (out / "manifest").glob("*.parquet"):
        f.write_bytes(b"broken")
    with pytest.raises(Exception):
        cli.main(["--out", str(out), f"reports={csv}"], spark)
    assert list((out / "manifest").glob("*.parquet"))
