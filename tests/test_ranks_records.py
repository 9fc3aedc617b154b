"""Rank selection and record assembly against plain versions."""

import csv
import io
import math
import random

import pytest

from judicata.operators import ranks
from judicata.sources import csv as CSV
from judicata.sources import records as R


def _values(seed=3):
    r = random.Random(seed)
    rows = [("a", r.lognormvariate(0, 40)) for _ in range(3000)] + [("b", float(r.choice([1, 1, 1, 2, 5]))) for _ in range(2000)]
    rows += [(None, r.uniform(-1e308, 1e308)) for _ in range(800)] + [("c", 7.5), ("d", None), ("e", float("nan")), ("e", 3.0), ("e", 4.0)]
    return rows


@pytest.mark.parametrize("few,accuracy", [(100_000, 10_000), (50, 20), (2, 5)])
def test_exact_quantiles(spark, monkeypatch, few, accuracy):
    # covers: AGG-5 AGG-6
    monkeypatch.setattr(ranks, "BUCKETS", 7 if few < 100 else ranks.BUCKETS)
    df = spark.createDataFrame(_values(), "g string, v double").repartition(5)
    probs = (0.0, 0.25, 0.5, 0.9, 1.0)
    got = {r.g: r for r in ranks.exact_quantiles(df, "g", "v", probs, [f"q{i}" for i in range(5)], few=few, accuracy=accuracy).collect()}
    by = {}
    for g, v in _values():
        if v is not None and not math.isnan(v):
            by.setdefault(g, []).append(v)
    assert set(got) == set(by)
    for g, vs in by.items():
        vs = sorted(vs)
        assert got[g].n == len(vs)
        for i, p in enumerate(probs):
            at = p * (len(vs) - 1)
            a, b = vs[math.floor(at)], vs[math.ceil(at)]
            assert got[g][f"q{i}"] == pytest.approx(a if a == b else a + (b - a) * (at - math.floor(at)), rel=1e-12), (g, p)


def test_exact_quantiles_without_groups_or_rows(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)], "v double")
    assert ranks.exact_quantiles(df, [], "v").first()[1:] == (50.0, 90.0)
    assert ranks.exact_quantiles(df.where("v > 1000"), [], "v").count() == 0


def _texts(seed):
    r = random.Random(seed)
    fields = ["plain", "", 'say "yes"', "two\nlines", "\n\n", "a;b", "é ñ", "\r\nwindows\r\n", "x" * 300, '"', '""\n"']
    return [[str(i), r.choice(fields), r.choice(fields)] for i in range(400)]


def _written(rows, end="\n"):
    out = io.StringIO(newline="")
    w = csv.writer(out, delimiter=";", lineterminator=end, quoting=csv.QUOTE_NONNUMERIC)
    for row in rows:
        w.writerow([int(row[0]), *row[1:]])
    return out.getvalue()


@pytest.mark.parametrize("block", [1, 7, 10_000])
def test_assemble_records(spark, block):
    # covers: SRC-1
    lines = []
    for f in ("x", "y", "z"):
        text = _written(_texts(f), "\r\n" if f == "y" else "\n").removesuffix("\n")
        lines += [(f, i // block * (3 if f == "z" else 1), i, ln) for i, ln in enumerate(text.split("\n"))]
    df = spark.createDataFrame(lines, "file string, block long, n long, line string").repartition(6)
    records = R.assemble_records(df)
    got = R.parse_records(records, ["id", "a", "b"], ";").collect()
    assert {(r.a, r.b) for r in R.parse_records(records, ["id", "a", "b"], ";", keep_empty=True).collect()} == {(b, c) for f in "xyz" for _, b, c in _texts(f)}
    for f in ("x", "y", "z"):
        mine = sorted(((r.record_no, r.id, r.a, r.b) for r in got if r.file == f), key=lambda r: r[0])
        assert mine == [(i + 1, a, b or None, c or None) for i, (a, b, c) in enumerate(_texts(f))]
    assert R.unclosed_files(df).count() == 0
    assert [r.file for r in R.unclosed_files(df.unionByName(spark.createDataFrame([("q", 0, 0, 'a;"b')], df.schema))).collect()] == ["q"]


def test_split_files_with_line_breaks(spark, tmp_path):
    # covers: SRC-1 SRC-2
    rows = [[str(i), f"first {i}\nsecond, with \"quotes\"\n", "Ñandú" if i % 2 else "z"] for i in range(20_000)]
    body = '"N°";"a\nheader";"c"\n' + _written(rows)
    (tmp_path / "big.csv").write_bytes(body.encode("latin-1"))
    (tmp_path / "open.csv").write_bytes(b'a;b\n1;"never\nends\n')
    (tmp_path / "head.csv").write_bytes(('"' + "long\n" * 30_000 + '";b\n1;"x\ny"\n').encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        assert spark.read.text(str(tmp_path / "big.csv")).rdd.getNumPartitions() > 8        # read by many tasks
        df, errors = CSV.read_csv_smart(spark, str(tmp_path / "*.csv"))
        assert [e[0].rsplit("/", 1)[1] for e in errors] == ["open.csv"]
        got = df.where(df["`N°`"].isNotNull()).collect()
        assert sorted((int(r["N°"]), r["a header"], r["c"]) for r in got) == [(int(a), b, c) for a, b, c in rows]
        assert [r.b for r in df.where("b is not null").collect()] == ["x\ny"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)

