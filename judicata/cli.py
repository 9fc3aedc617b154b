"""Command line: run dataset jobs on landed raw files, as the source's build
scripts do, with failure isolation and a manifest.

    python -m judicata.cli --out OUT court_workload=data/pj/*.csv reports=data/mpfn/delitos/*.csv \\
        constitutional=data/tc/ing.xlsx,data/tc/pub.xlsx police=data/inei/*.zip

Each ``job=paths`` runs independently; outputs go to ``OUT/<job>/<part>``
(parquet) and ``OUT/<job>.json`` (contract document: ``_meta`` + small gold
arrays); ``OUT/manifest`` is upserted by job id.  A failing job becomes a
manifest row with a null count and its error text.
"""

from __future__ import annotations

import argparse
import os
import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from judicata import jobs as J
from judicata.catalog import run_jobs
from judicata.operators.clean import YEAR_RANGES
from judicata.session import get_session
from judicata.sinks.manifest import manifest_exists, replace_manifest, upsert
from judicata.sinks.writers import contract_document, presented, write_document
from judicata.sources.csv import read_csv_smart
from judicata.sources.sheet import sheets_to_long
from judicata.sources.text import read_latin1_lines, read_zip_lines
from judicata.sources.xlsx import read_xlsx_rows


def _csv(spark, paths):
    df, errors = read_csv_smart(spark, paths)
    if df is None:
        raise FileNotFoundError(f"no readable CSV among {paths}: {errors}")
    return df.drop("_source_file")


def xlsx_frame(spark: SparkSession, path: str) -> DataFrame:
    """First sheet of a workbook with its first row as header, all text."""
    rows = read_xlsx_rows(spark, path, first_sheet=True)
    first = rows.select(F.min("row_idx")).first()[0]          # one number: the header row index
    header = rows.where(F.col("row_idx") == first).select("cells").first()[0]    # one row of names
    body = rows.where(F.col("row_idx") > first)
    return body.select(*[F.element_at("cells", i + 1).alias((h or f"_c{i}").strip()) for i, h in enumerate(header)])


def wide_sheets(spark: SparkSession, paths: list[str]) -> DataFrame:
    """First sheets of all workbooks as (distrito, anio, valor) in one plan; a sheet without a header row is an error, never no rows."""
    rows = reduce(DataFrame.unionByName, [read_xlsx_rows(spark, p, first_sheet=True).withColumn("path", F.lit(p)).withColumn("sheet", F.lit(0))
                                          for p in paths])
    long, errors = sheets_to_long(rows)
    bad = errors.limit(20).collect()
    if bad:
        raise ValueError("; ".join(f"{r.path}: {r.error}" for r in bad))
    return long.drop("path", "sheet")


def _year_from_path(col):
    return F.regexp_extract(col, r"(19|20)\d{2}", 0).try_cast("int")


def build(spark: SparkSession, job: str, paths: list[str]) -> dict[str, DataFrame]:
    if job == "court_workload":
        return J.court_workload(_csv(spark, paths))
    if job == "prosecutors":
        return J.prosecutor_headcount(_csv(spark, paths))
    if job in ("flows", "flagrancy", "violence_flow"):
        return J.flow_by_year(_csv(spark, paths), years=YEAR_RANGES["constitutional"])
    if job == "prosecution_cases":
        return J.flow_by_year(_csv(spark, paths), cutoff="fecha_corte")
    if job in ("reports", "cybercrime"):
        years = YEAR_RANGES["workload" if job == "reports" else "constitutional"]
        return J.counted_reports(_csv(spark, paths), years=years)
    if job == "case_delay":                      # paths: name:INSTANCE_COLUMN:glob
        procs = {}
        for p in paths:
            name, inst, glob = p.split(":", 2)
            procs[name] = (_csv(spark, [glob]), inst)
        return J.case_delay(procs)
    if job == "constitutional":                  # paths: filed.xlsx, published.xlsx
        return J.constitutional_court(xlsx_frame(spark, paths[0]), xlsx_frame(spark, paths[1]))
    if job == "trafficking":
        return J.trafficking_sheet(wide_sheets(spark, paths))
    if job in ("violence", "femicide", "attempts"):
        return J.violence_cases(_csv(spark, paths), categories={"por_tipo": J.VIOLENCE_TYPES,
                                                                "por_vinculo": J.RELATIONS,
                                                                "por_edad": J.AGE_GROUPS})
    if job == "police":                          # zips or text dumps, year taken from the file name
        zips = [p for p in paths if p.lower().endswith(".zip")]
        texts = [p for p in paths if not p.lower().endswith(".zip")]
        parts = []
        if zips:
            z = read_zip_lines(spark, zips, include=r"CAP.?200", exclude=r"muestra|diccionario|dicc")
            parts.append(z.where(F.col("line_no") > 0).select(_year_from_path(F.col("zip_path")).alias("anio"), "line"))
        if texts:
            t = read_latin1_lines(spark, texts, skip_header=True)
            parts.append(t.select(_year_from_path(F.col("_source_file")).alias("anio"), "line"))
        lines = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return J.police_lines(lines)
    if job == "crimes_by_department":            # paths: csv globs..., last = official names (one per line)
        official = spark.read.text(paths[-1]).select(F.trim("value").alias("nombre")).where("nombre <> ''")
        return J.crimes_by_department(_csv(spark, paths[:-1]), official)
    raise ValueError(f"unknown job {job}")


def write_outputs(name: str, outputs: dict[str, DataFrame], out: str) -> DataFrame:
    """Parquet per part, plus the contract JSON document in part files; returns the tidy (or main) frame."""
    for part, df in outputs.items():
        w = df.write.mode("overwrite")
        if part == "tidy" and "anio" in df.columns:
            w = w.option("partitionOverwriteMode", "dynamic").partitionBy("anio")
        w.parquet(os.path.join(out, name, part))
    spark = next(iter(outputs.values())).sparkSession
    written = {part: spark.read.parquet(os.path.join(out, name, part)) for part in outputs if part != "tidy"}
    meta = written.pop("meta", None)
    doc = contract_document(meta if meta is not None else {"id": name}, {part: presented(df) for part, df in written.items()} or
                            {"filas": spark.createDataFrame([], "id string")})
    write_document(doc, os.path.join(out, f"{name}.json"))
    return spark.read.parquet(os.path.join(out, name, "tidy" if "tidy" in outputs else next(iter(outputs))))


def main(argv=None, spark: SparkSession | None = None):
    ap = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("--out", required=True)
    ap.add_argument("jobs", nargs="+", help="job=path[,path...]")
    a = ap.parse_args(argv)
    spark = spark or get_session(app="judicata-cli")
    todo = {}
    for spec in a.jobs:
        job, _, paths = spec.partition("=")
        plist = [p for p in re.split(r",(?![^:]*:)", paths) if p] if job == "case_delay" else paths.split(",")
        todo[job] = (lambda j=job, pl=plist: write_outputs(j, build(spark, j, pl), a.out))
    manifest = run_jobs(spark, todo).withColumn("seq", F.lit(int(__import__("time").time())))
    mpath = os.path.join(a.out, "manifest")
    # a failed read of an existing manifest stops the run
    exists = manifest_exists(spark, mpath)
    replace_manifest(upsert(spark.read.parquet(mpath), manifest, "id", "seq") if exists else manifest, mpath)
    return spark.read.parquet(mpath)


if __name__ == "__main__":
    main()
