"""Writers: tidy parquet (SNK-1), contract JSON (SNK-2), catalog table (SNK-4),
run log (SNK-5), CSV export (SNK-7), versioned snapshots (SNK-8), map output."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from judicata.functions.provenance import with_provenance
from judicata.session import materialise


def write_tidy(df: DataFrame, path: str, fuente: str, fecha_corte, granularidad: str,
               partition_by: str | None = "anio", mode: str = "overwrite") -> None:
    """Tidy parquet with provenance on every row, partitioned by year.

    Dynamic partition overwrite replaces only the years present in ``df``, so a
    re-run of one year never deletes the others."""
    out = with_provenance(df, fuente, fecha_corte, granularidad)
    w = out.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if partition_by and partition_by in out.columns:
        w = w.partitionBy(partition_by)
    w.parquet(path)


#: Records that one part file of a document holds, about.
PART_RECORDS = 200_000


def contract_document(meta: dict | DataFrame, arrays: dict[str, DataFrame]) -> DataFrame:
    """(section, seq, value): the lines of a JSON document ``{"_meta": {...}, name: [records...], ...}``.

    Every record is a line of its own and its order is that of its frame, so a document of
    any size is written in parts (:func:`write_document`) and no task or row holds an array."""
    spark = next(iter(arrays.values())).sparkSession
    if isinstance(meta, dict):
        head = spark.range(1).select(F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in meta.items()])).alias("j"))
    else:
        head = meta.limit(1).select(F.to_json(F.struct(*meta.columns)).alias("j"))
    lines = [head.select(F.lit(0).alias("section"), F.lit(0).cast("long").alias("seq"), F.concat(F.lit('{"_meta": '), "j").alias("value"))]
    ends = []
    for i, (name, df) in enumerate(arrays.items(), start=1):
        ends += [(i, -1, f', {json.dumps(name, ensure_ascii=False)}: ['), (i, 2 ** 63 - 1, "]")]
        rows = df.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("j"))
        lines.append(rows.select(F.lit(i).alias("section"), F.monotonically_increasing_id().alias("seq"), F.col("j").alias("value")))
    ends.append((len(arrays) + 1, 0, "}"))
    body = materialise(reduce(DataFrame.unionByName, lines))
    first = body.groupBy("section").agg(F.min("seq").alias("first"))                 # a row a section
    comma = F.when((F.col("section") > 0) & (F.col("seq") > F.col("first")), F.lit(",")).otherwise(F.lit(""))
    body = body.join(F.broadcast(first), "section").select("section", "seq", F.concat(comma, "value").alias("value"))
    return body.unionByName(spark.createDataFrame(ends, "section int, seq long, value string"))


def write_document(doc: DataFrame, path: str) -> DataFrame:
    """Part files that make the JSON document when read one after the other, and their index:
    (part, lines), also written beside them as ``path.index``."""
    parts = max(1, -(-doc.count() // PART_RECORDS))
    ordered = doc.repartitionByRange(parts, "section", "seq").sortWithinPartitions("section", "seq").select("value")
    ordered.write.mode("overwrite").text(path)
    index = doc.sparkSession.read.text(path).groupBy(F.col("_metadata.file_name").alias("part")).agg(F.count(F.lit(1)).alias("lines"))
    index.orderBy("part").coalesce(1).write.mode("overwrite").json(f"{path.rstrip('/')}.index")
    return doc.sparkSession.read.schema("part string, lines long").json(f"{path.rstrip('/')}.index").orderBy("part")


def document_text(spark: SparkSession, path: str) -> str:
    """A written document as one text, for small ones."""
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("part"), F.monotonically_increasing_id().alias("n"), "value")
    return "\n".join(r.value for r in lines.orderBy("part", "n").collect())


def load_table(spark: SparkSession, df: DataFrame | str, name: str) -> DataFrame:
    """Create-or-replace a catalog table and return its row count as a DataFrame (SNK-4).

    ``df`` may be the path of a Parquet dataset; where there is none, the table is left as it is
    and its count is null."""
    if isinstance(df, str):
        at = spark._jvm.org.apache.hadoop.fs.Path(df)
        if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
            return spark.createDataFrame([(name, None)], "tabla string, n long")
        df = spark.read.parquet(df)
    df.write.mode("overwrite").saveAsTable(name)
    return spark.table(name).agg(F.lit(name).alias("tabla"), F.count(F.lit(1)).alias("n"))


def run_log(spark: SparkSession, run_id: str, entries: list[tuple[str, str, float]]) -> DataFrame:
    """Append-only audit rows (run, dataset, metric, value) (SNK-5)."""
    return spark.createDataFrame([(run_id, d, m, float(v)) for d, m, v in entries],
                                 "run string, dataset string, metric string, value double")


def append_run_log(spark: SparkSession, path: str, run_id: str, entries: list[tuple[str, str, float]]) -> DataFrame:
    """Add a run's rows to the log at ``path``, once a run, and return the whole log (SNK-5)."""
    run_log(spark, run_id, entries).drop("run").write.mode("overwrite").parquet(f"{path.rstrip('/')}/run={run_id}")
    return spark.read.parquet(path).select(F.col("run").cast("string").alias("run"), "dataset", "metric", "value")


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_snapshot(df: DataFrame, path: str, fecha_corte: str) -> None:
    """Versioned snapshot by cut-off date (SNK-8): only that partition is replaced."""
    (df.withColumn("fecha_corte", F.lit(fecha_corte)).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy("fecha_corte").parquet(path))


def latest_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the newest cut-off only (partition pruning through a scalar subquery)."""
    df = spark.read.parquet(path)
    return df.where(F.col("fecha_corte") == df.select(F.max("fecha_corte")).scalar())


def to_year_map(long: DataFrame, year: str, key: str, value: str) -> DataFrame:
    """Long (year, key, value) -> one row per year with a key -> value map."""
    return long.groupBy(year).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col(key), F.col(value)))).alias("valores"))


# Presentation decimals per measure family (rates 1, congestion 2,
# prototype ratios 3); counts and money are truncated to integers.
PRESENTATION = {"clearance": 1, "congestion": 2, "ratio": 3}


def presented(df: DataFrame) -> DataFrame:
    """Columns of a measure family rounded as documents show them; percentages below are never computed from these."""
    return present(df, {c: PRESENTATION[c] for c in df.columns if c in PRESENTATION})


def present(df: DataFrame, decimals: dict[str, int], truncate: tuple[str, ...] = ()) -> DataFrame:
    """Gold-layer rounding only (PRJ-24): HALF_UP ``round`` for the given columns,
    truncation toward zero for counts/money; compute layers stay unrounded."""
    out = df.withColumns({c: F.round(F.col(c), n) for c, n in decimals.items()})
    return out.withColumns({c: F.col(c).cast("bigint") for c in truncate})


def formatted(c, decimals: int = 1, percent: bool = False):
    """Locale-style number text for reports (PRJ-26)."""
    col = F.col(c) if isinstance(c, str) else c
    txt = F.format_number(col, decimals)
    return F.concat(txt, F.lit(" %")) if percent else txt


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict, mode: str = "overwrite") -> None:
    """Load a normalised table into a relational database (SNK-9).  Needs a
    reachable database server; not exercised by the tests here."""
    df.write.jdbc(url=url, table=table, mode=mode, properties=properties)


def olap_load(spark: SparkSession, datasets: dict[str, DataFrame]) -> DataFrame:
    """JOB-13: create-or-replace one catalog table per dataset and return the row counts."""
    out = None
    for name, df in datasets.items():
        c = load_table(spark, df, name)
        out = c if out is None else out.unionByName(c)
    return out
